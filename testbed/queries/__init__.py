"""Importing this package registers every query."""

from testbed.queries import (  # noqa: F401
    cleaning,
    crowds,
    files,
    flows,
    geometry,
    jobs,
    labels,
    od,
    places,
    sources,
    stays,
    traces,
    trips,
)
