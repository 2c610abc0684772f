"""One query for each operator, over its whole table."""

from waymarks.llm.queries import (  # noqa: F401
    op01,
    op02,
    op03,
    op04,
    op05,
    op06,
    op07,
    op08,
    op09,
    op10,
    op11,
    op12,
    op13,
    pipeline,
)
from waymarks.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
