"""WGS84 <-> Gauss-Krueger projection, planar distances and grid codes, without UDFs.

A missing coordinate is NULL and makes every derived value NULL.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------
# Ellipsoid, degree factor, false easting, default meridian and grid size of the projection.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
DEGREE = 0.0174532925199433333333
FALSE_EASTING = 500000.0
CENTRAL_MERIDIAN = 105.0
GRID_SIZE = 50
ZONE_WIDTH = 6
# Meridian-arc series in powers of the squared eccentricity, lowest power first.  The last
# denominator of the fourth series is 13072; the pattern of its neighbours suggests 131072,
# which would move northings by about a hundredth of a millimetre.
ARC_SERIES = (
    (0, (1, 3 / 4, 45 / 64, 175 / 256, 11025 / 16384, 43659 / 65536)),
    (1, (3 / 4, 15 / 16, 525 / 512, 2205 / 2048, 72765 / 65536)),
    (2, (15 / 64, 105 / 256, 2205 / 4096, 10359 / 16384)),
    (3, (35 / 512, 315 / 2048, 31185 / 13072)),
)
# ---- end of fixed values ------------------------------------------------------------

E2 = 2 * FLATTENING - FLATTENING**2
EP2 = E2 / (1 - E2)


def _arc_terms() -> tuple[float, float, float, float]:
    """Factors of latitude, sin, sin^3 and sin^5 in the meridian arc length."""
    scale = SEMI_MAJOR * (1 - E2)
    a1, a2, a3, a4 = (
        scale * sum(c * E2 ** (lowest + i) for i, c in enumerate(series))
        for lowest, series in ARC_SERIES
    )
    return a1, -a2 + a3 - a4, -2 * a3 + 16 / 3 * a4, -16 / 3 * a4


ARC_LAT, ARC_SIN1, ARC_SIN3, ARC_SIN5 = _arc_terms()


def _d(number: float) -> str:
    """A SQL double literal."""
    return f"({float(number)!r}D)"


def _poly(x: str, *coefficients) -> str:
    """Polynomial by Horner's rule, constant term first; coefficients are numbers or SQL."""
    terms = [c if isinstance(c, str) else _d(c) for c in coefficients]
    return reduce(lambda acc, c: f"({acc} * {x} + {c})", reversed(terms[:-1]), terms[-1])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stepwise(df: DataFrame, inputs: dict, steps: list[dict[str, str]], keep: set) -> DataFrame:
    """Add columns step by step, each step using the ones before, and drop all but ``keep``.

    Shared terms are columns of their own, so that each is computed once and the generated
    code stays small.
    """
    df = df.withColumns({name: _col(c) for name, c in inputs.items()})
    for step in steps:
        df = df.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return df.drop(*({name for step in [inputs, *steps] for name in step} - keep))


def with_metres(
    df: DataFrame,
    lon="lon",
    lat="lat",
    x: str = "x",
    y: str = "y",
    meridian: float = CENTRAL_MERIDIAN,
) -> DataFrame:
    """Add easting ``x`` and northing ``y`` in metres of a longitude and latitude in degrees."""
    arc = f"_b * {_d(ARC_LAT)} + _c * _s * {_poly('_s2', ARC_SIN1, ARC_SIN3, ARC_SIN5)}"
    north = _poly(
        "_m2", 1 / 2, "(5 - _t2 + 9 * _q + 4 * _q * _q) / 24D", f"{_poly('_t2', 61, -58, 1)} / 720D"
    )
    east = _poly(
        "_m2",
        1,
        "(1 - _t2 + _q) / 6D",
        f"({_poly('_t2', 5, -18, 1)} - 14 * _q - 58 * _q * _t2) / 120D",
    )
    steps = [
        {"_b": f"_lat * {_d(DEGREE)}", "_l": f"_lon * {_d(DEGREE)} - {_d(meridian * DEGREE)}"},
        {"_s": "sin(_b)", "_c": "cos(_b)", "_t": "tan(_b)"},
        {
            "_m": "_l * _c",
            "_m2": "_l * _c * _l * _c",
            "_n": f"{_d(SEMI_MAJOR)} / sqrt(1 - _s * _s * {_d(E2)})",
            "_q": f"_c * _c * {_d(EP2)}",
            "_t2": "_t * _t",
            "_s2": "_s * _s",
        },
        {
            x: f"_n * _m * {east} + {_d(FALSE_EASTING)}",
            y: f"{arc} + _n * _t * _m2 * {north}",
        },
    ]
    return _stepwise(df, {"_lon": lon, "_lat": lat}, steps, {x, y})


def with_degrees(
    df: DataFrame,
    x="x",
    y="y",
    lon: str = "lon",
    lat: str = "lat",
    meridian: float = CENTRAL_MERIDIAN,
) -> DataFrame:
    """Add ``lon`` and ``lat`` in degrees of an easting and northing in metres."""
    third = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    quadrant = SEMI_MAJOR * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256)
    zone_meridian = math.floor((meridian + 3) / ZONE_WIDTH) * ZONE_WIDTH - 3
    waves = (
        3 * third / 2 - 27 * third**3 / 32,
        21 * third**2 / 16 - 55 * third**4 / 32,
        151 * third**3 / 96,
        1097 * third**4 / 512,
    )
    foot = " + ".join(["_u", *[f"{_d(w)} * sin({2 * i} * _u)" for i, w in enumerate(waves, 1)]])
    east = _poly(
        "_d2",
        1,
        "-(1 + 2 * _tt + _cc) / 6D",
        f"(5 - 2 * _cc + 28 * _tt - 3 * _cc * _cc + {_d(8 * EP2)} + 24 * _tt * _tt) / 120D",
    )
    north = _poly(
        "_d2",
        1 / 2,
        f"-(5 + 3 * _tt + 10 * _cc - 4 * _cc * _cc - {_d(9 * EP2)}) / 24D",
        f"(61 + 90 * _tt + 298 * _cc + 45 * _tt * _tt - {_d(256 * EP2)} - 3 * _cc * _cc) / 720D",
    )
    steps = [
        {"_u": f"_y_in / {_d(quadrant)}"},
        {"_f": foot},
        {"_s": "sin(_f)", "_k": "cos(_f)", "_t": "tan(_f)"},
        {
            "_cc": f"_k * _k * {_d(EP2)}",
            "_tt": "_t * _t",
            "_w": f"1 - _s * _s * {_d(E2)}",
        },
        {
            "_n": f"{_d(SEMI_MAJOR)} / sqrt(_w)",
            "_r": f"{_d(SEMI_MAJOR * (1 - E2))} / (_w * sqrt(_w))",
        },
        {"_d": f"(_x_in - {_d(FALSE_EASTING)}) / _n"},
        {"_d2": "_d * _d"},
        {
            lon: f"(_d * {east} / _k + {_d(zone_meridian * DEGREE)}) / {_d(DEGREE)}",
            lat: f"(_f - _n * _t / _r * _d2 * {north}) / {_d(DEGREE)}",
        },
    ]
    return _stepwise(df, {"_x_in": x, "_y_in": y}, steps, {lon, lat})


def central_meridian(lon) -> Column:
    """Central meridian of the six-degree zone holding a longitude."""
    return ((_col(lon) / ZONE_WIDTH).cast("int") + 1) * ZONE_WIDTH - 3


def euclid(x1, y1, x2, y2) -> Column:
    dx, dy = _col(x1) - _col(x2), _col(y1) - _col(y2)
    return F.sqrt(dx * dx + dy * dy)


def manhattan(x1, y1, x2, y2) -> Column:
    return F.abs(_col(x1) - _col(x2)) + F.abs(_col(y1) - _col(y2))


def grid_index(metres, size=GRID_SIZE) -> Column:
    return (_col(metres) / size).cast("int")


def grid_code(x, y, size=GRID_SIZE, z=None) -> Column:
    """``X~Y~Z~size`` code of projected metres; Z is 0 without an altitude."""
    level = F.lit(0) if z is None else F.coalesce(grid_index(z, size), F.lit(0))
    gx, gy = grid_index(x, size), grid_index(y, size)
    return F.when(
        gx.isNotNull() & gy.isNotNull(), F.concat_ws("~", gx, gy, level, F.lit(size))
    )


def grid_code_xy(x, y, size=GRID_SIZE) -> Column:
    """``X-Y`` code of projected metres."""
    gx, gy = grid_index(x, size), grid_index(y, size)
    return F.when(gx.isNotNull() & gy.isNotNull(), F.concat_ws("-", gx, gy))


def with_grid_origin(
    df: DataFrame,
    code="grid",
    lon: str = "lon",
    lat: str = "lat",
    size=GRID_SIZE,
    meridian: float = CENTRAL_MERIDIAN,
) -> DataFrame:
    """Add longitude and latitude of the corner of an ``X-Y`` grid cell."""
    parts = F.split(_col(code), "-")
    corner = df.withColumns(
        {"_gx": parts[0].cast("double") * size, "_gy": parts[1].cast("double") * size}
    )
    return with_degrees(corner, "_gx", "_gy", lon, lat, meridian).drop("_gx", "_gy")


def with_grid_center(
    df: DataFrame,
    code="grid_code",
    lon: str = "lon",
    lat: str = "lat",
    meridian: float = CENTRAL_MERIDIAN,
) -> DataFrame:
    """Add longitude and latitude of the centre of an ``X~Y~Z~size`` grid cell."""
    parts = F.split(_col(code), "~")
    size = parts[3].cast("double")
    center = df.withColumns(
        {
            "_gx": (parts[0].cast("double") + 0.5) * size,
            "_gy": (parts[1].cast("double") + 0.5) * size,
        }
    )
    return with_degrees(center, "_gx", "_gy", lon, lat, meridian).drop("_gx", "_gy")
