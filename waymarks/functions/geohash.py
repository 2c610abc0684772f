"""Geohash text by integer arithmetic on the two grid indexes, without per-row Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the public geohash alphabet and the text length in use --------------
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LENGTH = 12
# ---- end of fixed values ---------------------------------------------------------------

HALF_BITS = 30


def _letters() -> str:
    """Letters by three bits of one coordinate (high) and two of the other (low).

    A letter interleaves five bits.  Letters at even places start with a longitude bit, so they
    take three longitude and two latitude bits; letters at odd places the other way round.
    """

    def woven(three: int, two: int) -> int:
        return sum(
            ((three >> (2 - j // 2)) & 1 if j % 2 == 0 else (two >> (1 - j // 2)) & 1) << (4 - j)
            for j in range(5)
        )

    return "".join(ALPHABET[woven(p >> 2, p & 3)] for p in range(32))


LETTERS = _letters()


def _index(value: Column, low: int) -> Column:
    """Index of a coordinate among 2^30 equal slices above ``low``; an edge belongs below."""
    # Edges are low + 45 * i / 2^k, so dividing by 45 first keeps them exact.
    per_45 = float(2**HALF_BITS // (-2 * low // 45))
    index = F.ceil((value - low) / 45 * per_45) - 1
    return F.least(F.greatest(index, F.lit(0)), F.lit(2**HALF_BITS - 1)).cast("long")


def encode(lon: Column, lat: Column, compat: bool = False) -> Column:
    """12-character geohash; ``compat`` swaps the two coordinates as older tables do."""
    if compat:
        lon, lat = lat, lon
    index = {"lon": _index(lon, -180), "lat": _index(lat, -90)}
    left = {"lon": HALF_BITS, "lat": HALF_BITS}

    def take(axis: str, bits: int) -> Column:
        left[axis] -= bits
        return F.shiftright(index[axis], left[axis]).bitwiseAND(F.lit(2**bits - 1))

    letters = []
    for i in range(LENGTH):
        first, second = ("lon", "lat") if i % 2 == 0 else ("lat", "lon")
        at = take(first, 3) * 4 + take(second, 2)
        letters.append(F.substring(F.lit(LETTERS), at.cast("int") + 1, F.lit(1)))
    return F.when(lon.isNotNull() & lat.isNotNull(), F.concat(*letters))


def decode(code: Column) -> tuple[Column, Column, Column, Column]:
    """Centre latitude and longitude of a geohash, and the half-height and half-width."""
    zero = F.lit(0).cast("long")

    def step(acc: Column, letter: Column) -> Column:
        at = F.instr(F.lit(LETTERS), letter).cast("long") - 1
        three, two = F.shiftright(at, 2), at.bitwiseAND(F.lit(3).cast("long"))
        even = acc["n"] % 2 == 0
        return F.struct(
            F.when(even, acc["lon"] * 8 + three).otherwise(acc["lon"] * 4 + two).alias("lon"),
            F.when(even, acc["lat"] * 4 + two).otherwise(acc["lat"] * 8 + three).alias("lat"),
            (acc["n"] + 1).alias("n"),
        )

    start = F.struct(zero.alias("lon"), zero.alias("lat"), zero.alias("n"))
    index = F.aggregate(F.filter(F.split(code, ""), lambda c: c != ""), start, step)
    bits = F.length(code) * 5
    lon_err = F.lit(180.0) / F.pow(F.lit(2.0), F.ceil(bits / 2))
    lat_err = F.lit(90.0) / F.pow(F.lit(2.0), F.floor(bits / 2))
    lon = (index["lon"] * 2 + 1) * lon_err - 180.0
    lat = (index["lat"] * 2 + 1) * lat_err - 90.0
    return lat, lon, lat_err, lon_err


def trim_to_error(value: Column, err: Column) -> Column:
    """Cut the decimals of a decoded coordinate that its error makes meaningless."""
    digits = F.greatest(F.round(-F.log10(err)), F.lit(1.0)) - 1
    unit = F.pow(F.lit(10.0), -digits)
    return value - value % unit
