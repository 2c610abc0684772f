"""Identifiers of cells, sites, technologies and location sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: codes used by the upstream tables ------------------------------------
MDT_TYPES = ("2",)
MR_TYPES = ("5", "6")
XDR_TYPES = ("7", "8")
SOURCES = ("MDT", "MR", "XDR")
RAT_2G = 2
RAT_4G = 6
LAC_FACTOR = 100_000
CELLS_PER_SITE = 256
LARGEST_2G_CELL = 65_535
NO_TARGET_CELL = "4294967295"
# ---- end of fixed values ----------------------------------------------------------------


def source_of(loc_type: Column) -> Column:
    """Location-type code to source name."""
    return (
        F.when(loc_type.isin(*MDT_TYPES), "MDT")
        .when(loc_type.isin(*MR_TYPES), "MR")
        .when(loc_type.isin(*XDR_TYPES), "XDR")
    )


def rat_of(cell: Column) -> Column:
    """2 for ``lac_ci`` cells, otherwise 6."""
    return F.when(cell.contains("_"), RAT_2G).otherwise(RAT_4G)


def number_or_zero(text: Column, kind: str = "bigint") -> Column:
    return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind))


def cell_number(cell: Column) -> Column:
    """One number for 2G and 4G cells; anything unreadable becomes 0."""
    parts = F.split(cell, "_")
    area = F.try_multiply(F.get(parts, 0).try_cast("bigint"), F.lit(LAC_FACTOR))
    combined = F.try_add(area, F.get(parts, 1).try_cast("bigint"))
    return F.coalesce(
        F.when(cell.contains("_"), combined).otherwise(cell.try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )


def _hex(text: Column) -> Column:
    return F.conv(F.nullif(text, F.lit("")), 16, 10).try_cast("bigint")


def voice_cell(lac: Column, cell: Column, compat: bool = False) -> Column:
    """Cell of a voice ticket: a wide cell id alone, a narrow one with its area ``lac-cell``.

    ``compat`` subtracts the two numbers instead of joining them.
    """
    number = F.coalesce(_hex(F.substring_index(cell, "|", 1)), F.lit(0).cast("bigint"))
    area = _hex(lac)
    joined = F.try_subtract(area, number).cast("string") if compat else F.concat_ws("-", area, number)
    return F.when((number <= LARGEST_2G_CELL) & area.isNotNull(), joined).otherwise(
        number.cast("string")
    )


def data_cell(lac: Column, cell: Column) -> Column:
    """Cell of a data ticket: area times 256 plus cell."""
    return F.try_add(F.try_multiply(_hex(lac), F.lit(CELLS_PER_SITE)), _hex(cell)).cast("string")


def site_of(eci: Column) -> Column:
    return F.floor(eci / CELLS_PER_SITE)
