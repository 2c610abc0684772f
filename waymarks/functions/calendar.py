"""Calendar columns derived from epoch milliseconds.

A job works in one fixed-offset zone, given as a ``Clock``.  Everything is integer
arithmetic, so results do not depend on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND_MS = 1_000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def whole(value: Column, unit: int) -> Column:
    """Integer division, rounding towards minus infinity."""
    return F.floor(value / F.lit(unit))


@dataclass(frozen=True)
class Clock:
    """Wall clock at a fixed offset from UTC."""

    offset_hours: int = 8

    def _wall(self, ms: Column) -> Column:
        return ms + F.lit(self.offset_hours * HOUR_MS)

    def day(self, ms: Column) -> Column:
        return F.date_from_unix_date(whole(self._wall(ms), DAY_MS).cast("int"))

    def day_text(self, ms: Column, pattern: str = "yyyy-MM-dd") -> Column:
        return F.date_format(self.day(ms), pattern)

    def hour(self, ms: Column) -> Column:
        return F.pmod(whole(self._wall(ms), HOUR_MS), F.lit(24)).cast("int")

    def minute(self, ms: Column) -> Column:
        return F.pmod(whole(self._wall(ms), MINUTE_MS), F.lit(60)).cast("int")

    def second(self, ms: Column) -> Column:
        return F.pmod(whole(self._wall(ms), SECOND_MS), F.lit(60)).cast("int")

    def iso_weekday(self, ms: Column) -> Column:
        """1 for Monday to 7 for Sunday."""
        return (F.weekday(self.day(ms)) + 1).cast("int")

    def is_rest_day(self, ms: Column) -> Column:
        return self.iso_weekday(ms) >= 6

    def hour_start(self, ms: Column) -> Column:
        """Epoch milliseconds of the start of the hour."""
        return whole(self._wall(ms), HOUR_MS) * HOUR_MS - self.offset_hours * HOUR_MS

    def hour_label(self, ms: Column) -> Column:
        return F.concat(
            self.day_text(ms, "yyyyMMdd"),
            F.lit(" "),
            F.lpad(self.hour(ms).cast("string"), 2, "0"),
            F.lit(":00:00"),
        )

    def minute_label(self, ms: Column) -> Column:
        return F.concat(
            self.day_text(ms),
            F.lit(" "),
            F.lpad(self.hour(ms).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad(self.minute(ms).cast("string"), 2, "0"),
        )

    def second_label(self, ms: Column) -> Column:
        return F.concat(
            self.minute_label(ms), F.lit(":"), F.lpad(self.second(ms).cast("string"), 2, "0")
        )

    def hour_range(self, ms: Column) -> Column:
        """``HH-HH`` label of the hour and the one after it."""
        hour = self.hour(ms)
        return F.concat(
            F.lpad(hour.cast("string"), 2, "0"),
            F.lit("-"),
            F.lpad((hour + 1).cast("string"), 2, "0"),
        )

    def parse(self, text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
        """Epoch milliseconds of a date-time text; NULL when it does not parse.

        The text is read as UTC, so the session's zone and its clock changes play no part.
        """
        utc = F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{pattern} xxx"))
        return F.unix_millis(utc) - self.offset_hours * HOUR_MS

    def day_ms(self, day_text: Column) -> Column:
        """Epoch milliseconds of midnight of a ``yyyy-MM-dd`` day."""
        return (
            F.unix_date(F.to_date(day_text)).cast("long") * DAY_MS - self.offset_hours * HOUR_MS
        )


def wall_ms(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 00:00 of a timestamp's wall-clock reading."""
    seconds_of_day = F.hour(ts) * 3600 + F.minute(ts) * 60
    millis = F.floor(F.extract(F.lit("SECOND"), ts).cast("decimal(8,6)") * 1000)
    return (
        F.unix_date(F.to_date(ts)).cast("long") * DAY_MS
        + seconds_of_day.cast("long") * SECOND_MS
        + millis.cast("long")
    )


SHANGHAI = Clock(8)
UTC = Clock(0)


def calendar_enrich(stays: DataFrame, clock: Clock = SHANGHAI, ms: str = "s_time") -> DataFrame:
    """Add hour, minute, second, ISO weekday, rest-day flag and labels to a stay table."""
    t = F.col(ms)
    return stays.select(
        "*",
        clock.hour(t).alias("hour"),
        clock.minute(t).alias("minute"),
        clock.second(t).alias("second"),
        clock.iso_weekday(t).alias("weekday"),
        clock.is_rest_day(t).alias("rest_day"),
        clock.day_text(t, "yyyyMMdd").alias("day_compact"),
        clock.minute_label(t).alias("minute_label"),
        clock.hour_label(t).alias("hour_label"),
        clock.hour_range(t).alias("hour_range"),
    )
