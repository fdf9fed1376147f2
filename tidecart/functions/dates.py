"""Timestamp and date parsing with each row's own offset, and the calendar parts taken from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: `2019-03-01 10:20:30 +0530`, offset with or without a colon, or Z.
_ZONED = r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}) (?:([+-]\d{2}):?(\d{2})|(Z))\z"
_SHORT_DATE = r"^(\d{1,2})-(\d{1,2})-(\d{2})\z"


def parse_zoned_timestamp(c: Column) -> Column:
    """The instant, or null for anything that is not exactly a date, a time and an offset."""
    glued = F.when(c.endswith("Z"), F.regexp_replace(c, _ZONED, "$1Z")).otherwise(
        F.regexp_replace(c, _ZONED, "$1$2:$3")
    )
    return F.when(c.rlike(_ZONED), glued.try_cast("timestamp"))


def zoned_wall_clock(c: Column) -> Column:
    """The clock reading in the row's own offset; null whenever the instant is null."""
    wall = F.regexp_extract(c, _ZONED, 1).try_cast("timestamp_ntz")
    return F.when(parse_zoned_timestamp(c).isNotNull(), wall)


def parse_any_timestamp(c: Column) -> Column:
    """Format-free variant: the zoned form first, then whatever Spark's own cast reads."""
    return F.coalesce(parse_zoned_timestamp(c), c.try_cast("timestamp"))


def any_wall_clock(c: Column) -> Column:
    return F.coalesce(zoned_wall_clock(c), c.try_cast("timestamp_ntz"))


def parse_short_date(c: Column) -> Column:
    """``month-day-year`` with a two-digit year: 69-99 is 19xx, 00-68 is 20xx."""
    late = F.regexp_replace(c, _SHORT_DATE, "20$3-$1-$2")
    early = F.regexp_replace(c, _SHORT_DATE, "19$3-$1-$2")
    year = F.when(c.rlike(r"-(69|[7-9]\d)\z"), early).otherwise(late)
    return F.when(c.rlike(_SHORT_DATE), year.try_cast("date"))


def crawl_parts(wall: Column) -> dict[str, Column]:
    """Year, month, day and weekday (Monday is 0) of a wall-clock reading."""
    return {
        "crawl_year": F.year(wall),
        "crawl_month": F.month(wall),
        "crawl_day": F.dayofmonth(wall),
        "crawl_dayofweek": F.weekday(wall),
    }


def purchase_parts(day: Column) -> dict[str, Column]:
    return {
        "Year": F.year(day),
        "Month": F.month(day),
        "DayOfWeek": F.date_format(day, "EEEE"),
    }
