"""Regular trading hours, calendar grids and right-labelled windows on exchange wall-clock time (timestamp_ntz)."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = 570, 960
#: Trading outside the session starts and ends here.
EARLY, LATE = 240, 1200
EXPECTED = {"minute": 390, "hour": 6, "day": 1}
CADENCES = ("hour", "day", "week", "month", "quarter", "year")


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def rth(df: DataFrame) -> DataFrame:
    """09:30 up to but without 16:00; by the ``session`` column where there is one."""
    if "session" in df.columns:
        return df.where(F.lower("session") == "rth")
    return df.where(minute_of_day(F.col("ts")).between(OPEN, CLOSE - 1))


def rth_closed(df: DataFrame) -> DataFrame:
    """09:30 to 16:00:00, both included."""
    return df.where(F.date_format("ts", "HH:mm:ss").between("09:30:00", "16:00:00"))


def to_exchange(ts: Column, zone: str = "America/New_York") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def minutes_since_open(ts: Column) -> Column:
    return (minute_of_day(ts) - OPEN).cast("int")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def days_of(df: DataFrame) -> DataFrame:
    return df.select("ticker", F.to_date("ts").alias("day_id")).distinct()


def minute_grid(df: DataFrame) -> DataFrame:
    """390 rows for each day that a ticker has bars on."""
    step = F.expr("interval 1 minute")
    start = midnight(F.col("day_id")) + F.expr("interval 570 minutes")
    return days_of(df).select("ticker", "day_id", F.explode(F.sequence(start, start + F.expr("interval 389 minutes"), step)).alias("ts"))


def hour_grid(df: DataFrame, half_bar: str = "drop") -> DataFrame:
    """Hours from 10:00 or, where a ticker's bars mostly start at minutes 15 to 45, from 09:30.

    Ties between minutes go to the smallest. ``half_bar``: drop, keep_half_bar or pad_to_full_hour; the last two add
    15:30 to the 09:30 grid.
    """
    if half_bar not in ("drop", "keep_half_bar", "pad_to_full_hour"):
        raise ValueError(half_bar)
    counts = df.groupBy("ticker", F.minute("ts").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy("ticker").agg(F.min_by("m", F.struct(-F.col("n"), F.col("m"))).alias("m"))
    half = F.col("m").between(15, 45)
    first = F.when(half, 570).otherwise(600)
    last = F.when(half, 930 if half_bar != "drop" else 870).otherwise(900)
    slots = F.explode(F.sequence(first, last, F.lit(60))).alias("__at")
    return days_of(df).join(mode, "ticker").select("ticker", "day_id", slots).select(
        "ticker",
        "day_id",
        (midnight(F.col("day_id")) + F.make_dt_interval(mins=F.col("__at"))).alias("ts"),
    )


def window_end(ts: Column, cadence: str) -> Column:
    """The label of the bin of ``ts``: bins are closed on the right and carry their right edge.

    hour: [H, H + 1) by its end. day: the next midnight, an exact midnight still the day before. week: the Friday.
    month, quarter, year: the last day.
    """
    d = F.to_date(ts)
    if cadence == "hour":
        return F.date_trunc("hour", ts).cast("timestamp_ntz") + F.expr("interval 1 hour")
    if cadence == "day":
        return F.date_trunc("day", ts - F.expr("interval 1 microsecond")).cast("timestamp_ntz") + F.expr("interval 1 day")
    end = {
        "week": lambda: F.next_day(F.date_sub(d, 1), "FRI"),
        "month": lambda: F.last_day(d),
        "quarter": lambda: F.last_day(F.date_add(F.trunc(d, "quarter"), 80)),
        "year": lambda: F.make_date(F.year(d), F.lit(12), F.lit(31)),
    }[cadence]()
    return midnight(end)


def end_of_hour(df: DataFrame) -> Column:
    """The end-of-hour time by the columns that are there, the most explicit first."""
    for c in ("hour_end_ts", "win_end", "end_ts", "feature_ts"):
        if c in df.columns:
            return F.col(c)
    hour = F.expr("interval 1 hour")
    if {"day_id", "hour_label"} <= set(df.columns):
        found = r"^\s*(\d{1,2})\s*:\s*(\d{2})\s*$"
        part = lambda k: F.regexp_extract("hour_label", found, k).try_cast("int")
        return midnight(F.to_date("day_id")) + F.make_dt_interval(hours=part(1), mins=part(2)) + hour
    for c in ("timestamp", "time", "ts"):
        if c in df.columns:
            return F.col(c)
    for c in ("win_start", "hour_start_ts"):
        if c in df.columns:
            return F.col(c) + hour
    raise ValueError("no time column")


def expected_bars(days: Column, sampling: str) -> Column:
    return (days * EXPECTED[sampling]).cast("bigint")


def date_spine(df: DataFrame) -> DataFrame:
    """Every day from the first to the last, by ticker."""
    ends = df.groupBy("ticker").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b"))
    return ends.select("ticker", F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day_id"))


def day_bounds(day: str) -> tuple[str, str]:
    """The start of a UTC day and of the next one, as RFC 3339 times."""
    start = datetime.fromisoformat(day).replace(tzinfo=timezone.utc)
    return tuple(t.isoformat().replace("+00:00", "Z") for t in (start, start + timedelta(days=1)))


def between_days(df: DataFrame, first: str, last: str, ts: str = "ts") -> DataFrame:
    """The rows from the start of ``first`` to the end of ``last``, on UTC wall-clock times."""
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (day_bounds(first)[0][:-1], day_bounds(last)[1][:-1]))
    return df.where((F.col(ts) >= low) & (F.col(ts) < high))


def market_status(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whether the market is open at the last time of ``df``, or at that of each of ``keys``: one row, or one for each.

    ``market`` is open in the session of a weekday, extended-hours before or after it, else closed. Rows without a
    time do not count; without any there is one row of nulls, or none where there are keys.
    """
    last = df.where(F.col("ts").isNotNull()).groupBy(*keys or []).agg(F.max("ts").alias("server_time"))
    minute, works = minute_of_day(F.col("server_time")), F.weekday("server_time") < 5
    early, late = works & minute.between(EARLY, OPEN - 1), works & minute.between(CLOSE, LATE - 1)
    market = F.when(early | late, "extended-hours").when(works & minute.between(OPEN, CLOSE - 1), "open").when(F.col("server_time").isNotNull(), "closed")
    return last.select(*keys or [], late.alias("after_hours"), early.alias("early_hours"), market.alias("market"), "server_time")
