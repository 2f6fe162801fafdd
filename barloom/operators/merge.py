"""From bars to the aligned grid: joins, limited fills, repaired returns, quality and normalised columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.series import backward_fill, forward_fill, open_log, positive_log, ratio, series, two_sided_fill
from barloom.operators import calendar
from barloom.sources.tables import PRICES, with_missing

FILL, RETURN_FILL, RETURN_EXTRA, RETURN_VALID = 3, 1, 2, 0.70


def in_day() -> WindowSpec:
    return series("ticker", "day_id")


def whole_day() -> WindowSpec:
    return W.partitionBy("ticker", "day_id")


def keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Of the rows of a key, the last by ``seq``."""
    w = W.partitionBy(*keys).orderBy(F.col(seq).desc())
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def align(grid: DataFrame, bars: DataFrame) -> DataFrame:
    """The grid's rows with what the bars have there; bars off the grid go."""
    return grid.join(bars, ["ticker", "ts"], "left")


def align_outer(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, ["ticker", "ts"], "full_outer")


def gap_flag(df: DataFrame) -> DataFrame:
    lost = F.lit(False)
    for c in PRICES:
        lost = lost | F.col(c).isNull()
    return df.withColumn("is_gap", lost.cast("int"))


def fill(df: DataFrame, limit: int = FILL) -> DataFrame:
    """Every numeric column filled from both sides inside its day; a limit of 0 fills nothing."""
    numeric = [c for c, t in df.dtypes if t in ("double", "bigint", "int", "float") and c != "is_gap"]
    return df.withColumns({c: two_sided_fill(F.col(c).cast("double"), in_day(), limit) for c in numeric}) if limit else df


def fill_forward_backward(df: DataFrame, column: str, limit: int, out: str) -> DataFrame:
    """Forward, then backward over what that left."""
    return df.withColumn(out, forward_fill(F.col(column), in_day(), limit)).withColumn(out, backward_fill(F.col(out), in_day(), limit))


def log_return(df: DataFrame, close: str = "close", out: str = "r", zeros: bool = False) -> DataFrame:
    """The first bar of a day is 0; prices that are not positive count as missing, or with ``zeros`` those below zero."""
    p = (open_log if zeros else positive_log)(F.col(close))
    return df.withColumn(out, F.when(F.row_number().over(in_day()) == 1, F.lit(0.0)).otherwise(p - F.lag(p).over(in_day())))


def repaired_return(df: DataFrame, limit: int = RETURN_FILL, extra: int = RETURN_EXTRA, least: float = RETURN_VALID) -> DataFrame:
    """``r_close`` and ``rclose_limit_used``: a larger fill only for days short of values, and only where it adds some."""
    for k in (limit, extra):
        df = log_return(fill_forward_backward(df, "close", k, f"__c{k}"), f"__c{k}", f"__r{k}")
    n = F.count(F.lit(1)).over(whole_day())
    df = df.withColumns({f"__v{k}": F.count(f"__r{k}").over(whole_day()) / n for k in (limit, extra)})
    better = (F.col(f"__v{limit}") < least) & (F.col(f"__v{extra}") > F.col(f"__v{limit}")) & F.lit(extra > limit)
    df = df.withColumns({"r_close": F.when(better, F.col(f"__r{extra}")).otherwise(F.col(f"__r{limit}")), "rclose_limit_used": F.when(better, extra).otherwise(limit)})
    return df.drop(*[f"__{x}{k}" for k in (limit, extra) for x in "crv"])


def return_quality(df: DataFrame) -> DataFrame:
    """One row a day of what repaired_return gave."""
    n = F.count(F.lit(1))
    return df.groupBy("ticker", "day_id").agg((F.count("r_close") / n).alias("rclose_valid_ratio"), F.max("rclose_limit_used").alias("rclose_limit_used"), n.alias("N"))


def quality_summary(quality: DataFrame, least: float = RETURN_VALID) -> DataFrame:
    r = F.col("rclose_valid_ratio")
    return quality.groupBy("ticker").agg(F.median(r).alias("median_valid"), F.min(r).alias("min_valid"), F.count_if(r < least).alias("days_below"))


def position(df: DataFrame) -> DataFrame:
    return df.withColumn("bar_index_since_open", (F.row_number().over(in_day()) - 1).cast("int"))


def volume_z(df: DataFrame) -> DataFrame:
    """The volume's z-score among all days' bars at the same place in the day; 0 where there is none."""
    at = W.partitionBy("ticker", "bar_index_since_open")
    z = ratio(F.col("volume") - F.avg("volume").over(at), F.stddev_samp("volume").over(at))
    return df.withColumn("volume_z_by_tod", F.coalesce(z, F.lit(0.0)))


def spread(df: DataFrame) -> DataFrame:
    df = df.withColumns({"spread_vwap": F.col("close") - F.col("vwap"), "ATR_14_day_mean": F.avg("atr_14").over(whole_day())})
    return df.withColumn("spread_vwap_norm", ratio(F.col("spread_vwap"), F.col("ATR_14_day_mean")))


def merged(bars: DataFrame, extra: list[str], sampling: str = "hour", half_bar: str = "drop", fill_return: int = RETURN_FILL, fill_more: int = RETURN_EXTRA) -> DataFrame:
    """Bars with indicators on the grid of their sampling, in the order: gaps marked, filled, then derived.

    ``bars`` has PRICES and the ``extra`` indicator columns. Bars without a time go.
    """
    inside = calendar.rth(bars.where(F.col("ts").isNotNull()))
    grid = {"minute": calendar.minute_grid, "hour": lambda x: calendar.hour_grid(x, half_bar)}[sampling](inside)
    df = fill(gap_flag(align(grid, inside.select("ticker", "ts", *PRICES, *extra))))
    df = position(df).withColumns({"session": F.lit("rth"), "minutes_since_open": calendar.minutes_since_open(F.col("ts"))})
    return volume_z(spread(repaired_return(df, fill_return, fill_more)))


def merged_days(bars: DataFrame, extra: list[str]) -> DataFrame:
    """Day sampling: no grid, no fill, session 'day', no intraday return; the day's range is its own mean."""
    df = gap_flag(bars.select("ticker", "ts", F.to_date("ts").alias("day_id"), *PRICES, *extra))
    df = df.withColumns({"session": F.lit("day"), "bar_index_since_open": F.lit(0), "spread_vwap": F.col("close") - F.col("vwap"), "r_close": F.lit(None).cast("double")})
    df = with_missing(df, ["atr_14", "minutes_since_open", "volume_z_by_tod"]).withColumn("ATR_14_day_mean", F.col("atr_14"))
    return df.withColumn("spread_vwap_norm", ratio(F.col("spread_vwap"), F.col("ATR_14_day_mean")))
