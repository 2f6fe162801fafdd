"""Daily and windowed aggregates of the merged grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions import runs
from barloom.functions.series import ratio
from barloom.operators import calendar

KEYS = ["ticker", "day_id"]
#: Columns that say how much a row counts; they are summed or left out, never averaged.
SKIPPED = {"AGG_N", "valid_bars", "expected_bars", "days", "cover_ratio"}


def masked_corr(x: Column, y: Column, valid: Column) -> Column:
    """Pearson over the valid rows; null where one is constant."""
    a, b = F.when(valid, x), F.when(valid, y)
    return F.when(F.count(a) >= 2, ratio(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def gated_sum(r: Column, inside: Column, least: float) -> tuple[Column, Column]:
    share = F.coalesce(ratio(F.count(F.when(inside, r)).cast("double"), F.count_if(inside).cast("double")), F.lit(0.0))
    return F.when((F.count_if(inside) > 0) & (share >= least), F.coalesce(F.sum(F.when(inside, r)), F.lit(0.0))), share


def daily(df: DataFrame, keys: list[str] | None = None, least: float = 0.5, least_run: int = 5) -> DataFrame:
    """One row a day (or of other ``keys``) with quality, return, trend, spread and volume features.

    The window and the aggregate share one partitioning on the keys. Runs are found in the aggregate.
    """
    keys = keys or KEYS
    tod, r, vol, svn, vz = (F.col(c) for c in ("minutes_since_open", "r_close", "volume", "spread_vwap_norm", "volume_z_by_tod"))
    first, last = tod.between(0, 14), tod.between(380, 389)
    cum = F.sum(F.coalesce(r, F.lit(0.0))).over(W.partitionBy(*keys).orderBy("ts").rowsBetween(W.unboundedPreceding, 0))
    df = df.withColumn("__cum", cum)
    states = runs.in_order("ts", gap=F.when(F.col("is_gap") == 1, 1.0), trend=F.when(r != 0, F.signum(r)))
    n, valid = F.count(F.lit(1)), F.count(r)
    open15, open15_ratio = gated_sum(r, first, least)
    last10, last10_ratio = gated_sum(r, last, least)
    flat = df.groupBy(*keys).agg(
        F.avg("is_gap").alias("AGG_gap_ratio"), n.alias("AGG_N"), valid.alias("valid_bars"), (valid / n).alias("valid_ratio_day"),
        F.sum(r).alias("ret_oc"), F.sum(r * r).alias("rv"), open15.alias("ret_open15"), last10.alias("ret_last10"),
        F.when(valid / n >= least, masked_corr(tod.cast("double"), F.col("__cum"), r.isNotNull())).alias("reversal_score"),
        F.avg(F.abs(svn)).alias("mabs_svn"), F.max_by(svn, F.when(svn.isNotNull(), F.col("ts"))).alias("eod_svn"),
        F.when(F.sum(vol) > 0, F.sum(F.when(last, vol)) / F.sum(vol)).alias("vol_last10_frac"), F.avg(F.when(vz.isNotNull(), (vz > 2).cast("double"))).alias("hi2_frac"),
        open15_ratio.alias("open15_valid_ratio"), last10_ratio.alias("last10_valid_ratio"), (valid / n).alias("reversal_valid_ratio"),
        states.alias("__states"),
    )
    longest = lambda c: runs.of_states(F.col(f"__states.{c}"))["best"]
    trend = F.when(F.col("valid_bars") >= least_run, longest("trend"))
    return flat.withColumns({"AGG_max_consecutive_gap": longest("gap"), "trend_persistence": trend}).drop("__states")


def reduce_windows(days: DataFrame, cadence: str, reducer: str = "median", sampling: str = "day") -> DataFrame:
    """Daily rows over windows: median, mean or mean weighted by valid_bars; nulls are left out.

    Every numeric column is reduced but those that say how much a row counts (SKIPPED).
    """
    numeric = [c for c, t in days.dtypes if t in ("double", "int", "bigint", "float") and c not in SKIPPED]
    valid, expected = F.sum("valid_bars"), calendar.expected_bars(F.count(F.lit(1)), sampling)

    def reduced(c: str) -> Column:
        x, w = F.col(c).cast("double"), F.col("valid_bars").cast("double")
        if reducer == "weighted_mean":
            return ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))
        return {"median": F.median, "mean": F.avg}[reducer](x)

    ends = calendar.window_end(calendar.midnight(F.col("day_id")) + F.expr("interval 1 microsecond"), cadence)
    return days.groupBy("ticker", F.lit(cadence).alias("window_cadence"), ends.alias("win_end")).agg(
        calendar.midnight(F.min("day_id")).alias("win_start"), F.count(F.lit(1)).alias("days"), expected.alias("expected_bars"), valid.alias("valid_bars"),
        ratio(valid.cast("double"), expected.cast("double")).alias("cover_ratio"), *[reduced(c).alias(c) for c in numeric],
    )


def window_quality(df: DataFrame, column: str, cadence: str, sampling: str, gap_share: float, gap_run: int, least_share: float, least: int) -> DataFrame:
    """By window: values, gap share (below 0 where there are more bars than expected), longest gap, and whether they pass."""
    return window_qualities(df, [column], cadence, sampling, gap_share, gap_run, least_share, least).drop("series")


def window_qualities(df: DataFrame, columns: list[str], cadence: str, sampling: str, gap_share: float, gap_run: int, least_share: float, least: int) -> DataFrame:
    """window_quality of every column, named by ``series``: days are summed up first, then the days of a window."""
    keys = ["ticker", "win_end"]
    df = df.withColumn("win_end", calendar.window_end(F.col("ts"), cadence)).withColumn("day", F.to_date("ts"))
    states = {f"s{k}": F.when(F.col(c).isNull(), 1.0) for k, c in enumerate(columns)}
    days = df.groupBy(*keys, "day").agg(F.min("ts").alias("start"), runs.in_order("ts", **states).alias("rows"), *(F.count(c).alias(f"n{k}") for k, c in enumerate(columns)))
    found = {f"r{k}": runs.of_states(F.col(f"rows.s{k}")) for k in range(len(columns))}
    flat = days.groupBy(*keys).agg(
        F.min("start").alias("win_start"),
        F.count("day").alias("days"),
        runs.in_order("day", **found).alias("runs"),
        *(F.sum(f"n{k}").alias(f"n{k}") for k in range(len(columns))),
    )
    each = [
        F.struct(F.lit(c).alias("series"), F.col(f"n{k}").alias("n_valid"), runs.of_summaries(F.col(f"runs.r{k}"))["best"].alias("max_gap_run"))
        for k, c in enumerate(columns)
    ]
    return judged(flat.select(*keys, "win_start", "days", F.inline(F.array(*each))), sampling, gap_share, gap_run, least_share, least)


def judged(flat: DataFrame, sampling: str, gap_share: float, gap_run: int, least_share: float, least: int) -> DataFrame:
    """``flat`` (days, n_valid, max_gap_run) with expected bars, gap share, and whether they pass."""
    flat = flat.withColumn("expected_bars", calendar.expected_bars(F.col("days"), sampling))
    share = F.col("n_valid") / F.col("expected_bars")
    flat = flat.withColumn("gap_ratio", 1 - share)
    passed = (share >= least_share) & (F.col("gap_ratio") <= gap_share) & (F.col("max_gap_run") <= gap_run) & (F.col("n_valid") >= least)
    return flat.withColumn("passed", passed)


def _spread_of(parts: Column) -> Column:
    """The population deviation of all values of ``parts`` (n, mean, var), put together one after the other."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        both = F.struct(n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"), (a["m2"] + b["var"] * b["n"] + gap * gap * a["n"] * b["n"] / n).alias("m2"))
        return F.when(b["n"] > 0, both).otherwise(a)

    return F.aggregate(parts, start, add, lambda a: F.sqrt(ratio(a["m2"], a["n"].cast("double"))))


def low_confidence(df: DataFrame, column: str, cadence: str, gap: float = 0.10, run: int = 30, least: int = 300, flat: float = 1e-8) -> DataFrame:
    """By window: rows, share and longest run of gaps, whether ``column`` is flat, and the older flag of low confidence.

    A flat column has no features worth the name, so its window counts as low however few its gaps are.
    """
    keys = ["ticker", "win_end"]
    df = df.withColumn("win_end", calendar.window_end(F.col("ts"), cadence)).withColumn("day", F.to_date("ts"))
    days = df.groupBy(*keys, "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_gap").alias("gaps"),
        F.count(column).alias("k"),
        F.avg(column).alias("mean"),
        F.var_pop(column).alias("var"),
        runs.in_order("ts", s=F.when(F.col("is_gap") == 1, 1.0)).alias("rows"),
    )
    part = F.struct(F.col("k").alias("n"), "mean", "var")
    flag = days.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("gaps").alias("gaps"), runs.in_order("day", r=runs.of_states(F.col("rows.s")), p=part).alias("parts"))
    flag = flag.select(
        *keys,
        "n",
        (F.col("gaps") / F.col("n")).alias("gap_ratio"),
        runs.of_summaries(F.col("parts.r"))["best"].alias("max_gap_run"),
        F.coalesce(_spread_of(F.col("parts.p")) < flat, F.lit(True)).alias("degenerate"),
    )
    low = (F.col("gap_ratio") > gap) | (F.col("max_gap_run") > run) | (F.col("n") < least) | F.col("degenerate")
    return flag.withColumn("low_conf", low.cast("int"))


def open_close(ticks: DataFrame) -> DataFrame:
    """One row a day: prices of the regular session, all volume, the first price before it and the last after it."""
    minute = calendar.minute_of_day(F.col("ts"))
    inside, at, price = minute.between(calendar.OPEN, calendar.CLOSE - 1), F.struct("ts", "seq"), F.col("price")
    return ticks.groupBy("ticker", F.to_date("ts").alias("day_id")).agg(
        F.min_by(price, F.when(inside, at)).alias("open"), F.max_by(price, F.when(inside, at)).alias("close"),
        F.max(F.when(inside, price)).alias("high"), F.min(F.when(inside, price)).alias("low"), F.sum("size").alias("volume"),
        F.max_by(price, F.when(minute >= calendar.CLOSE, at)).alias("afterHours"), F.min_by(price, F.when(minute < calendar.OPEN, at)).alias("preMarket"),
    )
