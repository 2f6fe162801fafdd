"""Technical indicators of bars, per ticker in time order.

A ticker's bars are cut into ranges (barloom.functions.ranges): windows look back over a halo, recurrences carry a
state from range to range, so one long series spreads over many tasks. Each indicator splits the bars by itself, or
takes part in one split with others where it is given that split's window ``w``. Bars that come from an aggregation
are best written first, as they are read more than once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.ranges import INDEX, by_range, exponential, numbered, plain, scan, total
from barloom.functions.series import ratio, rolling


def looks_back(halo: Callable[..., int]):
    """An indicator of the last ``halo(...)`` rows before each row."""

    def of(f):
        @wraps(f)
        def run(df: DataFrame, *args: int, w: WindowSpec | None = None) -> DataFrame:
            return f(df, *args, w=w) if w is not None else by_range(df, lambda x, w: f(x, *args, w=w), halo(*args))

        return run

    return of


def change(w: WindowSpec) -> Column:
    return F.col("close") - F.lag("close").over(w)


def span(n: int) -> float:
    return 2.0 / (n + 1)


@looks_back(lambda: 1)
def pct_change(df: DataFrame, w: WindowSpec) -> DataFrame:
    return df.withColumn("ret", ratio(F.col("close"), F.lag("close").over(w)) - 1)


@looks_back(lambda n: n - 1)
def sma(df: DataFrame, n: int, w: WindowSpec) -> DataFrame:
    return df.withColumn(f"sma_{n}", rolling(F.avg, F.col("close"), w, n, 1))


def ema(df: DataFrame, *spans: int) -> DataFrame:
    return scan(df, {f"ema_{n}": exponential(F.col("close"), span(n)) for n in spans})


def rsi(df: DataFrame, n: int = 14) -> DataFrame:
    """Wilder's; no losses give null."""
    ready = INDEX in df.columns
    df = by_range(numbered(df), lambda x, w: x.withColumn("__d", change(w)), 1)
    d = F.col("__d")
    df = scan(df, {"__g": exponential(F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))), 1 / n), "__l": exponential(F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))), 1 / n)})
    df = df.withColumn(f"rsi_{n}", 100 - 100 / (1 + ratio(F.col("__g"), F.col("__l")))).drop("__d", "__g", "__l")
    return df if ready else plain(df)


@looks_back(lambda n=20: n)
def volatility(df: DataFrame, n: int = 20, *, w: WindowSpec) -> DataFrame:
    return pct_change(df, w=w).withColumn(f"volatility_{n}", rolling(F.stddev_samp, F.col("ret"), w, n, 2)).drop("ret")


@looks_back(lambda: 1)
def true_range(df: DataFrame, w: WindowSpec) -> DataFrame:
    before = F.lag("close").over(w)
    return df.withColumn("tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))


@looks_back(lambda n=14: n)
def atr(df: DataFrame, n: int = 14, *, w: WindowSpec) -> DataFrame:
    return true_range(df, w=w).withColumn(f"atr_{n}", rolling(F.avg, F.col("tr"), w, n, 1)).drop("tr")


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    ready = INDEX in df.columns
    df = scan(numbered(df), {"__f": exponential(F.col("close"), span(fast)), "__s": exponential(F.col("close"), span(slow))})
    df = df.withColumn("macd", F.col("__f") - F.col("__s")).drop("__f", "__s")
    df = scan(df, {"macd_signal": exponential(F.col("macd"), span(signal))}).withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return df if ready else plain(df)


@looks_back(lambda n=20: n - 1)
def bollinger(df: DataFrame, n: int = 20, width: float = 2.0, *, w: WindowSpec) -> DataFrame:
    df = df.withColumns({f"bb_mid_{n}": rolling(F.avg, F.col("close"), w, n, n), "__sd": rolling(F.stddev_samp, F.col("close"), w, n, n)})
    mid, half = F.col(f"bb_mid_{n}"), width * F.col("__sd")
    df = df.withColumns({f"bb_up_{n}": mid + half, f"bb_dn_{n}": mid - half})
    return df.withColumn(f"bb_bw_{n}", ratio(F.col(f"bb_up_{n}") - F.col(f"bb_dn_{n}"), mid)).drop("__sd")


@looks_back(lambda n=14, smooth=3: n + smooth - 2)
def stochastic(df: DataFrame, n: int = 14, smooth: int = 3, *, w: WindowSpec) -> DataFrame:
    low, high = rolling(F.min, F.col("low"), w, n, n), rolling(F.max, F.col("high"), w, n, n)
    df = df.withColumns({"__lo": low, "__hi": high})
    df = df.withColumn(f"stoch_k_{n}", ratio(100 * (F.col("close") - F.col("__lo")), F.col("__hi") - F.col("__lo"))).drop("__lo", "__hi")
    return df.withColumn(f"stoch_d_{n}", rolling(F.avg, F.col(f"stoch_k_{n}"), w, smooth, 1))


def obv(df: DataFrame) -> DataFrame:
    """Volume added when the close rises, taken when it falls; a null volume counts as none."""
    ready = INDEX in df.columns
    df = by_range(numbered(df), lambda x, w: x.withColumn("__v", F.coalesce(F.signum(change(w)) * F.col("volume"), F.lit(0.0))), 1)
    df = scan(df, {"obv": total(F.col("__v"))}).drop("__v")
    return df if ready else plain(df)


def grid_indicators(df: DataFrame) -> DataFrame:
    """What the merged grid takes along: range and bands, in one split."""
    return by_range(df, lambda x, w: bollinger(atr(x, w=w), w=w), 19)


def indicators(df: DataFrame) -> DataFrame:
    """The seven plain indicators."""
    df = by_range(numbered(df), lambda x, w: atr(volatility(sma(sma(x, 20, w=w), 50, w=w), w=w), w=w), 49)
    return plain(rsi(ema(df, 12, 26)))


def custom_indicators(df: DataFrame) -> DataFrame:
    """The ten others."""
    return plain(obv(macd(by_range(numbered(df), lambda x, w: stochastic(bollinger(x, w=w), w=w), 19))))
