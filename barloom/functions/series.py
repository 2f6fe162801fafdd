"""Column expressions over ordered series: bounded frames, limited fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def series(*keys: str, ts: str = "ts") -> WindowSpec:
    return W.partitionBy(*keys).orderBy(ts)


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def rolling(agg, x: Column, w: WindowSpec, n: int, least: int) -> Column:
    """``agg`` of the last n rows, null until ``least`` of them are not null."""
    frame = last_rows(w, n)
    return F.when(F.count(x).over(frame) >= least, agg(x).over(frame))


def forward_fill(x: Column, w: WindowSpec, limit: int) -> Column:
    return F.last(x, ignorenulls=True).over(w.rowsBetween(-limit, 0))


def backward_fill(x: Column, w: WindowSpec, limit: int) -> Column:
    return F.first(x, ignorenulls=True).over(w.rowsBetween(0, limit))


def two_sided_fill(x: Column, w: WindowSpec, limit: int) -> Column:
    """The mean of both sides' fills, or the one there is: the first and last ``limit`` rows of a gap."""
    f, b = forward_fill(x, w, limit), backward_fill(x, w, limit)
    return F.coalesce(x, (f + b) / 2, f, b)


def positive_log(x: Column) -> Column:
    return F.when(x > 0, F.ln(x))


def open_log(x: Column) -> Column:
    """Minus infinity at zero, as numpy and SQL have it; missing below."""
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(float("-inf")))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def number(x: Column) -> Column:
    """``x`` as a double; what is no finite number is null."""
    made = x.try_cast("double")
    return F.when(finite(made), made)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Double columns at ``digits`` places, without negative zeros."""
    return df.select(*[(F.round(c, digits) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
