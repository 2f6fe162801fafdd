"""Long series cut into ranges of equal length, so that one series spreads over many tasks.

``numbered`` counts the rows of a series without a sort of the whole: rows are counted by day, the days' counts are
summed up, and rows are numbered inside their day. A range is so many rows that follow each other, whatever the gaps in
time between them. Window functions need the few rows before a range as well: these are copied into it (the halo) and
left out again. Recurrences carry a state over: each range gives a summary, the summaries are folded, and what stands
before a range goes back to it.

Keys are compared as a struct, so a null key is a series of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import cut

#: Rows of a range, at most.
ROWS = 1 << 12
#: Summaries that are folded together.
WIDTH = 1 << 9
#: Most that a weight of a recurrence may grow inside a range, as a power of e: far from a double's limit.
GROWTH = 300
KEY, INDEX, RANGE = "__key", "__index", "__range"


def numbered(df: DataFrame, keys: tuple[str, ...] = ("ticker",), ts: str = "ts") -> DataFrame:
    """``df`` with its key as a struct and the place of each row in its series, from 0; rows without a time come first. What is numbered stays so."""
    if INDEX in df.columns:
        return df
    key = F.struct(*keys)
    df = df.withColumn("__day", F.struct(key.alias("key"), F.to_date(ts).alias("day")))
    days = df.groupBy("__day").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("__day.key").orderBy("__day.day").rowsBetween(W.unboundedPreceding, -1))
    df = df.join(days.select("__day", F.coalesce(before, F.lit(0)).alias("__before")), "__day")
    place = F.row_number().over(W.partitionBy("__day").orderBy(ts))
    return df.withColumn(INDEX, F.col("__before") + place - 1).withColumn(KEY, F.col("__day.key")).drop("__day", "__before")


def plain(df: DataFrame) -> DataFrame:
    return df.drop(KEY, INDEX, RANGE)


def by_range(df: DataFrame, f: Callable[[DataFrame, WindowSpec], DataFrame], halo: int, keys: tuple[str, ...] = ("ticker",), ts: str = "ts", rows: int | None = None) -> DataFrame:
    """``f(df, w)`` for window functions that look back at most ``halo`` rows over ``w``, range by range."""
    rows = rows or ROWS
    ready = INDEX in df.columns
    df = numbered(df, keys, ts)
    own = F.floor(F.col(INDEX) / rows)
    df = df.withColumn(RANGE, F.explode(F.sequence(own, F.floor((F.col(INDEX) + halo) / rows))))
    df = f(df, W.partitionBy(KEY, RANGE).orderBy(INDEX)).where(F.col(RANGE) == own).drop(RANGE)
    return df if ready else plain(df)


@dataclass(frozen=True)
class Fold:
    """y = y * keep + x * gain over the values x that are not null; it starts at the first value, or at 0."""

    x: Column
    keep: float
    gain: float
    from_first: bool

    @property
    def rows(self) -> int:
        return math.floor(GROWTH / -math.log(self.keep)) if 0 < self.keep < 1 else ROWS


def exponential(x: Column, alpha: float) -> Fold:
    return Fold(x, 1 - alpha, alpha, True)


def total(x: Column) -> Fold:
    return Fold(x, 1.0, 1.0, False)


def _folded(f: Fold, entries: Column) -> Column:
    """The end of a fold over summaries (n, b) in order, from 0."""
    return F.aggregate(entries, F.lit(0.0), lambda y, e: y * F.pow(F.lit(f.keep), e["n"]) + e["b"])


def _before(folds: list[Fold], w: WindowSpec) -> dict[str, Column]:
    """Of every fold what the summaries before a row give: values, end from 0, first value."""
    out = {}
    for k, f in enumerate(folds):
        out[f"__n{k}"] = F.coalesce(F.sum(f"n{k}").over(w), F.lit(0))
        out[f"__f{k}"] = F.first(f"f{k}", ignorenulls=True).over(w)
        entries = F.collect_list(F.struct(F.col(f"n{k}").alias("n"), F.col(f"b{k}").alias("b"))).over(w)
        out[f"__b{k}"] = F.coalesce(F.sum(f"b{k}").over(w), F.lit(0.0)) if f.keep == 1 else _folded(f, entries)
    return out


def _carried(parts: DataFrame, folds: list[Fold]) -> DataFrame:
    """(KEY, RANGE, start of every fold): ``parts`` has n, b and f of each range; they are folded WIDTH at a time."""
    parts = parts.withColumn("__over", F.floor(F.col(RANGE) / WIDTH))
    near = parts.withColumns(_before(folds, W.partitionBy(KEY, "__over").orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)))
    made = []
    for k, f in enumerate(folds):
        entries = F.sort_array(F.collect_list(F.struct(F.col(RANGE).alias("at"), F.col(f"n{k}").alias("n"), F.col(f"b{k}").alias("b"))))
        end = F.sum(f"b{k}") if f.keep == 1 else _folded(f, entries)
        made += [F.sum(f"n{k}").alias(f"n{k}"), end.alias(f"b{k}"), F.min_by(f"f{k}", F.when(F.col(f"f{k}").isNotNull(), F.col(RANGE))).alias(f"f{k}")]
    far = parts.groupBy(KEY, "__over").agg(*made)
    far = far.select(KEY, "__over", *(c.alias(f"__far{n}") for n, c in _before(folds, W.partitionBy(KEY).orderBy("__over").rowsBetween(W.unboundedPreceding, -1)).items()))
    both = near.join(far, [KEY, "__over"])
    starts = []
    for k, f in enumerate(folds):
        n, far_n, first = F.col(f"__n{k}"), F.col(f"__far__n{k}"), F.coalesce(f"__far__f{k}", f"__f{k}")
        end = F.pow(F.lit(f.keep), n) * F.col(f"__far__b{k}") + F.col(f"__b{k}")
        starts.append((F.when(n + far_n > 0, F.pow(F.lit(f.keep), n + far_n) * first + end) if f.from_first else end).alias(f"__start{k}"))
    return both.select(KEY, RANGE, *starts)


def scan(df: DataFrame, folds: dict[str, Fold], keys: tuple[str, ...] = ("ticker",), ts: str = "ts", rows: int | None = None) -> DataFrame:
    """``df`` with a column for every fold, null until its first value where it starts there.

    Inside a range a recurrence is a prefix sum of weighted values. These are written once: the last row of a range is
    its summary (how many values it has, where the recurrence ends from 0, its first value). The summaries are folded
    exactly, so all values count, however long the series, and each range gets its start back. No row holds more than
    that, and a scan of a scan reads its input once.
    """
    ready = INDEX in df.columns
    df = numbered(df, keys, ts)
    of = list(folds.values())
    rows = max(1, min([rows or ROWS, *(f.rows for f in of)]))
    w = W.partitionBy(KEY, RANGE).orderBy(INDEX).rowsBetween(W.unboundedPreceding, 0)
    df = df.withColumn(RANGE, F.floor(F.col(INDEX) / rows)).withColumns({f"__x{k}": f.x.cast("double") for k, f in enumerate(of)})
    df = df.withColumns({f"__n{k}": F.count(f"__x{k}").over(w) for k in range(len(of))})
    local = {}
    for k, f in enumerate(of):
        x, n = F.col(f"__x{k}") * f.gain, F.col(f"__n{k}")
        if f.keep == 0:
            y = F.last(x, ignorenulls=True).over(w)
        elif f.keep == 1:
            y = F.sum(x).over(w)
        else:
            y = F.sum(x * F.pow(F.lit(f.keep), -n)).over(w) * F.pow(F.lit(f.keep), n)
        local[f"__y{k}"] = F.coalesce(y, F.lit(0.0))
    firsts = {f"__f{k}": F.first(f"__x{k}", ignorenulls=True).over(w) for k in range(len(of))}
    last = F.lead(INDEX).over(W.partitionBy(KEY, RANGE).orderBy(INDEX)).isNull()
    df = cut(df.withColumns(local | firsts).withColumn("__last", last).drop(*(f"__x{k}" for k in range(len(of)))), "scan")
    ends = df.where("__last").select(KEY, RANGE, *(F.col(f"__{c}{k}").alias(f"{n}{k}") for k in range(len(of)) for c, n in (("n", "n"), ("y", "b"), ("f", "f"))))
    df = df.join(_carried(ends, of), [KEY, RANGE])
    out = {}
    for k, (name, f) in enumerate(folds.items()):
        start = F.coalesce(f"__start{k}", f"__f{k}") if f.from_first else F.col(f"__start{k}")
        out[name] = F.pow(F.lit(f.keep), F.col(f"__n{k}")) * start + F.col(f"__y{k}")
    df = df.withColumns(out).drop(RANGE, "__last", *(f"__{c}{k}" for k in range(len(of)) for c in ("n", "y", "f", "start")))
    return df if ready else plain(df)
