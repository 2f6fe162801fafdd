"""Longest runs of equal states by summaries that combine: no windows, and no sort of more than a chunk.

A summary of rows that follow each other has how many they are, the runs at their start and end, the longest run, and
the states at both ends. Two summaries in order make that of both, so runs are found chunk by chunk (a day) and the
chunks' summaries are put together, however long the whole is. Null states break runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _summary(n: Column, head: Column, tail: Column, best: Column, first: Column, last: Column) -> Column:
    counts = [x.cast("bigint").alias(c) for c, x in (("n", n), ("head", head), ("tail", tail), ("best", best))]
    return F.struct(*counts, first.cast("double").alias("first"), last.cast("double").alias("last"))


def nothing() -> Column:
    return _summary(*[F.lit(0)] * 4, F.lit(None), F.lit(None))


def single(state: Column) -> Column:
    run = state.isNotNull().cast("int")
    return _summary(F.lit(1), run, run, run, state, state)


def merge(a: Column, b: Column) -> Column:
    """The summary of the rows of ``a`` and then those of ``b``."""
    joined = F.coalesce(a["last"] == b["first"], F.lit(False))
    head = F.when((a["head"] == a["n"]) & (joined | (a["n"] == 0)), a["n"] + b["head"]).otherwise(a["head"])
    tail = F.when((b["tail"] == b["n"]) & (joined | (b["n"] == 0)), b["n"] + a["tail"]).otherwise(b["tail"])
    best = F.greatest(a["best"], b["best"], F.when(joined, a["tail"] + b["head"]).otherwise(0))
    first, last = F.when(a["n"] == 0, b["first"]).otherwise(a["first"]), F.when(b["n"] == 0, a["last"]).otherwise(b["last"])
    return _summary(a["n"] + b["n"], head, tail, best, first, last)


def of_states(states: Column) -> Column:
    """The summary of an array of states."""
    return F.aggregate(states, nothing(), lambda a, s: merge(a, single(s)))


def of_summaries(found: Column) -> Column:
    return F.aggregate(found, nothing(), merge)


def in_order(at: str, **values: Column) -> Column:
    """An aggregate: ``values`` of a group's rows as an array of structs, in the order of ``at``."""
    return F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), *(v.alias(k) for k, v in values.items()))))


def longest_runs(df: DataFrame, keys: list[str], state: Column, name: str, ts: str = "ts") -> DataFrame:
    """By keys, the longest run of rows with one non-null ``state``; none: 0."""
    days = df.groupBy(*keys, F.to_date(ts).alias("__day")).agg(in_order(ts, s=state).alias("__rows"))
    days = days.withColumn("__run", of_states(F.col("__rows.s"))).drop("__rows")
    out = days.groupBy(*keys).agg(in_order("__day", r=F.col("__run")).alias("__runs"))
    return out.select(*keys, of_summaries(F.col("__runs.r"))["best"].alias(name))
