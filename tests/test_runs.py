"""Run summaries against plain loops, and convolution by transforms against the direct one."""

import datetime
import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import runs
from barloom.operators import features, spectral


def plain_longest(states):
    return max((len(list(g)) for k, g in itertools.groupby(states) if k is not None), default=0)


def summary(states):
    states = list(states)
    n = len(states)
    first = [len(list(g)) if k is not None else 0 for k, g in itertools.groupby(states)][:1]
    last = [len(list(g)) if k is not None else 0 for k, g in itertools.groupby(states[::-1])][:1]
    return (n, *(first or [0]), *(last or [0]), plain_longest(states), states[0] if n else None, states[-1] if n else None)


def test_summaries_combine_at_every_place(spark):
    r = random.Random(1)
    rows = []
    for _ in range(150):
        states = [r.choice([None, 1.0, -1.0]) for _ in range(r.randrange(0, 9))]
        if r.random() < 0.3:
            states = [1.0] * r.randrange(0, 5)
        k = r.randrange(0, len(states) + 1)
        rows.append((states[:k], states[k:]))
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    both = runs.merge(runs.of_states(F.col("a")), runs.of_states(F.col("b")))
    for (a, b), got in zip(rows, df.select(both.alias("m"), runs.of_states(F.concat("a", "b")).alias("w")).collect()):
        assert tuple(got.m) == tuple(got.w) == summary(a + b)


def test_longest_runs_over_days_without_windows(spark):
    r = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    series = {t: sorted(((start + datetime.timedelta(hours=r.randrange(0, 24 * 60)), r.choice([1.0, 1.0, 1.0, None])) for _ in range(300)), key=lambda x: x[0]) for t in ("a", None)}
    series = {t: list({ts: (ts, s) for ts, s in x}.values()) for t, x in series.items()}
    df = spark.createDataFrame([(t, ts, s) for t, x in series.items() for ts, s in x], "ticker string, ts timestamp_ntz, s double")
    out = runs.longest_runs(df, ["ticker"], F.col("s"), "n")
    assert {row.ticker: row.n for row in out.collect()} == {t: plain_longest([s for _, s in x]) for t, x in series.items()}
    plan = out._jdf.queryExecution().toString()
    assert "Window" not in plan and runs.longest_runs(df.limit(0), ["ticker"], F.col("s"), "n").count() == 0


def test_a_flat_column_is_flat_over_many_days(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(t, start + datetime.timedelta(hours=h), h % 9 == 0, x) for h in range(600) for t, x in (("flat", 1234.1), ("moves", 1234.1 + 1e-6 * (h % 2)), ("none", None))]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, gap boolean, x double").withColumn("is_gap", F.col("gap").cast("int"))
    got = {r.ticker: (r.n, r.degenerate, r.max_gap_run, round(r.gap_ratio, 9)) for r in features.low_confidence(df, "x", "month").collect()}
    assert got == {t: (600, t != "moves", 1, round(67 / 600, 9)) for t in ("flat", "moves", "none")}


@pytest.mark.parametrize("n", [16, 100, 1561, 20_000])
def test_convolution_is_the_direct_one(n):
    x = np.random.default_rng(n).normal(size=n)
    scales = spectral.CENTRE * spectral.PERIODS
    kernels = spectral._kernels(tuple(float(s) for s in scales))
    for got, k in zip(spectral.convolved(x, scales), kernels):
        want = np.convolve(x, k)
        assert np.abs(got[: len(want)] - want).max() < 1e-9 and np.abs(got[len(want) :]).max(initial=0) < 1e-9


def test_a_year_of_minutes_takes_seconds():
    x = np.random.default_rng(0).normal(size=390 * 252)
    began = time.monotonic()
    assert all(np.isfinite(spectral.cwt_features(x)))
    assert time.monotonic() - began < 15


def test_gaps_are_measured_in_the_grouped_call(spark):
    assert [spectral.longest_gap(np.array(x, float)) for x in ([], [1, 2], [np.nan], [1, np.nan, np.nan, 2, np.nan])] == [0, 0, 1, 2]
    start = datetime.datetime(2024, 1, 1, 10)
    rows = [("a", start + datetime.timedelta(hours=h, days=d), None if (h + d) % 4 == 0 else 1.0 + h, 0) for d in range(9) for h in range(6)]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, x double, is_gap int")
    cols = ["ticker", "win_end", "win_start", "days", "n_valid", "max_gap_run", "expected_bars", "gap_ratio", "passed"]
    a = spectral.fft_windows(df, ["x"], "week", "hour", 8, 4).select(cols).orderBy("win_end").collect()
    assert a == features.window_quality(df, "x", "week", "hour", 0.10, 30, 0.75, 4).select(cols).orderBy("win_end").collect() and len(a) == 2
