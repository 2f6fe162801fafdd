"""Series in ranges: numbering, halos and folds against plain loops, and how the work grows."""

import datetime
import random
import time

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions import ranges
from barloom.functions.series import rolling
from barloom.operators import indicators

START = datetime.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, x double")


def bumpy(seed, n, ticker="a"):
    """A series with many rows on some days, none on others, and a long pause."""
    r = random.Random(seed)
    at, out = START, []
    for k in range(n):
        at += datetime.timedelta(seconds=r.choice([1, 1, 60, 3600, 90_000])) if k != n // 2 else datetime.timedelta(days=900)
        out.append((ticker, at, None if r.random() < 0.2 else r.uniform(-5, 5)))
    return out


def test_rows_are_numbered_in_order(spark):
    rows = [*bumpy(1, 400), *bumpy(2, 3, "b"), *bumpy(3, 30, None), ("c", None, 1.0), ("c", START, 2.0)]
    for ticker in ("a", "b", None):
        own = ranges.numbered(frame(spark, rows)).where(F.col("ticker").eqNullSafe(F.lit(ticker)))
        got = sorted(tuple(r) for r in own.select("ts", ranges.INDEX).collect())
        assert [i for _, i in got] == list(range(len(got)))
    assert [r.x for r in ranges.numbered(frame(spark, rows)).where("ticker = 'c'").orderBy(ranges.INDEX).collect()] == [1.0, 2.0]
    assert ranges.numbered(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("rows", "halo"), [(50, 6), (5, 6), (3, 11), (4096, 6)])
def test_windows_over_ranges_are_windows_over_the_series(spark, rows, halo):
    df = frame(spark, [*bumpy(4, 300), *bumpy(5, 9, "b"), *bumpy(6, 40, None)])
    of = lambda x, w: x.withColumns({"m": rolling(F.avg, F.col("x"), w, halo + 1, 2), "l": F.lag("x", halo).over(w)})
    want = of(df, W.partitionBy("ticker").orderBy("ts"))
    got = ranges.by_range(df, of, halo, rows=rows)
    assert got.columns == want.columns
    key = lambda r: (r.ticker or "", r.ts)
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert (a.ticker, a.ts, a.x, a.l) == (b.ticker, b.ts, b.x, b.l) and (a.m == b.m or a.m == pytest.approx(b.m))


def plain_fold(values, f):
    y, out = None if f.from_first else 0.0, []
    for v in values:
        y = y if v is None else v if y is None else y * f.keep + v * f.gain
        out.append(y)
    return out


@pytest.mark.parametrize(("rows", "width"), [(4096, 512), (7, 3), (1, 2)])
def test_folds_count_every_value(spark, monkeypatch, rows, width):
    monkeypatch.setattr(ranges, "WIDTH", width)
    values = [None, None, *[1e6] * 3, *[None] * 30, *[float(k % 7) for k in range(400)], None]
    series = {"a": values, "b": [5.0], "c": [None], None: values[::-1]}
    df = frame(spark, [(t, START + datetime.timedelta(hours=9 * k), v) for t, x in series.items() for k, v in enumerate(x)])
    x = F.col("x")
    folds = {"one": ranges.exponential(x, 1.0), "three": ranges.exponential(x, 0.5), "slow": ranges.exponential(x, 0.01), "fast": ranges.exponential(x, 0.97), "sum": ranges.total(x)}
    got = {}
    for r in ranges.scan(df, folds, rows=rows).collect():
        got.setdefault(r.ticker, []).append(r)
    for ticker, v in series.items():
        have = sorted(got[ticker], key=lambda r: r.ts)
        for name, f in folds.items():
            for a, b in zip((r[name] for r in have), plain_fold(v, f), strict=True):
                assert a is b is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)


def test_one_series_spreads_over_tasks(spark):
    df = frame(spark, bumpy(7, 2000))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [
            ranges.scan(df, {"y": ranges.exponential(F.col("x"), 0.1)}, rows=20),
            ranges.by_range(df, lambda x, w: x.withColumn("l", F.lag("x").over(w)), 1, rows=20),
        ]
        for df in rows:
            found = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
            assert len(found) == 4 and max(found) < 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_work_grows_with_the_series(spark):
    """Ten times the rows take far less than a hundred times the time, and no row holds a list."""
    took = []
    for n in (40_000, 400_000):
        df = spark.range(n).select(F.lit("a").alias("ticker"), (F.lit(START) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))).alias("ts"), F.rand(1).alias("close"), F.lit(1.0).alias("volume"))
        out = indicators.obv(indicators.ema(df, 12, 26))
        began = time.monotonic()
        out.write.format("noop").mode("overwrite").save()
        took.append(time.monotonic() - began)
    assert took[1] < 20 * took[0]
    assert all(t != "array" for _, t in out.dtypes)
