"""Models on the executors, scans by configuration, rows without a time, windows of over 300 bars."""

import datetime
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import documents, indicators, merge, spectral
from barloom.plans import catalog
from barloom.sources import scans

SF = "/root/testdata/sf0.001"


def test_a_model_is_made_once_in_each_worker(spark, tmp_path):
    log = str(tmp_path / "made")

    def make():
        with open(log, "a") as f:
            f.write(f"{os.getpid()}\n")

        def model(prompts):
            with open(f"{log}-sizes", "a") as f:
                f.write(f"{len(prompts)}\n")
            return [p.upper() for p in prompts]

        return model

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 400, 1, 16).select(F.concat(F.lit("p"), "id").alias("prompt"))
        got = documents.run_model(df, "prompt", "said", make, 20).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 400 and all(r.said == r.prompt.upper() for r in got)
    made = open(log).read().split()
    assert len(made) == len(set(made)) <= 4  # 16 tasks on four cores
    # 25 rows a task in Arrow batches of ten: a full batch of 20 across two of them, then the rest
    assert sorted(map(int, open(f"{log}-sizes").read().split())) == [5] * 16 + [20] * 16


def test_a_model_that_leaves_a_prompt_out_fails(spark):
    df = spark.range(9).select(F.col("id").cast("string").alias("prompt"))
    with pytest.raises(Exception, match="every prompt"):
        documents.run_model(df, "prompt", "said", lambda: lambda ps: ps[1:], 4).collect()
    assert documents.run_model(df.limit(0), "prompt", "said", lambda: lambda ps: ps).collect() == []


def test_scans_check_what_they_are_told(spark, tmp_path):
    for cadence, head in (("week", "timestamp,a_x,other,b_x"), ("month", "timestamp,a_x")):
        os.makedirs(tmp_path / f"f_{cadence}")
        for ticker in ("T.A", "B"):
            (tmp_path / f"f_{cadence}" / f"{ticker}.csv").write_text(head + "\n2024-01-05T00:00:00.000,1.5,what,\n"[: 99 if cadence == "week" else -7])
    path = tmp_path / "c.json"
    said = {"template": f"{tmp_path}/f_{{cad}}", "cadences": ["week"], "series": ["a", "b"], "suffixes": ["x"]}
    path.write_text(json.dumps(said))
    made = scans.load(spark, str(path))
    assert made.columns == ["a_x", "b_x"]
    rows = sorted(map(tuple, scans.scan_all(spark, made).collect()))
    assert rows == [(t, "week", datetime.datetime(2024, 1, 5), 1.5, None) for t in ("B", "T.A")]
    with pytest.raises(ValueError, match="has no b_x"):
        scans.scan(spark, made, "month")
    (tmp_path / "f_week" / "C.csv").write_text("timestamp,a_x\n")
    with pytest.raises(ValueError, match="headers differ"):
        scans.scan_all(spark, made)
    for bad in (said | {"more": 1}, {k: v for k, v in said.items() if k != "series"}, said | {"template": "x", "cadences": ["a", "b"]}):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            scans.load(spark, str(path))


def test_bars_without_a_time_leave_the_grid(spark):
    bars = catalog.hour_bars(spark, SF)
    lost = bars.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    of = lambda b: sorted(map(repr, merge.merged(indicators.grid_indicators(b), ["atr_14", "bb_bw_20"]).select("ticker", "ts", "close", "is_gap").collect()))
    assert of(bars.unionByName(lost)) == of(bars)


def test_energy_after_the_300th_bar():
    r = np.random.default_rng(4)
    quiet = np.concatenate([r.normal(size=300), 0.01 * r.normal(size=120)])
    late = np.concatenate([0.01 * r.normal(size=300), r.normal(size=120)])
    name = spectral.LEGACY_CWT_NAMES.index
    for x, least, most in ((quiet, 0, 0.2), (late, 0.8, 1)):
        made = spectral.legacy_cwt_features(x)
        shares = [made[name(f"energy_{part}")] for part in ("open", "mid", "late")]
        assert sum(shares) == pytest.approx(1) and least <= shares[2] <= most
        p = spectral._power(x, spectral.PERIODS)
        assert shares[2] == pytest.approx(p[:, 300:].sum() / p.sum())


def test_cover_of_the_edges(spark):
    for n in (16, 30, 390, 5000):
        got = spark.range(1).select(spectral.cover_ratio(F.lit(n).cast("bigint"))).first()[0]
        assert got == pytest.approx(spectral.influence(spectral.CENTRE * spectral.PERIODS, n).mean())
