import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import documents, spectral
from barloom.plans import catalog, steps
from barloom.sources import tables
from barloom.streaming.bars import stream_bars

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v.isoformat().replace("T00:00:00", "") if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = duck.execute(catalog.oracle_sql()[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr) == want


def test_whole_queries_leave_no_rows_out(spark):
    ticks, q = tables.ticks(spark, SF), catalog.queries()
    days = catalog._inside(spark, SF).select("ticker", F.to_date("ts")).distinct().count()
    assert q["grid_minute"](spark, SF).count() == 390 * days
    bars = tables.build_bars(ticks, "hour").count()
    assert sum(r.bars for r in q["align_outer"](spark, SF).collect()) == bars
    assert sum(r.n for r in q["auto_shift_align"](spark, SF).collect()) == bars
    minutes = tables.build_bars(ticks, "minute").where("hour(ts) * 60 + minute(ts) between 570 and 959").count()
    assert sum(r.n for r in q["agg_hour"](spark, SF).collect()) == minutes


def test_a_tone_peaks_at_its_period():
    t = np.arange(256)
    x = np.sin(2 * np.pi * t / 32)
    made = dict(zip(spectral.FFT_NAMES, spectral.welch_features(x, 256, 128)))
    assert abs(made["dom_period_bars"] - 32) < 1e-9 and made["pct_mid"] > 0.95
    peak = dict(zip(spectral.CWT_NAMES, spectral.cwt_features(np.sin(2 * np.pi * np.arange(400) / 20))))["peak_period_bars"]
    assert peak == min(spectral.PERIODS, key=lambda p: abs(p - 20))
    assert all(math.isnan(v) for v in spectral.cwt_features(np.ones(64)))


def test_compactness_of_even_and_single_energy():
    assert spectral.compactness(np.ones(4)) == pytest.approx(-0.25) and spectral.compactness(np.array([0, 0, 0, 1.0])) == pytest.approx(0.5)


def test_steps_reject_what_they_do_not_know(spark):
    with pytest.raises(ValueError):
        steps.run_steps(tables.ticks(spark, SF), ("load", "nothing"))
    for bad in ({"cadences": ("hourly",)}, {"fft_series": ()}, {"reducer": "mode"}, {"sampling": "week"}, {"fill": 3}):
        with pytest.raises(ValueError):
            steps.Config(**bad)


def test_model_answers_in_batches(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(25)], "i int, prompt string")
    out = documents.run_model(df, "prompt", "said", lambda: lambda ps: [f" {p[-1]}x" for p in ps], 7).withColumn("label", documents.parse_label(F.col("said")))
    assert {r.i for r in out.where("label = 1").collect()} == {1, 11, 21}


def test_csv_news_and_documents_round_trip(spark, tmp_path):
    (tmp_path / "bars").mkdir()
    (tmp_path / "bars" / "BRK.B.csv").write_text("timestamp,open,high,low,close,volume,vwap,transactions\n2024-12-29 05:00:00,1,2,0.5,1.5,10,1.2,3\n")
    assert tables.read_bars(spark, str(tmp_path / "bars")).first().ticker == "BRK.B"
    (tmp_path / "news").mkdir()
    (tmp_path / "news" / "A.csv").write_text("timestamp,url,text\n\n2024-01-02,http://x,one, two, three\n")
    assert [tuple(r) for r in tables.read_news(spark, str(tmp_path / "news")).collect()] == [("A", "2024-01-02", "http://x", "one, two, three")]
    df = spark.createDataFrame([("B.C", "2024-01-02", [("t", "x", "u")], {"10:00": {"agg.rv": 1.0}, "11:00": {}})], tables.DOCUMENT)
    tables.write_documents(df, str(tmp_path / "docs"))
    assert [str(p.relative_to(tmp_path / "docs")) for p in (tmp_path / "docs").glob("folder=*/day=*")] == ["folder=B_C/day=2024-01-02"]
    assert tables.read_documents(spark, str(tmp_path / "docs")).first().news[0].text == "x"
    for name in ("A.B.csv", "B.csv", "BX.csv"):
        (tmp_path / "bars" / name).write_text("timestamp\n")
    assert tables.locate(spark, str(tmp_path / "bars"), "B").endswith("/B.csv") and tables.locate(spark, str(tmp_path / "bars"), "A").endswith("/A.B.csv")
    with pytest.raises(FileNotFoundError):
        tables.locate(spark, str(tmp_path / "bars"), "Z")
    assert documents.drop_empty(df).first().per_hour_data == {"10:00": {"agg.rv": 1.0}}


def test_streamed_bars_match_batch_bars(spark, tmp_path):
    rows = tables.ticks(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    q = stream_bars(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("bars").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {(r.ticker, r.ts): r.close for r in spark.table("bars").collect()}
    want = {(r.ticker, r.ts): r.close for r in tables.build_bars(tables.ticks(spark, SF), "hour").collect()}
    assert got and all(want[k] == v for k, v in got.items())


def test_quoted_news_against_the_csv_module(spark, tmp_path):
    import csv

    lines = ["Timestamp,URL,text", "2024-01-02,http://x,one, two, three", '2024-01-03,"http://y,z","said ""so"", twice', 'and more",tail', "", ',,', '2024-01-04,u,5" wide', "2024-01-05", '2024-01-06,v,"' + "long, " * 9000 + '"']
    (tmp_path / "T.csv").write_text("\ufeff" + "\n".join(lines) + "\n")
    with open(tmp_path / "T.csv", encoding="utf-8-sig", newline="") as f:
        want = [("T", r[0].strip(), r[1].strip() if len(r) > 1 else "", ",".join(r[2:]).strip()) for r in list(csv.reader(f))[1:] if any(c.strip() for c in r)]
    assert sorted(map(tuple, tables.read_news(spark, str(tmp_path), multiline=True).collect())) == sorted(want)


def test_granularity_names():
    assert [tables.granularity(x) for x in (" Min", "m", "HR", "hourly", "d", "weekly", "mo", "quarterly", "annually")] == ["minute", "minute", "hour", "hour", "day", "week", "month", "quarter", "year"]
    with pytest.raises(ValueError):
        tables.granularity("fortnight")


def test_configuration_files_and_cadence_paths(tmp_path):
    (tmp_path / "c.json").write_text("\ufeff" + '{"sampling": "minute", "cadences": ["week", "month"]}')
    made = steps.load_config(str(tmp_path / "c.json"))
    assert made == steps.Config(sampling="minute", cadences=("week", "month"))
    assert steps.cadence_path("root/{cad}/x_{cad}.csv", "week") == "root/week/x_week.csv"
    (tmp_path / "bad.json").write_text('{"nothing": 1}')
    with pytest.raises(ValueError):
        steps.load_config(str(tmp_path / "bad.json"))


def test_steps_by_minute_hour_and_day(spark):
    ticks = tables.prints(spark, SF)
    made = steps.run_steps(ticks, ("load", "merge", "agg"), steps.Config(sampling="minute", cadences=("hour", "week"), checks=True))
    assert made["agg_hour"].count() == 3 * 20 * 7 and made["agg_week"].count() == 12
    days = steps.run_steps(tables.trades(spark, SF), ("load", "merge", "agg"), steps.Config(sampling="day", cadences=("month",)))
    assert days["merged"].where("session <> 'day' or r_close is not null").isEmpty() and days["agg_month"].count() > 12
