"""Named files, overwriting only what is better, unreadable input, steps that count and set aside."""

import datetime
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import calendar, quarantine, spectral
from barloom.plans import faulty, steps
from barloom.sources import tables

SF = "/root/testdata/sf0.001"


def test_named_files_from_the_tasks(spark, tmp_path):
    root = tmp_path / "named"
    rows = [(f"t{k % 7}/{k}.json", f"é{k}") for k in range(60)]
    df = spark.createDataFrame(rows, "path string, value string").repartition(6)
    for _ in range(2):  # a second run, like a retried task, replaces the files whole
        assert tables.write_named(df, str(root)) == 60
        assert sorted((str(p.relative_to(root)), p.read_text()) for p in root.rglob("*") if p.is_file()) == sorted(rows)
    assert not (root / tables.ASIDE).exists()
    assert tables.write_named(df.limit(0), f"file://{root}/none") == 0


def test_a_retried_task_leaves_no_stray_file(spark, tmp_path):
    """A value that fails on the way leaves whole files only, and the next run has them all."""
    root = tmp_path / "named"
    df = spark.createDataFrame([(f"a/{k}.json", str(k)) for k in range(20)], "path string, value string").coalesce(1)
    bad = df.withColumn("path", F.when(F.col("value") == "11", F.lit(f"a/3.json/{'x' * 9}")).otherwise(F.col("path")))
    with pytest.raises(Exception):
        tables.write_named(bad, str(root))
    done = [p for p in root.rglob("*.json") if p.is_file()]
    assert 0 < len(done) < 20 and all(p.read_text() == p.stem for p in done)
    assert tables.write_named(df, str(root)) == 20
    assert sorted(p.read_text() for p in root.rglob("*") if p.is_file()) == sorted(map(str, range(20)))


def test_documents_keep_their_names(spark, tmp_path):
    day = [("t", "said", "u")]
    df = spark.createDataFrame([("A/B.C", "2024-01-02", day, {"10:00": {"x": 1.0}}), ("D", "2024-01-03", day, {})], tables.DOCUMENT)
    assert tables.write_documents_named(df, str(tmp_path / "a")) == 2
    names = ["A_B_C/2024-01-02_A_B.C.json", "D/2024-01-03_D.json"]
    assert sorted(str(p.relative_to(tmp_path / "a")) for p in (tmp_path / "a").rglob("*.json")) == names
    assert json.loads((tmp_path / "a" / names[0]).read_text())["per_hour_data"] == {"10:00": {"x": 1.0}}
    assert tables.write_mirrored_named(tables.read_documents(spark, str(tmp_path / "a")).where("ticker = 'D'"), str(tmp_path / "b")) == 1
    assert [str(p.relative_to(tmp_path / "b")) for p in (tmp_path / "b").rglob("*.json")] == names[1:]


def test_only_better_rows_overwrite(spark, tmp_path):
    root = str(tmp_path / "better")
    schema = "k long, size long, said string, part string"

    def put(*rows):
        return tables.write_if_better(spark.createDataFrame(rows, schema), root, "part", ["part", "k"], F.desc("size"))

    def files():
        return {str(p): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}

    def rows():
        return sorted((r.part, r.k, r.size, r.said) for r in spark.read.parquet(root).collect())

    assert put((1, 5, "a", "x"), (2, 5, "b", "x"), (1, 5, "c", "y"), (1, 4, "d", "y")) == 3
    first = rows()
    assert first == [("x", 1, 5, "a"), ("x", 2, 5, "b"), ("y", 1, 5, "c")]
    before = files()
    assert put((1, 4, "worse", "x"), (2, 5, "a tie", "x"), (1, 1, "worse", "y")) == 0
    assert files() == before and rows() == first
    assert put((1, 6, "better", "y"), (2, 2, "worse", "x"), (7, 1, "new", "z")) == 2
    assert rows() == [("x", 1, 5, "a"), ("x", 2, 5, "b"), ("y", 1, 6, "better"), ("z", 7, 1, "new")]
    assert {p for p in before if "part=x" in p} == {p for p in files() if "part=x" in p}
    assert not {p for p in before if "part=y" in p} & set(files())


def test_unreadable_documents_are_told_apart(spark, tmp_path):
    good = json.dumps({"ticker": "A", "date": "2024-01-02", "news": [], "per_hour_data": {"10:00": {"x": 1.5}}}, indent=2)
    for name, content in {"good": good.encode(), "cut": good[:-5].encode(), "bytes": good.replace("A", "é").encode("latin-1"), "other": b"[1, 2]", "none": b'{"date": "x"}', "text": b"hello"}.items():
        (tmp_path / f"{name}.json").write_bytes(content)
    got = {Path(r.file).stem: (r.ticker, r.per_hour_data, r.reason) for r in tables.read_documents_checked(spark, str(tmp_path)).collect()}
    assert got.pop("good") == ("A", {"10:00": {"x": 1.5}}, None)
    assert {k: v[2] for k, v in got.items()} == {"cut": "not a JSON document", "bytes": "not UTF-8", "other": "not a JSON document", "none": "no ticker", "text": "not a JSON document"}
    assert all(v[:2] == (None, None) for v in got.values())


def test_windows_that_fail_and_those_that_do_not():
    f = quarantine.strict(lambda x: [x.sum()], 3)
    assert f(np.array([1.0, 2.0, np.nan, 3.0])[[0, 1, 3]]) == [6.0]
    with pytest.raises(ValueError, match="2 of 3 samples"):
        f(np.array([1.0, np.nan, 2.0]))


def test_an_error_of_one_window_leaves_the_others(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(t, start + datetime.timedelta(days=d), float(d)) for t in ("a", "b") for d in range(20) if t == "a" or d != 9]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, x double")

    def f(x):
        if 9.0 in x:
            raise ValueError("nine")
        return [x.sum()]

    made = spectral.per_window(df, ["x"], "week", ["s"], f)
    assert sorted((r.ticker, r.s, r.error) for r in made.collect() if r.error) == [("a", None, "nine")]
    bad = quarantine.failed_windows(made, "fft")
    assert [(r.step, r.ticker, r.reason) for r in bad.collect()] == [("fft", "a", "nine")]
    assert {r.ticker for r in quarantine.without(df, bad).select("ticker").distinct().collect()} == {"b"}


def test_tables_are_counted_while_they_are_written(spark):
    state = steps.run_state(faulty.planted(spark, "/root/testdata/sf0.01"), config=steps.Config(fft_series=("r_close",), least_samples=faulty.LEAST))
    assert set(state.rows) == {"bars", "merged", "agg_day", "agg_week", "fft_week", "cwt_week", "quarantine"}
    for name, df in state.tables.items():
        assert state.rows[name] == df.count() > 0
    assert state.rows["quarantine"] == state.bad.count()
    assert {r.ticker for r in state.tables["cwt_week"].select("ticker").distinct().collect()} == {"click"}
    with pytest.raises(ValueError, match="left bars empty"):
        steps.run_state(tables.ticks(spark, SF).withColumn("price", F.lit(-1.0)), ("load",))


def test_calendar_buckets(spark):
    df = spark.createDataFrame([("2024-02-29 09:29:59.5",), ("2024-01-07 23:59:59",), ("1969-12-31 10:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))

    def starts(*x, **y):
        return [str(r[0])[:16] for r in df.select(tables.bucket(F.col("t"), *x, **y)).collect()]

    assert starts("week", 2, "2024-01-03") == ["2024-02-26 00:00", "2024-01-01 00:00", "1969-12-29 00:00", "None"]
    assert starts("month", 2, "2024-01-15") == ["2024-01-01 00:00", "2024-01-01 00:00", "1969-11-01 00:00", "None"]
    assert starts("quarter") == ["2024-01-01 00:00", "2024-01-01 00:00", "1969-10-01 00:00", "None"]
    assert starts("year", 5, "2020-06-01") == ["2020-01-01 00:00", "2020-01-01 00:00", "1965-01-01 00:00", "None"]
    assert starts("minute", 20, at_open=True) == ["2024-02-29 09:10", "2024-01-07 23:50", "1969-12-31 09:50", "None"]
    assert starts("minute", 45) == ["2024-02-29 09:00", "2024-01-07 23:15", "1969-12-31 09:45", "None"]
    with pytest.raises(ValueError):
        tables.bucket(F.col("t"), "fortnight")


def test_the_market_at_each_kind_of_time(spark):
    # a Friday, a Saturday
    times = ["2024-03-08 03:59", "2024-03-08 04:00", "2024-03-08 09:30", "2024-03-08 15:59", "2024-03-08 16:00", "2024-03-08 20:00", "2024-03-09 12:00", None]
    df = spark.createDataFrame(list(enumerate(times)), "k int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = {r.k: (r.market, r.early_hours, r.after_hours) for r in calendar.market_status(df, ["k"]).collect()}
    no = ("closed", False, False)
    extended = {1: ("extended-hours", True, False), 4: ("extended-hours", False, True)}
    assert out == {0: no, 2: ("open", False, False), 3: ("open", False, False), 5: no, 6: no} | extended
    assert [r.market for r in calendar.market_status(df).collect()] == ["closed"]
    assert [r.market for r in calendar.market_status(df.limit(0)).collect()] == [None]


def test_files_found_by_the_start_of_their_name(spark, tmp_path):
    for name in ("AB.csv", "AB_1.csv", "AC_2.csv", "AC_1.csv", "B.txt"):
        (tmp_path / name).write_text("timestamp\n")
    tickers = spark.createDataFrame([("AB",), ("AC",), ("A",), ("B",), ("AB",), (None,)], "ticker string")
    found = {r.ticker: r.path and r.path.rsplit("/", 1)[1] for r in tables.locate_all(tickers, str(tmp_path)).collect()}
    assert found == {"AB": "AB.csv", "AC": "AC_1.csv", "A": "AB.csv", "B": None, None: None}
    assert all(tables.locate(spark, str(tmp_path), k).endswith(found[k]) for k in ("AB", "AC", "A"))
