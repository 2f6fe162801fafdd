import duckdb
import pytest
from pyspark.sql import functions as F

from barloom.operators import documents
from barloom.plans import catalog


@pytest.mark.parametrize(
    ("zone", "wanted"),
    [
        # skipped from 02:00 on the first day, repeated from 01:00 on the last
        ("America/New_York", {"2024-03-10 01:59": "-05:00", "2024-03-10 02:30": "-05:00", "2024-03-10 03:00": "-04:00", "2024-11-02 01:30": "-04:00", "2024-11-03 00:59": "-04:00", "2024-11-03 01:00": "-05:00", "2024-11-03 01:59": "-05:00", "2024-11-03 02:00": "-05:00"}),
        ("Australia/Lord_Howe", {"2024-04-07 01:29": "+11:00", "2024-04-07 01:30": "+10:30", "2024-04-07 02:00": "+10:30"}),
    ],
)
def test_offsets_where_the_clock_changes(spark, zone, wanted):
    df = spark.createDataFrame([(t,) for t in wanted], "t string")
    at = documents.iso_with_offset(F.col("t").cast("timestamp_ntz"), zone)
    assert {r.t: r.at[19:] for r in df.select("t", at.alias("at")).collect()} == wanted


def test_news_of_summer_days_by_a_clock_of_standard_time(spark, tmp_path):
    rows = [(i, "a", "s") for i in (0, 100_000, 150_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    df = catalog.queries()["news_per_day"](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({catalog.oracle_sql()['news_per_day']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
    told = documents.news_per_day(catalog.news(spark, str(tmp_path))).select(F.explode("news.timestamp_et").alias("t"))
    assert sorted(r.t[19:] for r in told.collect()) == ["-04:00", "-04:00", "-05:00"]
