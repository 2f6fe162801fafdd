"""Queries of inputs as they come: files found by name, order in files, missing times, names and checks of settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import calendar, documents, indicators, merge
from barloom.plans import sql, steps
from barloom.plans.files import KEY, OHLC, folder
from barloom.plans.registry import register
from barloom.sources import tables

#: Names of granularities as callers write them, and the units they mean.
NAMES = {"min": "minute", "Hr": "hour", " daily": "day", "w": "week", "mo": "month", "quarterly": "quarter", "annually": "year"}
#: Settings that are told apart before anything is read.
BAD_SETTINGS = {
    "cadence": {"cadences": ("week", "decade")},
    "fill": {"fill": 3, "fill_extra": 2},
    "no series": {"fft_series": ()},
    "reducer": {"reducer": "mode"},
    "sampling": {"sampling": "second"},
}


def located_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars in files named by their ticker, or only starting with it, or not at all: the file found and its rows."""
    from barloom.plans.catalog import written_bars

    root = folder(spark, "located")
    bars = written_bars(spark, d)
    of = {"click": ("click_b", "click_a"), "view": ("view", "view_0"), "error": ("x_error",)}
    files = F.array("ticker")
    for ticker, names in of.items():
        files = F.when(F.col("ticker") == ticker, F.array(*map(F.lit, names))).otherwise(files)
    named = bars.select(F.explode(files).alias("ticker"), F.col("ts").alias("timestamp"), *OHLC, "transactions")
    tables.write_csv_by_name(named, root, order="timestamp")
    found = tables.locate_all(bars, root).withColumn("file", F.regexp_extract("path", r"([^/]+)\.csv$", 1))
    rows = tables.read_bars(spark, root).groupBy(F.col("ticker").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return found.join(rows, "file", "left").select("ticker", "file", "n")


def file_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of every bar in the file of its ticker, as the lines stand there."""
    from barloom.plans.catalog import hour_bars

    root = folder(spark, "ordered")
    bars = hour_bars(spark, d).select("ticker", F.col("ts").alias("timestamp"), "transactions").repartition(8, "transactions")
    tables.write_csv_by_name(bars, root, order="timestamp")
    lines = spark.read.text(root, pathGlobFilter="*.csv")
    # lines of a block are numbered in turn, and blocks of a file are ordered by where they start
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    rows = lines.select(tables.file_stem().alias("ticker"), at.alias("at"), F.split("value", ",")[0].alias("ts")).where("ts <> 'timestamp'")
    place = F.row_number().over(tables.W.partitionBy("ticker").orderBy("at"))
    return rows.select("ticker", F.col("ts").cast("timestamp_ntz").alias("ts"), place.alias("place"))


def null_times(spark: SparkSession, d: str) -> DataFrame:
    """Bars, features and news of which some have no time: what each day keeps of them."""
    from barloom.plans.catalog import news, written_bars

    bars = written_bars(spark, d)
    lost = F.col("transactions") % 3 == 0
    broken = bars.where(lost).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    known = indicators.grid_indicators(bars.where(~lost))
    kept = merge.merged(known.unionByName(broken, allowMissingColumns=True), ["atr_14", "bb_bw_20"])
    days = [kept.groupBy("ticker", F.col("day_id").alias("date")).agg(F.lit("merged").alias("part"), F.count("close").alias("n"))]
    cells = documents.long_features(bars.where(~lost).unionByName(broken), "inter", ["close", "vwap"], 1, at="ts")
    days.append(cells.groupBy("ticker", F.to_date("end_ts").alias("date")).agg(F.lit("features").alias("part"), F.count("value").alias("n")))
    told = news(spark, d).withColumn("ts", F.when(F.col("doc_id") % 5 != 0, F.col("ts")))
    days.append(documents.news_per_day(told).select("ticker", "date", F.lit("news").alias("part"), F.size("news").cast("bigint").alias("n")))
    return days[0].unionByName(days[1]).unionByName(days[2])


sql.STEPS["timed_bars"] = (["hour_bars"], "SELECT * FROM hour_bars WHERE transactions % 3 <> 0")
sql.derive("timed_", "timed_bars", sql.STEPS["grid"][1])
NULL_TIMES = """
SELECT ticker, CAST(day_id AS DATE) AS date, 'merged' AS part, count(close)::BIGINT AS n FROM timed_merged GROUP BY 1, 2
UNION ALL SELECT ticker, CAST(ts AS DATE), 'features', (count(close) + count(vwap))::BIGINT FROM timed_bars GROUP BY 1, 2
UNION ALL SELECT ticker, CAST(ts AS DATE), 'news', count(*)::BIGINT FROM news WHERE doc_id % 5 <> 0 GROUP BY 1, 2
"""


def granularity_names(spark: SparkSession, d: str) -> DataFrame:
    """How many bars a ticker has by each name of a granularity, from one scan."""
    starts = F.array(*(F.struct(F.lit(n).alias("name"), tables.bucket(F.col("ts"), n).alias("start")) for n in NAMES))
    rows = tables.ticks(spark, d).select("ticker", F.explode(starts).alias("b")).select("ticker", "b.name", "b.start").distinct()
    return rows.groupBy("ticker", "name").agg(F.count("start").alias("n"))


def checked_settings(spark: SparkSession, d: str) -> DataFrame:
    """Settings that are refused before anything is read, and the merged rows of each ticker by those that are not."""
    refused = []
    for name, settings in BAD_SETTINGS.items():
        try:
            steps.Config(**settings)
        except ValueError:
            refused.append(name)
    made = steps.run_steps(tables.ticks(spark, d), ("load", "merge"), steps.Config(fill=1, fill_extra=2))["merged"]
    rows = made.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("ticker", "n", F.array_join(F.array(*map(F.lit, refused)), ",").alias("refused"))


MINUTE = "(hour(server_time) * 60 + minute(server_time))"
STATUS = f"""
SELECT ticker, date, hour, coalesce(works AND m BETWEEN 960 AND 1199, false) AS after_hours, coalesce(works AND m BETWEEN 240 AND 569, false) AS early_hours,
CASE WHEN works AND m BETWEEN 570 AND 959 THEN 'open' WHEN works AND m BETWEEN 240 AND 1199 THEN 'extended-hours' ELSE 'closed' END AS market, server_time
FROM (SELECT *, isodow(server_time) < 6 AS works, {MINUTE} AS m FROM (SELECT ticker, CAST(ts AS DATE) AS date, hour(ts)::INTEGER AS hour, max(ts) AS server_time FROM ticks GROUP BY 1, 2, 3))
"""


def register_all() -> None:
    file = "CASE ticker WHEN 'click' THEN 'click_a' WHEN 'error' THEN NULL ELSE ticker END"
    located = f"SELECT ticker, {file} AS file, CASE WHEN ticker <> 'error' THEN count(*)::BIGINT END AS n FROM hour_bars GROUP BY ticker"
    register("located_bars", sql.query(["hour_bars"], located))(located_bars)
    placed = f"SELECT {', '.join(KEY)}, row_number() OVER (PARTITION BY ticker ORDER BY ts)::INTEGER AS place FROM hour_bars"
    register("file_order", sql.query(["hour_bars"], placed))(file_order)
    register("null_times", sql.query(["timed_bars", "timed_merged", "news"], NULL_TIMES))(null_times)
    counts = " UNION ALL ".join(
        f"SELECT ticker, '{name}' AS name, count(DISTINCT date_trunc('{unit}', ts))::BIGINT AS n FROM ticks GROUP BY 1" for name, unit in NAMES.items()
    )
    register("granularity_names", sql.query(["ticks"], counts))(granularity_names)
    told = f"SELECT ticker, count(*)::BIGINT AS n, '{','.join(BAD_SETTINGS)}' AS refused FROM merged GROUP BY ticker"
    register("checked_settings", sql.query(["merged"], told))(checked_settings)
    register("market_status", sql.query(["ticks"], STATUS))(
        lambda s, d: calendar.market_status(tables.ticks(s, d).withColumns({"date": F.to_date("ts"), "hour": F.hour("ts")}), ["ticker", "date", "hour"])
    )
