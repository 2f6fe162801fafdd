"""Queries over input with planted faults: what is wrong is told apart from what is right, and both are counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.series import rounded
from barloom.operators import quarantine, spectral
from barloom.plans import spectra, sql, steps
from barloom.plans.registry import register
from barloom.sources import tables

#: Samples below which a week fails.
LEAST = 8


def planted(spark: SparkSession, d: str) -> DataFrame:
    """The ticks with a fault in four of five tickers.

    ``error`` has some negative prices, ``signup`` none at all, ``purchase`` trades before the session only, and
    ``view`` stops after the first week of the windows but for one day.
    """
    price = F.when((F.col("ticker") == "error") & (F.col("seq") % 50 == 0), -F.col("price")).when(F.col("ticker") != "signup", F.col("price"))
    stays = F.when(F.col("ticker") == "purchase", F.hour("ts") < 9).when(F.col("ticker") == "view", (F.col("ts") < "2024-01-06") | (F.to_date("ts") == "2024-01-10"))
    return tables.ticks(spark, d).where(F.coalesce(stays, F.lit(True))).withColumn("price", price)


sql.STEPS["planted"] = (
    ["ticks"],
    (
        "SELECT ticker, ts, seq, CASE WHEN ticker = 'error' AND seq % 50 = 0 THEN -price WHEN ticker <> 'signup' THEN price END AS price, size FROM ticks "
        "WHERE CASE WHEN ticker = 'purchase' THEN hour(ts) < 9 WHEN ticker = 'view' THEN ts < TIMESTAMP '2024-01-06' OR CAST(ts AS DATE) = DATE '2024-01-10' ELSE true END"
    ),
)
sql.STEPS["planted_bars"] = (["planted"], sql.bars("planted", "hour"))
sql.STEPS["q_load"] = (
    ["planted_bars"],
    (
        "SELECT * FROM (SELECT ticker, CASE WHEN count(close) = 0 THEN 'no price' WHEN min(low) <= 0 THEN 'price not positive' END AS reason "
        "FROM planted_bars GROUP BY ticker) WHERE reason IS NOT NULL"
    ),
)
sql.STEPS["q_bars"] = (["planted_bars", "q_load"], "SELECT * FROM planted_bars WHERE ticker NOT IN (SELECT ticker FROM q_load)")
sql.derive("q_", "q_bars", sql.STEPS["grid"][1])
sql.STEPS["q_weeks"] = (
    ["q_merged"],
    f"SELECT ticker, {sql.window_end('ts', 'week')} AS win_end, count(r_close) AS n, count(DISTINCT day_id) AS days FROM q_merged GROUP BY 1, 2",
)
QUARANTINE = f"""
SELECT 'load' AS step, ticker, NULL::TIMESTAMP AS win_end, reason, 1::BIGINT AS n FROM q_load
UNION ALL SELECT 'merge', ticker, NULL, 'no bars in the session', 1 FROM (SELECT DISTINCT ticker FROM q_bars) WHERE ticker NOT IN (SELECT ticker FROM q_merged)
UNION ALL SELECT 'fft', ticker, win_end, n || ' of {LEAST} samples', 1 FROM q_weeks WHERE n < {LEAST}
UNION ALL SELECT 'bars', ticker, NULL, 'kept', count(*) FROM q_bars GROUP BY ticker
UNION ALL SELECT 'merged', ticker, NULL, 'kept', count(*) FROM q_merged GROUP BY ticker
UNION ALL SELECT 'agg_day', ticker, NULL, 'kept', sum(days)::BIGINT FROM q_weeks GROUP BY ticker
UNION ALL SELECT 'agg_week', ticker, NULL, 'kept', count(*) FROM q_weeks GROUP BY ticker
UNION ALL SELECT 'fft_week', ticker, NULL, 'kept', count(*) FROM q_weeks WHERE n >= {LEAST} GROUP BY ticker
UNION ALL SELECT 'cwt_week', ticker, NULL, 'kept', count(*) FROM q_weeks WHERE ticker NOT IN (SELECT ticker FROM q_weeks WHERE n < {LEAST}) GROUP BY ticker
"""


def quarantined(spark: SparkSession, d: str) -> DataFrame:
    """All steps over the planted ticks: what each step sets aside and why, and the rows each table keeps of a ticker.

    Where all tickers are set aside tables are empty and the reasons say why, so no step raises.
    """
    made = steps.run_steps(planted(spark, d), config=steps.Config(fft_series=("r_close",), least_samples=LEAST, no_zeros=True, checks=False))
    out = made.pop("quarantine").withColumn("n", F.lit(1).cast("bigint"))
    for name, df in made.items():
        kept = df.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(kept.select(F.lit(name).alias("step"), "ticker", F.lit(None).cast("timestamp_ntz").alias("win_end"), F.lit("kept").alias("reason"), "n"))
    return out


def gated(spark: SparkSession, d: str) -> DataFrame:
    """Scalogram features by week of the tickers that have a session: one week of ``view`` is too short and gaped.

    Where all tickers are set aside there is no row, so no step raises.
    """
    made = steps.run_steps(planted(spark, d), ("load", "merge"), steps.Config(no_zeros=True, checks=False))
    merged = quarantine.without(made["merged"], made["quarantine"])
    return rounded(spectral.cwt_windows(merged, ["r_close"], "week", share=0.9, gap=0.1, run=3))


def register_all() -> None:
    grids, _ = spectra.cwt_windows("q_merged", ["r_close"], "week", 6)
    quality = spectra.quality("q_merged", "r_close", "week", 6, 0.1, 3, 0.9, 16)
    body = spectra.with_quality(quality, spectra.cwt_features("SELECT * FROM grid_r_close"), spectral.CWT_NAMES, "r_close")
    register("cwt_gates", spectra.over_grids(grids, body, "q_merged", ["gap_ratio", *spectral.CWT_NAMES]))(gated)
    register("quarantine", sql.query(["q_load", "q_bars", "q_merged", "q_weeks"], QUARANTINE))(quarantined)
