"""Queries over minute bars, half-hour bars, day bars and hour windows, on prints that fill some days and not others."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.series import rounded
from barloom.operators import calendar, documents, features, indicators, merge, spectral
from barloom.plans import spectra, sql
from barloom.plans.registry import register, simple
from barloom.session import cut
from barloom.sources import tables
from barloom.sources.tables import PRICES, build_bars

KEY = ["ticker", "ts"]
OHLC = ["open", "high", "low", "close", "volume", "vwap"]


def half_hour_bars(spark: SparkSession, d: str) -> DataFrame:
    """Hour bars of the prints; those of ticker A start at half past."""
    ticks = tables.prints(spark, d)
    late = F.when(F.col("ticker") == "A", F.expr("interval 30 minutes")).otherwise(F.expr("interval 0 minutes"))
    return build_bars(ticks.withColumn("ts", F.col("ts") - late), "hour").withColumn("ts", F.col("ts") + late)


def day_grid(spark: SparkSession, d: str) -> DataFrame:
    return merge.merged_days(indicators.atr(cut(build_bars(tables.trades(spark, d), "day"), "bars")), ["atr_14"])


def register_all() -> None:
    from barloom.plans import catalog

    grid = catalog.minute_grid
    m = ["spread_vwap", "r_close", "ATR_14_day_mean", "spread_vwap_norm", "volume_z_by_tod"]
    made = [*catalog.A, "AGG_max_consecutive_gap", "trend_persistence"]
    columns = ["AGG_N", "valid_bars", *made]

    simple(
        "merged_minute",
        grid,
        [*KEY, "day_id", "is_gap", *PRICES, "bar_index_since_open", "minutes_since_open", *m],
        ["m_merged"],
        "m_merged",
        [*PRICES, *m],
    )
    simple(
        "agg_daily_minute",
        lambda s, d: features.daily(grid(s, d)),
        ["ticker", "day_id", *columns],
        ["m_cumulated"],
        f"({catalog.daily_sql('m_cumulated')})",
        catalog.A,
    )

    hours = (
        "(SELECT * EXCLUDE (cum), sum(coalesce(r_close, 0)) OVER (PARTITION BY ticker, win_end ORDER BY ts) AS cum FROM (SELECT *, "
        "date_trunc('hour', ts) + INTERVAL 1 HOUR AS win_end FROM m_cumulated))"
    )
    simple(
        "agg_hour_minute", lambda s, d: features.daily(grid(s, d).withColumn("win_end", calendar.window_end(F.col("ts"), "hour")), ["ticker", "win_end"]),
        ["ticker", "win_end", *columns], ["m_cumulated"], f"({catalog.daily_sql(hours, 'win_end')})", catalog.A,
    )
    for reducer in ("median", "mean", "weighted_mean"):
        body = spectra.reduced(catalog.daily_sql("m_cumulated"), "week", reducer, made, 390)
        register(f"agg_week_of_days_{reducer}", sql.query(["m_cumulated"], body, ["cover_ratio", *made]))(
            lambda s, d, r=reducer: rounded(features.reduce_windows(features.daily(grid(s, d)), "week", r, "minute"))
        )

    names = spectral.FFT_NAMES
    register("fft_day_minute", sql.query(["m_merged"], spectra.fft_windows("m_merged", ["r_close", "volume_z_by_tod"], "day", 390), ["gap_ratio", *names]))(
        lambda s, d: rounded(spectral.fft_windows(grid(s, d), ["r_close", "volume_z_by_tod"], "day", "minute"))
    )
    register("fft_hour_minute", sql.query(["m_merged"], spectra.fft_windows("m_merged", ["r_close"], "hour", 390, gap=0.9, share=0.1), ["gap_ratio", *names]))(
        lambda s, d: rounded(spectral.fft_windows(grid(s, d), ["r_close"], "hour", "minute", gap=0.9, share=0.1))
    )
    low = (
        "SELECT ticker, win_end, count(*)::BIGINT AS n, avg(is_gap) AS gap_ratio, max_gap_run, coalesce(stddev_pop(r_close) < 1e-8, true) AS degenerate, "
        "CAST(avg(is_gap) > 0.1 OR max_gap_run > 30 OR count(*) < 300 OR coalesce(stddev_pop(r_close) < 1e-8, true) AS INTEGER) AS low_conf "
        f"FROM {spectra.in_windows('m_merged', 'day')} JOIN ({sql.longest(spectra.in_windows('m_merged', 'day'), 'ticker, win_end', 'CASE WHEN is_gap = 1 THEN 1 END', 'max_gap_run')}) USING (ticker, win_end) GROUP BY ticker, win_end, max_gap_run"
    )
    register("low_confidence", sql.query(["m_merged"], low, ["gap_ratio"]))(
        lambda s, d: rounded(features.low_confidence(grid(s, d), "r_close", "day")),
    )
    half = "least(CAST(ceil(sqrt(2.0::DOUBLE) * 13.0::DOUBLE / 16 * 5 * power(24.0::DOUBLE, j / 35.0::DOUBLE)) AS BIGINT), n // 2)"
    cover = f"(SELECT avg((n - 2 * {half})::DOUBLE / n) FROM range(0, 36) r(j))"
    for cadence in ("day", "hour"):
        of = low.replace("max_gap_run > 30", "max_gap_run > 8")
        if cadence == "hour":
            of = of.replace(spectra.in_windows("m_merged", "day"), spectra.in_windows("m_merged", "hour"))
        of = f"SELECT * REPLACE (greatest(low_conf, CAST(cover_ratio < 0.7 AS INTEGER)) AS low_conf) FROM (SELECT *, {cover} AS cover_ratio FROM ({of}))"
        register(f"cwt_confidence_{cadence}", sql.query(["m_merged"], of, ["gap_ratio", "cover_ratio"]))(
            lambda s, d, c=cadence: rounded(spectral.cwt_confidence(grid(s, d), "r_close", c)),
        )
    flagged = spectral.LEGACY_FFT_NAMES
    older = " UNION ALL ".join(f"({spectra.legacy_fft('m_merged', c, 'day')})" for c in ("r_close", "spread_vwap_norm"))
    cells = ", ".join(f"CASE WHEN NOT (series = 'r_close' AND degenerate) THEN o.{n} END AS {n}" for n in flagged)
    body = f"SELECT o.ticker, o.win_end, series, {cells}, error, gap_ratio, max_gap_run, degenerate, low_conf FROM ({older}) o JOIN ({low}) f ON o.ticker = f.ticker AND o.win_end = f.win_end"
    register("fft_legacy_flags", sql.query(["m_merged"], body, ["gap_ratio", *flagged]))(lambda s, d: rounded(spectral.legacy_windows(grid(s, d), ["r_close", "spread_vwap_norm"], "day")))
    # every third day of one ticker stands still
    still = "ticker = 'N' AND day(day_id) % 3 = 0"
    sql.STEPS["m_still"] = (["m_merged"], f"SELECT * REPLACE (CASE WHEN {still} THEN 0.0 ELSE r_close END AS r_close) FROM m_merged")
    stands = lambda s, d: (lambda m: m.withColumn("r_close", F.when(F.expr(still), 0.0).otherwise(F.col("r_close"))))(grid(s, d))
    register("fft_legacy_still", sql.query(["m_still"], re.sub(r"\bm_merged\b", "m_still", body), ["gap_ratio", *flagged]))(
        lambda s, d: rounded(spectral.legacy_windows(stands(s, d), ["r_close", "spread_vwap_norm"], "day")),
    )
    derived = (
        "SELECT ticker, ts, CASE WHEN row_number() OVER (PARTITION BY ticker ORDER BY ts) = 1 THEN 0 ELSE ln(close) - lag(ln(close)) "
        "OVER (PARTITION BY ticker ORDER BY ts) END AS r_close FROM hour_bars"
    )
    register("default_series", sql.query(["hour_bars"], derived, ["r_close"]))(
        lambda s, d: rounded(spectral.with_series(catalog.hour_bars(s, d))[0].select(*KEY, "r_close")),
    )

    # a year of days: windows of over 300 bars; SQL takes too long over them
    register("cwt_legacy_year")(
        lambda s, d: rounded(spectral.per_window(spectral.with_series(build_bars(tables.trades(s, d), "day"))[0], ["r_close"], "year", spectral.LEGACY_CWT_NAMES, spectral.legacy_cwt_features)),
    )

    quarter = sql.bars("ticks", "minute").replace("date_trunc('minute', ts)::TIMESTAMP", "time_bucket(INTERVAL 15 MINUTE, ts)")
    simple("bars_15_minutes", lambda s, d: build_bars(tables.ticks(s, d), "min", 15), [*KEY, *OHLC, "transactions"], ["ticks"], f"({quarter})", OHLC)
    inside = lambda s, d: calendar.rth(half_hour_bars(s, d))
    simple("grid_half_hour", lambda s, d: calendar.hour_grid(inside(s, d)), ["ticker", "day_id", "ts"], ["h_grid"], "h_grid")
    kept = "(SELECT * FROM h_grid UNION ALL SELECT ticker, day_id, day_id::TIMESTAMP + INTERVAL 930 MINUTE FROM h_days WHERE ticker = 'A')"
    for half_bar in ("keep_half_bar", "pad_to_full_hour"):
        simple(
            f"grid_half_hour_{half_bar}",
            lambda s, d, h=half_bar: calendar.hour_grid(inside(s, d), h),
            ["ticker", "day_id", "ts"],
            ["h_grid"],
            kept,
        )
    simple(
        "merged_half_hour",
        lambda s, d: merge.merged(indicators.grid_indicators(cut(half_hour_bars(s, d), "bars")), ["atr_14", "bb_bw_20"]),
        [*KEY, "is_gap", "close", "minutes_since_open", *m],
        ["h_merged"],
        "h_merged",
        ["close", *m],
    )

    session = "CASE WHEN transactions % 3 = 0 THEN 'RTH' WHEN transactions % 3 = 1 THEN 'rth' ELSE 'pre' END"
    simple(
        "session_filter",
        lambda s, d: calendar.rth(catalog.hour_bars(s, d).withColumn("session", F.expr(session))),
        [*KEY, "session"],
        ["hour_bars"],
        f"(SELECT *, {session} AS session FROM hour_bars)",
        where="WHERE lower(session) = 'rth'",
    )
    day = (
        "SELECT ticker, ts, CAST(ts AS DATE) AS day_id, close, 0 AS is_gap, 'day' AS session, 0 AS bar_index_since_open, close - vwap AS spread_vwap, NULL::DOUBLE AS r_close, atr_14 AS ATR_14_day_mean, "
        f"(close - vwap) / nullif(atr_14, 0) AS spread_vwap_norm FROM (SELECT *, {sql.rolling('avg', 'tr', 14, 1)} AS atr_14 FROM (SELECT *, greatest(high - low, abs(high - lag(close) OVER ({sql.K})), abs(low - lag(close) OVER ({sql.K}))) AS tr FROM day_bars))"
    )
    simple(
        "merged_day", day_grid, [*KEY, "day_id", "close", "is_gap", "session", "bar_index_since_open", "spread_vwap", "r_close", "ATR_14_day_mean", "spread_vwap_norm"],
        ["day_bars"], f"({day})", ["close", "spread_vwap", "r_close", "ATR_14_day_mean", "spread_vwap_norm"],
    )
    bars = "count(*)::BIGINT AS AGG_N, avg(abs(spread_vwap_norm)) AS mabs_svn, first(spread_vwap_norm) AS eod_svn, 0::BIGINT AS valid_bars"
    simple(
        "agg_day_of_days",
        lambda s, d: features.daily(day_grid(s, d)),
        ["ticker", "day_id", "AGG_N", "mabs_svn", "eod_svn", "valid_bars"],
        ["day_bars"],
        f"(SELECT ticker, day_id, {bars} FROM ({day}) GROUP BY 1, 2)",
        ["mabs_svn", "eod_svn"],
    )
    for mode, hours_more, tag in (("treat_as_start", 1, "treat_as_start"), ("treat_as_end", 0, "treat_as_end"), ("as_is", 0, "treat_as_end")):
        simple(
            f"align_{mode}", lambda s, d, k=mode: documents.align_hours(catalog.hour_bars(s, d), k), [*KEY, "end_ts", "align"], ["hour_bars"], "hour_bars",
            exprs={"end_ts": f"ts + INTERVAL {hours_more} HOUR", "align": f"'{tag}'"},
        )
