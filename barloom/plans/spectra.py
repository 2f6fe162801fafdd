"""The spectral queries and their SQL: explicit transforms over segments and explicit convolutions."""

from __future__ import annotations

from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import rounded
from barloom.operators import calendar, spectral
from barloom.plans import sql
from barloom.plans.registry import register

BANDS = {"lo": ("1e-12::DOUBLE", "1.0::DOUBLE / 60"), "mid": ("1.0::DOUBLE / 60", "1.0::DOUBLE / 15"), "hi": ("1.0::DOUBLE / 15", "0.5::DOUBLE")}
WIN = "PARTITION BY ticker, win_end"


def in_windows(source: str, cadence: str) -> str:
    return f"(SELECT *, {sql.window_end('ts', cadence)} AS win_end FROM {source})"


def quality(source: str, column: str, cadence: str, bars: int, gap: float, run: int, share: float, least: int) -> str:
    """One row a window: values, gap share, longest gap and whether they pass."""
    days = "count(DISTINCT CAST(ts AS DATE))"
    flat = (
        f"SELECT ticker, win_end, min(ts) AS win_start, {days}::BIGINT AS days, count({column})::BIGINT AS n_valid, ({days} * {bars})::BIGINT "
        f"AS expected_bars FROM {in_windows(source, cadence)} GROUP BY 1, 2"
    )
    runs = sql.longest(in_windows(source, cadence), "ticker, win_end", f"CASE WHEN {column} IS NULL THEN 1 END", "max_gap_run")
    valid = "n_valid::DOUBLE / expected_bars"
    return (
        f"SELECT a.ticker, a.win_end, win_start, days, n_valid, expected_bars, max_gap_run, 1 - {valid} AS gap_ratio, "
        f"({valid} >= {share} AND 1 - {valid} <= {gap} AND max_gap_run <= {run} AND n_valid >= {least}) AS passed "
        f"FROM ({flat}) a JOIN ({runs}) b ON a.ticker = b.ticker AND a.win_end = b.win_end"
    )


def spectrum(samples: str, seg: str, overlap: str, centre: bool, density: bool) -> str:
    """(ticker, win_end, n, f, p) of ``samples`` (ticker, win_end, n, i, x): the mean over Hann-windowed segments."""
    cut = f"SELECT *, {seg} AS l, {seg} - {overlap} AS step FROM ({samples})"
    parts = f"SELECT *, unnest(range(0, (n - l) // step + 1)) AS s FROM ({cut})"
    rows = f"SELECT ticker, win_end, n, l, s, (i - s * step)::DOUBLE AS t, x FROM ({parts}) WHERE i >= s * step AND i < s * step + l"
    level = f"x - avg(x) OVER ({WIN}, s)" if centre else "x"
    tapered = f"SELECT ticker, win_end, n, l, s, t, 0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * t / l) AS w, {level} AS x FROM ({rows})"
    bins = f"SELECT *, unnest(range(1, l // 2 + 1)) AS k FROM ({tapered})"
    weight = "sum(w * w)" if density else "sum(w) * sum(w)"
    one = (
        f"SELECT ticker, win_end, n, l, s, k, (power(sum(w * x * cos(2 * pi() * k * t / l)), 2) + power(sum(w * x * sin(2 * pi() * k * t / l)), 2)) / ({weight}) AS p "
        f"FROM ({bins}) GROUP BY ALL"
    )
    return (
        f"SELECT ticker, win_end, n, k::DOUBLE / l AS f, CASE WHEN 2 * k = l THEN 1 ELSE 2 END * avg(p) AS p FROM ({one}) GROUP BY "
        "ticker, win_end, n, l, k"
    )


def welch(source: str, column: str, cadence: str, nperseg: int, noverlap: int) -> str:
    """One row a window with the features of its finite samples."""
    samples = (
        f"SELECT ticker, win_end, count(*) OVER ({WIN}) AS n, row_number() OVER ({WIN} ORDER BY ts) - 1 AS i, {column}::DOUBLE - avg({column}::DOUBLE) OVER ({WIN}) AS x "
        f"FROM {in_windows(source, cadence)} WHERE {column} IS NOT NULL QUALIFY n >= 4"
    )
    seg = f"least({nperseg}, n)"
    power = spectrum(samples, seg, f"least({noverlap}, {seg} - 1)", True, True)
    order = f"OVER ({WIN} ORDER BY f)"
    pieces = f"SELECT *, lag(f) {order} AS pf, (f - lag(f) {order}) * (p + lag(p) {order}) / 2 AS a, max(p) OVER ({WIN}) AS top FROM ({power})"
    bands = ", ".join(f"coalesce(sum(a) FILTER (pf >= {x} AND f <= {y}), 0) AS power_{b}" for b, (x, y) in BANDS.items())
    sums = (
        f"SELECT ticker, win_end, coalesce(sum(a), 0) AS power_total, {bands}, min(f) FILTER (p >= top * (1 - 1e-9)) AS dom_freq_cpb, "
        f"coalesce(sum(f * p) / nullif(sum(p), 0), 0) AS centroid_freq_cpb FROM ({pieces}) GROUP BY 1, 2"
    )
    shares = ", ".join(f"coalesce(power_{b} / nullif(power_total, 0), 0) AS pct_{b}" for b in BANDS)
    return f"SELECT *, {shares}, 1 / nullif(dom_freq_cpb, 0) AS dom_period_bars, 1 / nullif(centroid_freq_cpb, 0) AS centroid_period_bars FROM ({sums})"


def with_quality(kept: str, made: str, names: list[str], column: str) -> str:
    gated = ", ".join(f"CASE WHEN passed THEN m.{n} END AS {n}" for n in names)
    return (
        f"SELECT q.*, '{column}' AS series, {gated}, NULL::VARCHAR AS error FROM ({kept}) q LEFT JOIN ({made}) m ON q.ticker = m.ticker "
        "AND q.win_end = m.win_end"
    )


def fft_windows(source: str, columns: list[str], cadence: str, bars: int, nperseg: int = 256, noverlap: int = 128, gap: float = 0.10, share: float = 0.75) -> str:
    return " UNION ALL ".join(
        f"({with_quality(quality(source, c, cadence, bars, gap, 30, share, 4), welch(source, c, cadence, nperseg, noverlap), spectral.FFT_NAMES, c)})" for c in columns
    )


def wide(long: str, columns: list[str], names: list[str]) -> str:
    cells = ", ".join(f"any_value({n}) FILTER (series = '{c}') AS {c}_{n}" for c in columns for n in names)
    return f"SELECT ticker, win_end, {cells} FROM ({long}) GROUP BY 1, 2"


def legacy_fft(source: str, column: str, cadence: str) -> str:
    """The older features; the spread loses its linear trend first."""
    x, i = f"{column}::DOUBLE", f"row_number() OVER ({WIN} ORDER BY ts) - 1"
    rows = f"SELECT ticker, win_end, ts, {x} - avg({x}) OVER ({WIN}) AS x, {i} AS i FROM {in_windows(source, cadence)}"
    if column == "spread_vwap_norm":
        known = "CASE WHEN x IS NOT NULL THEN i END"
        line = f"regr_slope(x, i) OVER ({WIN}) * (i - avg({known}) OVER ({WIN})) + avg(x) OVER ({WIN})"
        enough = f"count(x) OVER ({WIN}) >= 3 AND stddev_pop(x) OVER ({WIN}) >= 1e-12"
        rows = f"SELECT ticker, win_end, ts, CASE WHEN {enough} THEN x - ({line}) ELSE x END AS x FROM ({rows})"
    rows = f"SELECT ticker, win_end, ts, coalesce(x, 0) AS x FROM ({rows})"
    samples = (
        f"SELECT ticker, win_end, count(*) OVER ({WIN}) AS n, row_number() OVER ({WIN} ORDER BY ts) - 1 AS i, x / nullif(stddev_pop(x) "
        f"OVER ({WIN}), 0) AS x FROM ({rows})"
    )
    samples = f"SELECT * FROM ({samples}) WHERE n >= 8 AND x IS NOT NULL"
    seg = "greatest(8, least(128, n))"
    power = spectrum(samples, seg, f"greatest(0, least(64, {seg} - 1))", False, False)
    share = lambda where: f"coalesce(sum(p) FILTER ({where}), 0) / sum(p)"
    features = (
        f"SELECT ticker, win_end, {share('f < 1.0::DOUBLE / 60')} AS power_lo, {share('f >= 1.0::DOUBLE / 60 AND f < 1.0::DOUBLE / 15')} AS power_mid, {share('f >= 1.0::DOUBLE / 15')} AS power_hi, "
        "sum(f * p) / sum(p) AS centroid, exp(avg(ln(p + 1e-12))) / (avg(p) + 1e-12) AS flatness, arg_max(f, p) AS peak_freq, max(p) / sum(p) AS peak_ratio, "
        f"sum(p) / sum(f * p) AS centroid_period, 1 / arg_max(f, p) AS peak_period FROM ({power}) GROUP BY 1, 2 HAVING sum(p) > 1e-12"
    )
    names = ", ".join(f"m.{n}" for n in spectral.LEGACY_FFT_NAMES)
    windows = f"SELECT DISTINCT ticker, win_end FROM {in_windows(source, cadence)}"
    return (
        f"SELECT w.ticker, w.win_end, '{column}' AS series, {names}, NULL::VARCHAR AS error FROM ({windows}) w LEFT JOIN ({features}) "
        "m ON w.ticker = m.ticker AND w.win_end = m.win_end"
    )


def scalogram(source: str, column: str, cadence: str) -> str:
    """(ticker, win_end, n, j, period, t, p): squared Morlet coefficients outside the cone of influence, others 0."""
    rows = f"SELECT ticker, win_end, ts, coalesce({column}::DOUBLE - avg({column}::DOUBLE) OVER ({WIN}), 0) AS x FROM {in_windows(source, cadence)}"
    samples = (
        f"SELECT ticker, win_end, count(*) OVER ({WIN}) AS n, row_number() OVER ({WIN} ORDER BY ts) - 1 AS i, x / nullif(stddev_pop(x) "
        f"OVER ({WIN}), 0) AS x FROM ({rows})"
    )
    samples = f"SELECT * FROM ({samples}) WHERE n >= 16 AND x IS NOT NULL"
    step = "(16.0::DOUBLE / 4095)"
    psi = (
        f"SELECT g, sum(exp(-t * t / 2) * cos(5 * t)) OVER (ORDER BY g ROWS UNBOUNDED PRECEDING) * {step} AS v FROM (SELECT g, -8 + "
        f"g * {step} AS t FROM range(0, 4096) r(g))"
    )
    scales = "SELECT j, 5 * power(24.0::DOUBLE, j / 35.0::DOUBLE) AS period, 13.0::DOUBLE / 16 * period AS s FROM range(0, 36) r(j)"
    taps = (
        f"SELECT j, s, h, CAST(floor(h / (s * {step})) AS BIGINT) AS g FROM (SELECT *, unnest(range(0, CAST(ceil(16 * s + 1) AS BIGINT))) "
        f"AS h FROM ({scales}))"
    )
    kernel = f"SELECT j, s, count(*) OVER (PARTITION BY j) AS len, len - 1 - h AS u, v FROM ({taps}) JOIN ({psi}) USING (g)"
    # the differences of neighbouring taps, also over both ends
    edges = f"SELECT j, s, len, unnest([u - 1, u]) AS u, unnest([v, -v]) AS d FROM ({kernel})"
    taps = f"SELECT j, s, len, u, sum(d) AS d FROM ({edges}) GROUP BY ALL"
    places = f"SELECT ticker, win_end, n, i AS t, j, s, period FROM (SELECT DISTINCT ticker, win_end, n, i FROM ({samples})), ({scales})"
    lens = f"SELECT DISTINCT j, len FROM ({kernel})"
    sums = (
        f"SELECT a.ticker, a.win_end, a.n, a.t, a.j, sum(b.x * k.d) AS c FROM ({places}) a JOIN ({lens}) m ON m.j = a.j JOIN ({samples}) b ON a.ticker = b.ticker AND a.win_end = b.win_end "
        f"JOIN ({taps}) k ON k.j = a.j AND k.u = a.t + (m.len - 2) // 2 - b.i GROUP BY ALL"
    )
    half = "least(CAST(ceil(sqrt(2.0::DOUBLE) * a.s) AS BIGINT), a.n // 2)"
    return (
        f"SELECT a.ticker, a.win_end, a.n, a.j, a.period, a.t, a.s, {half} AS half, CASE WHEN a.t >= {half} AND a.t < a.n - {half} THEN a.s * coalesce(c, 0) * coalesce(c, 0) ELSE 0 END AS p "
        f"FROM ({places}) a LEFT JOIN ({sums}) c ON a.ticker = c.ticker AND a.win_end = c.win_end AND a.t = c.t AND a.j = c.j"
    )


def _compactness(grid: str) -> str:
    energy = f"SELECT ticker, win_end, t, sum(p) AS e FROM ({grid}) GROUP BY 1, 2, 3"
    cum = f"SELECT ticker, win_end, sum(e) OVER ({WIN} ORDER BY e, t ROWS UNBOUNDED PRECEDING) / sum(e) OVER ({WIN}) AS c FROM ({energy})"
    return f"SELECT ticker, win_end, 1 - 2 * avg(c) AS temporal_compactness FROM ({cum}) GROUP BY 1, 2"


def cwt_features(grid: str) -> str:
    share = lambda where: f"coalesce(sum(p) FILTER ({where}), 0) / sum(p)"
    sums = (
        f"SELECT ticker, win_end, {share('period > 60')} AS power_lo, {share('period BETWEEN 15 AND 60')} AS power_mid, {share('period < 15')} AS power_hi, "
        f"sum(p) / sum(p / period) AS centroid_period_bars, arg_max(period, p) AS peak_period_bars, max(p) / sum(p) AS peak_ratio FROM ({grid}) GROUP BY 1, 2 HAVING sum(p) > 0"
    )
    return f"SELECT a.*, temporal_compactness FROM ({sums}) a JOIN ({_compactness(grid)}) b ON a.ticker = b.ticker AND a.win_end = b.win_end"


def cwt_windows(source: str, columns: list[str], cadence: str, bars: int) -> tuple[str, str]:
    """(grids, body): the scalograms as named subqueries and the gated features over them."""
    grids = ", ".join(f"grid_{c} AS MATERIALIZED ({scalogram(source, c, cadence)})" for c in columns)
    body = " UNION ALL ".join(
        f"({with_quality(quality(source, c, cadence, bars, 0.20, 30, 0.75, 16), cwt_features(f'SELECT * FROM grid_{c}'), spectral.CWT_NAMES, c)})" for c in columns
    )
    return grids, body


def ridge_table(grid: str) -> str:
    """One row for each stretch in which the strongest scale passes the 95th percentile of the window."""
    best = f"SELECT ticker, win_end, t, max(p) AS power, first(period ORDER BY p DESC, j) AS period FROM ({grid}) GROUP BY 1, 2, 3"
    edge = f"SELECT ticker, win_end, quantile_cont(p, 0.95) FILTER (p > 0) AS least FROM ({grid}) GROUP BY 1, 2"
    high = (
        f"SELECT b.*, t - row_number() OVER (PARTITION BY b.ticker, b.win_end ORDER BY t) AS run FROM ({best}) b JOIN ({edge}) e ON "
        "b.ticker = e.ticker AND b.win_end = e.win_end WHERE power >= least"
    )
    return (
        "SELECT ticker, win_end, min(t)::INTEGER AS t_start, max(t)::INTEGER AS t_end, avg(period) AS avg_period, max(power) AS max_power "
        f"FROM ({high}) GROUP BY ticker, win_end, run"
    )


def legacy_cwt(source: str, column: str, cadence: str) -> str:
    grid = f"SELECT * FROM grid_{column}"
    energy = lambda where: f"coalesce(sum(p) FILTER ({where}), 0) / sum(p)"
    more = (
        f"SELECT ticker, win_end, exp(avg(ln(p + 1e-12)) FILTER (p > 0)) / (avg(p) FILTER (p > 0) + 1e-12) AS flatness, arg_max(t, p)::DOUBLE AS peak_time, "
        f"{energy('t < 60')} AS energy_open, {energy('t >= 60 AND t < 300')} AS energy_mid, {energy('t >= 300')} AS energy_late, "
        f"avg(CASE WHEN t >= half AND t < n - half THEN 1.0::DOUBLE ELSE 0 END) AS cover_ratio FROM ({grid}) GROUP BY 1, 2"
    )
    ridges = (
        "SELECT ticker, win_end, count(*)::DOUBLE AS ridge_count, avg(avg_period) AS ridge_avg_period, stddev_pop(avg_period) AS ridge_period_std "
        f"FROM ({ridge_table(grid)}) GROUP BY 1, 2"
    )
    names = ", ".join(f"CASE WHEN a.ticker IS NOT NULL THEN {n} END AS {n}" for n in spectral.LEGACY_CWT_NAMES)
    return (
        f"SELECT w.ticker, w.win_end, '{column}' AS series, {names}, NULL::VARCHAR AS error FROM (SELECT DISTINCT ticker, win_end FROM {in_windows(source, cadence)}) w "
        f"LEFT JOIN ({cwt_features(grid)}) a ON w.ticker = a.ticker AND w.win_end = a.win_end LEFT JOIN ({more}) b ON w.ticker = b.ticker AND w.win_end = b.win_end "
        f"LEFT JOIN ({ridges}) r ON w.ticker = r.ticker AND w.win_end = r.win_end"
    )


def reduced(days: str, cadence: str, reducer: str, columns: list[str], bars: int) -> str:
    """Daily rows over windows."""
    one = {"median": "median({c})", "mean": "avg({c})", "weighted_mean": "sum({c} * valid_bars::DOUBLE) / nullif(sum(valid_bars::DOUBLE) FILTER ({c} IS NOT NULL), 0)"}[reducer]
    end = sql.window_end("(day_id::TIMESTAMP + INTERVAL 1 MICROSECOND)", cadence)
    cells = ", ".join(f"{one.format(c=c)} AS {c}" for c in columns)
    return (
        f"SELECT ticker, '{cadence}' AS window_cadence, {end} AS win_end, min(day_id)::TIMESTAMP AS win_start, count(*)::BIGINT AS days, (count(*) * {bars})::BIGINT AS expected_bars, "
        f"sum(valid_bars)::BIGINT AS valid_bars, sum(valid_bars)::DOUBLE / (count(*) * {bars}) AS cover_ratio, {cells} FROM ({days}) GROUP BY 1, 2, 3"
    )


def over_grids(grids: str, body: str, source: str, round_: list[str]) -> str:
    return sql.query([source], body, round_).replace(" SELECT * REPLACE", f", {grids} SELECT * REPLACE", 1)


def register_all(merged) -> None:
    """Registers the spectral queries over ``merged``, the hour grid."""
    welch_columns, wide_columns, legacy = ["r_close", "spread_vwap_norm", "volume_z_by_tod", "bb_bw_20"], ["r_close", "volume_z_by_tod"], ["r_close", "spread_vwap_norm"]
    wide_names = [*spectral.FFT_NAMES, "n_valid", "gap_ratio", "max_gap_run"]
    counts = {"n_valid", "max_gap_run"}

    register("fft_welch_multi", sql.query(["merged"], fft_windows("merged", welch_columns, "month", 6, 32, 16), ["gap_ratio", *spectral.FFT_NAMES]))(
        lambda s, d: rounded(spectral.fft_windows(merged(s, d), welch_columns, "month", "hour", 32, 16))
    )
    register("fft_wide", sql.query(["merged"], wide(fft_windows("merged", wide_columns, "week", 6), wide_columns, wide_names), [f"{c}_{n}" for c in wide_columns for n in wide_names if n not in counts]))(
        lambda s, d: rounded(spectral.wide(spectral.fft_windows(merged(s, d), wide_columns, "week"), wide_columns, wide_names))
    )
    register("fft_legacy", sql.query(["merged"], " UNION ALL ".join(f"({legacy_fft('merged', c, 'month')})" for c in legacy), spectral.LEGACY_FFT_NAMES))(
        lambda s, d: rounded(spectral.per_window(merged(s, d), legacy, "month", spectral.LEGACY_FFT_NAMES, {c: partial(spectral.legacy_fft_features, detrend=c == "spread_vwap_norm") for c in legacy}))
    )
    grids, body = cwt_windows("merged", ["r_close"], "month", 6)
    register("cwt", over_grids(grids, body, "merged", ["gap_ratio", *spectral.CWT_NAMES]))(
        lambda s, d: rounded(spectral.cwt_windows(merged(s, d), ["r_close"], "month")),
    )
    grids, _ = cwt_windows("merged", legacy, "month", 6)
    register("cwt_legacy", over_grids(grids, " UNION ALL ".join(f"({legacy_cwt('merged', c, 'month')})" for c in legacy), "merged", spectral.LEGACY_CWT_NAMES))(
        lambda s, d: rounded(spectral.per_window(merged(s, d), legacy, "month", spectral.LEGACY_CWT_NAMES, spectral.legacy_cwt_features))
    )
    grids, _ = cwt_windows("merged", ["r_close"], "month", 6)
    register("cwt_ridges", over_grids(grids, ridge_table("SELECT * FROM grid_r_close"), "merged", ["avg_period", "max_power"]))(
        lambda s, d: rounded(ridges(merged(s, d))),
    )


def ridges(merged: DataFrame, column: str = "r_close", cadence: str = "month") -> DataFrame:
    """One row for each ridge of each window."""
    rows = merged.withColumn("win_end", calendar.window_end(F.col("ts"), cadence)).select("ticker", "win_end", "ts", column)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = spectral.ridges(pdf.sort_values("ts")[column].to_numpy(float))
        return pd.DataFrame(
            [(pdf["ticker"].iloc[0], pdf["win_end"].iloc[0], *r) for r in found],
            columns=["ticker", "win_end", "t_start", "t_end", "avg_period", "max_power"],
        )

    return rows.groupBy("ticker", "win_end").applyInPandas(
        run,
        "ticker string, win_end timestamp_ntz, t_start int, t_end int, avg_period double, max_power double",
    )
