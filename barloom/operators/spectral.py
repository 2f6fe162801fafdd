"""Spectral features of windows: Welch's power spectrum and a Morlet scalogram, one window at a time on Arrow.

A window is a (ticker, cadence) bin of bars, so a group is small (a ticker's bars of one bin) and windows spread over
tasks. For windows of one segment ``dft_single`` gives the same features with joins and sums alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.series import number, positive_log, ratio, series
from barloom.operators import calendar
from barloom.operators.features import judged, low_confidence
from barloom.operators.quarantine import strict

BANDS = {"lo": (1e-12, 1 / 60), "mid": (1 / 60, 1 / 15), "hi": (1 / 15, 0.5)}
FFT_NAMES = [
    "power_total",
    "power_lo",
    "power_mid",
    "power_hi",
    "pct_lo",
    "pct_mid",
    "pct_hi",
    "dom_freq_cpb",
    "dom_period_bars",
    "centroid_freq_cpb",
    "centroid_period_bars",
]
CWT_NAMES = ["power_lo", "power_mid", "power_hi", "centroid_period_bars", "peak_period_bars", "peak_ratio", "temporal_compactness"]
LEGACY_FFT_NAMES = ["power_lo", "power_mid", "power_hi", "centroid", "flatness", "peak_freq", "peak_ratio", "centroid_period", "peak_period"]
LEGACY_CWT_NAMES = [
    *CWT_NAMES,
    "flatness",
    "peak_time",
    "energy_open",
    "energy_mid",
    "energy_late",
    "ridge_count",
    "ridge_avg_period",
    "ridge_period_std",
    "cover_ratio",
]
PERIODS = np.geomspace(5, 120, 36)
#: Samples that are transformed at a time; shorter series are transformed whole.
BLOCK = 1 << 14
CENTRE = 13 / 16  # of the Morlet wavelet, in cycles per unit of scale


def hann(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def welch(x: np.ndarray, nperseg: int, noverlap: int, centre: bool = True, density: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One-sided spectrum without zero frequency, the mean over Hann-windowed segments; a rest goes unused."""
    w = hann(nperseg)
    starts = range(0, len(x) - nperseg + 1, nperseg - noverlap)
    parts = np.stack([x[s : s + nperseg] for s in starts])
    if centre:
        parts = parts - parts.mean(axis=1, keepdims=True)
    power = (np.abs(np.fft.rfft(parts * w, axis=1)) ** 2).mean(axis=0) / ((w * w).sum() if density else w.sum() ** 2)
    power[1 : None if nperseg % 2 else -1] *= 2
    return np.fft.rfftfreq(nperseg)[1:], power[1:]


def _inverse(f: float) -> float:
    return 1 / f if f > 0 else np.nan


def welch_features(x: np.ndarray, nperseg: int, noverlap: int) -> list[float]:
    """FFT_NAMES of the finite samples; bands include both edges and integrate by trapezoids."""
    x = x[np.isfinite(x)]
    if len(x) < 4:
        return [np.nan] * len(FFT_NAMES)
    nperseg = min(max(nperseg, 1), len(x))
    f, p = welch(x - x.mean(), nperseg, min(max(noverlap, 0), nperseg - 1))
    total = float(np.trapezoid(p, f))
    bands = [float(np.trapezoid(p[m], f[m])) for m in ((f >= a) & (f <= b) for a, b in BANDS.values())]
    top = float(f[np.argmax(p >= p.max() * (1 - 1e-9))])  # the lowest of frequencies that differ by rounding
    centre = float((f * p).sum() / p.sum()) if p.sum() > 0 else 0.0
    return [total, *bands, *(b / total if total > 0 else 0.0 for b in bands), top, _inverse(top), centre, _inverse(centre)]


def robust_detrend(x: np.ndarray) -> np.ndarray:
    ok = np.isfinite(x)
    if ok.sum() < 3 or x[ok].std() < 1e-12:
        return x
    t = np.arange(len(x), dtype=float)
    slope = ((t[ok] - t[ok].mean()) * (x[ok] - x[ok].mean())).sum() / ((t[ok] - t[ok].mean()) ** 2).sum()
    return x - slope * (t - t[ok].mean()) - x[ok].mean()


def legacy_fft_features(x: np.ndarray, detrend: bool = False) -> list[float]:
    """The older variant: standardised, power sums, half-open bands, flatness and peak share."""
    x = x - np.nanmean(x) if np.isfinite(x).any() else x
    x = np.nan_to_num(robust_detrend(x) if detrend else x, nan=0.0, posinf=0.0, neginf=0.0)
    nan = [np.nan] * len(LEGACY_FFT_NAMES)
    if len(x) < 8 or not (sd := x.std()):
        return nan
    nperseg = max(8, min(128, len(x)))
    f, p = welch(x / sd, nperseg, max(0, min(64, nperseg - 1)), centre=False, density=False)
    total = p.sum()
    if not np.isfinite(total) or total <= 1e-12:
        return nan
    bands = [p[m].sum() / total for m in (f < 1 / 60, (f >= 1 / 60) & (f < 1 / 15), f >= 1 / 15)]
    centre, k = float((f * p).sum() / total), int(np.argmax(p))
    flat = float(np.exp(np.log(p + 1e-12).mean()) / (p.mean() + 1e-12))
    return [*bands, centre, flat, float(f[k]), float(p[k] / total), _inverse(centre), _inverse(float(f[k]))]


def _integrated_morlet() -> tuple[np.ndarray, float]:
    t = np.linspace(-8, 8, 1 << 12)
    return np.cumsum(np.exp(-t * t / 2) * np.cos(5 * t)) * (t[1] - t[0]), float(t[1] - t[0])


@lru_cache(maxsize=16)
def _kernels(scales: tuple[float, ...]) -> list[np.ndarray]:
    psi, step = _integrated_morlet()
    found = [np.floor(np.arange(16 * s + 1) / (s * step)).astype(int) for s in scales]
    return [psi[at[at < len(psi)]][::-1] for at in found]


@lru_cache(maxsize=4)
def _spectra(scales: tuple[float, ...], size: int) -> np.ndarray:
    """The transforms of all kernels at a size: made once in each worker for windows of like lengths."""
    return np.stack([np.fft.rfft(k, size) for k in _kernels(scales)])


def convolved(x: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Full convolutions of ``x`` with every scale's kernel, block by block through transforms (overlap-add)."""
    key = tuple(float(s) for s in scales)
    longest = max(map(len, _kernels(key)))
    size = 1 << (min(len(x), max(BLOCK, longest)) + longest - 2).bit_length()
    step = size - longest + 1
    out = np.zeros((len(scales), len(x) + longest - 1 + size))
    for k in range(0, len(x), step):
        out[:, k : k + size] += np.fft.irfft(np.fft.rfft(x[k : k + step], size) * _spectra(key, size), size, axis=1)
    return out[:, : len(x) + longest - 1]


def scalogram(x: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Squared Morlet coefficients, scales by time."""
    out = np.empty((len(scales), len(x)))
    lengths = [len(k) for k in _kernels(tuple(float(s) for s in scales))]
    for i, (s, full) in enumerate(zip(scales, convolved(x, scales))):
        c = -np.sqrt(s) * np.diff(full[: len(x) + lengths[i] - 1])
        cut = (len(c) - len(x)) / 2
        out[i] = c[int(np.floor(cut)) : len(c) - int(np.ceil(cut))] ** 2 if cut > 0 else c[: len(x)] ** 2
    return out


def influence(scales: np.ndarray, n: int) -> np.ndarray:
    """False within sqrt(2) scales of either end."""
    half = np.minimum(np.ceil(np.sqrt(2) * scales).astype(int), n // 2)[:, None]
    t = np.arange(n)[None, :]
    return (t >= half) & (t < n - half)


def compactness(energy: np.ndarray) -> float:
    """One less twice the mean of the cumulated sorted shares."""
    total = np.maximum(energy, 0).sum()
    return float(1 - 2 * np.cumsum(np.sort(np.maximum(energy, 0)) / total).mean()) if total > 0 else np.nan


def _power(x: np.ndarray, periods: np.ndarray) -> np.ndarray | None:
    ok = np.isfinite(x)
    if len(x) < 16 or not ok.any():
        return None
    x = np.where(ok, x - x[ok].mean(), 0.0)
    if not (sd := x.std()):
        return None
    scales = CENTRE * periods
    p = np.where(influence(scales, len(x)), scalogram(x / sd, scales), 0.0)
    return p if np.isfinite(p.sum()) and p.sum() > 0 else None


def cwt_features(x: np.ndarray, periods: np.ndarray = PERIODS) -> list[float]:
    if (p := _power(x, periods)) is None:
        return [np.nan] * len(CWT_NAMES)
    total = p.sum()
    bands = [p[m].sum() / total for m in (periods > 60, (periods >= 15) & (periods <= 60), periods < 15)]
    centre = float((p.sum(axis=1) / periods).sum() / total)
    k = np.unravel_index(np.argmax(p), p.shape)
    return [*bands, _inverse(centre), float(periods[k[0]]), float(p[k] / total), compactness(p.sum(axis=0))]


def ridges(x: np.ndarray, periods: np.ndarray = PERIODS, percentile: float = 95) -> list[tuple[int, int, float, float]]:
    """(first, last, mean period, greatest power) of the stretches where the strongest scale passes the percentile."""
    if (p := _power(x, periods)) is None:
        return []
    best = p.argmax(axis=0)
    power = p[best, np.arange(p.shape[1])]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], power >= np.percentile(p[p > 0], percentile), [False]])))
    return [(int(a), int(b - 1), float(periods[best[a:b]].mean()), float(power[a:b].max())) for a, b in zip(edges[::2], edges[1::2])]


def legacy_cwt_features(x: np.ndarray, periods: np.ndarray = PERIODS) -> list[float]:
    base = cwt_features(x, periods)
    if (p := _power(x, periods)) is None:
        return base + [np.nan] * (len(LEGACY_CWT_NAMES) - len(base))
    n, energy, live = p.shape[1], p.sum(axis=0), p[p > 0]
    flat = float(np.exp(np.log(live + 1e-12).mean()) / (live.mean() + 1e-12))
    a, b = min(60, n), min(300, n)
    thirds = [energy[i:j].sum() / energy.sum() for i, j in ((0, a), (a, b), (b, n))]
    mean = [r[2] for r in ridges(x, periods)]
    k = np.unravel_index(np.argmax(p), p.shape)
    return [
        *base,
        flat,
        float(k[1]),
        *thirds,
        float(len(mean)),
        float(np.mean(mean)) if mean else np.nan,
        float(np.std(mean)) if mean else np.nan,
        float(influence(CENTRE * periods, n).mean()),
    ]


def longest_gap(x: np.ndarray) -> int:
    """The longest run of samples that are missing."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], np.isnan(x), [False]])))
    return int((edges[1::2] - edges[::2]).max(initial=0))


def per_window(df: DataFrame, columns: list[str], cadence: str, names: list[str], f: Callable[[np.ndarray], list[float]] | dict[str, Callable[[np.ndarray], list[float]]], quality: bool = False) -> DataFrame:
    """Long rows (ticker, win_end, series, names..., error): ``f`` (or the column's own) of each column's samples in time order.

    A window whose features fail has the message in ``error`` and null features; the others go on. With ``quality``
    that of its samples (win_start, days, n_valid, max_gap_run) comes from the same call, so the bars are read once.
    """
    rows = df.withColumn("win_end", calendar.window_end(F.col("ts"), cadence)).select("ticker", "win_end", "ts", *columns)
    more = ["win_start", "days", "n_valid", "max_gap_run"]
    schema = "ticker string, win_end timestamp_ntz, series string, " + ", ".join(f"{n} double" for n in names) + ", error string, win_start timestamp_ntz, " + ", ".join(f"{n} bigint" for n in more[1:])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        days = pdf["ts"].dt.normalize().nunique()
        out = []
        for c in columns:
            error = None
            x = pdf[c].to_numpy(float)
            try:
                made = (f[c] if isinstance(f, dict) else f)(x)
            except (ValueError, FloatingPointError, IndexError) as e:
                made, error = [np.nan] * len(names), str(e)
            features = (None if not np.isfinite(v) else v for v in made)
            out.append([pdf["ticker"].iloc[0], pdf["win_end"].iloc[0], c, *features, error, pdf["ts"].iloc[0], days, int((~np.isnan(x)).sum()), longest_gap(x)])
        return pd.DataFrame(out, columns=["ticker", "win_end", "series", *names, "error", *more])

    made = rows.groupBy("ticker", "win_end").applyInPandas(run, schema)
    return made if quality else made.drop(*more)


def fft_windows(df: DataFrame, columns: list[str], cadence: str, sampling: str = "hour", nperseg: int = 256, noverlap: int = 128, gap: float = 0.10, run: int = 30, share: float = 0.75, least: int = 0) -> DataFrame:
    """Welch features with their quality columns; null where the quality fails. Below ``least`` samples a window fails."""
    made = per_window(df, columns, cadence, FFT_NAMES, strict(lambda x: welch_features(x, nperseg, noverlap), least), quality=True)
    return _gated(made, sampling, FFT_NAMES, gap, run, share, 4)


def cwt_windows(df: DataFrame, columns: list[str], cadence: str, sampling: str = "hour", gap: float = 0.20, run: int = 30, share: float = 0.75, least: int = 0) -> DataFrame:
    made = per_window(df, columns, cadence, CWT_NAMES, strict(cwt_features, least), quality=True)
    return _gated(made, sampling, CWT_NAMES, gap, run, share, 16)


def _gated(made: DataFrame, sampling: str, names: list[str], gap: float, run: int, share: float, least: int) -> DataFrame:
    out = judged(made, sampling, gap, run, share, least)
    return out.withColumns({n: F.when(F.col("passed"), F.col(n)) for n in names})


def wide(df: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """One row a window with {series}_{feature} columns; the series are named, so the plan needs no extra pass."""
    return df.groupBy("ticker", "win_end").pivot("series", columns).agg(*[F.first(n).alias(n) for n in names])


def dft_single(df: DataFrame, column: str, cadence: str) -> DataFrame:
    """Welch features of windows that are one segment, by joins and sums: an explicit transform at each frequency."""
    w = series("ticker", "win_end")
    rows = df.where(F.col(column).isNotNull()).withColumn("win_end", calendar.window_end(F.col("ts"), cadence))
    rows = rows.select("ticker", "win_end", (F.row_number().over(w) - 1).alias("i"), F.col(column).alias("x"))
    stats = rows.groupBy("ticker", "win_end").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m")).where("n >= 4")
    rows = rows.join(stats, ["ticker", "win_end"])
    turn = 2 * F.pi() * F.col("i") / F.col("n")
    taper = 0.5 - 0.5 * F.cos(turn)
    rows = rows.select(
        "ticker",
        "win_end",
        "n",
        "i",
        (taper * (F.col("x") - F.col("m"))).alias("y"),
        (taper * taper).alias("w2"),
        F.explode(F.sequence(F.lit(1), F.floor(F.col("n") / 2).cast("int"))).alias("k"),
    )
    angle = 2 * F.pi() * F.col("k") * F.col("i") / F.col("n")
    bins = rows.groupBy("ticker", "win_end", "n", "k").agg(
        F.sum(F.col("y") * F.cos(angle)).alias("re"),
        F.sum(F.col("y") * F.sin(angle)).alias("im"),
        F.sum("w2").alias("w2"),
    )
    twice = F.when(2 * F.col("k") == F.col("n"), 1.0).otherwise(2.0)
    bins = bins.select(
        "ticker",
        "win_end",
        "n",
        (F.col("k") / F.col("n")).alias("f"),
        (twice * (F.col("re") * F.col("re") + F.col("im") * F.col("im")) / F.col("w2")).alias("p"),
    )
    order = series("ticker", "win_end", ts="f")
    bins = bins.withColumns({"pf": F.lag("f").over(order), "pp": F.lag("p").over(order)})
    piece = (F.col("f") - F.col("pf")) * (F.col("p") + F.col("pp")) / 2

    def band(name: str):
        a, b = BANDS[name]
        return F.coalesce(F.sum(F.when((F.col("pf") >= a) & (F.col("f") <= b), piece)), F.lit(0.0))

    out = bins.groupBy("ticker", "win_end", F.col("n").alias("FFT_N")).agg(
        F.coalesce(F.sum(piece), F.lit(0.0)).alias("power_total"), *[band(b).alias(f"power_{b}") for b in BANDS],
        F.max_by("f", F.struct(F.round("p", 9), -F.col("f"))).alias("dom_freq_cpb"), ratio(F.sum(F.col("f") * F.col("p")), F.sum("p")).alias("centroid_freq_cpb"),
    )
    return out.withColumns(
        {"dom_period_bars": ratio(F.lit(1.0), F.col("dom_freq_cpb")), **{f"pct_{b}": F.coalesce(ratio(F.col(f"power_{b}"), F.col("power_total")), F.lit(0.0)) for b in BANDS}},
    )


def with_series(df: DataFrame, columns: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` and those of ``columns`` that it has; where it has none, ``r_close``, derived from ``close`` if need be."""
    if found := [c for c in columns or ["r_close"] if c in df.columns]:
        return df, found
    if "close" not in df.columns:
        raise ValueError("no series and no close to derive one from")
    p = positive_log(number(F.col("close")))
    w = series("ticker")
    return df.withColumn("r_close", F.when(F.row_number().over(w) == 1, F.lit(0.0)).otherwise(p - F.lag(p).over(w))), ["r_close"]


def cover_ratio(n: Column, periods: np.ndarray = PERIODS) -> Column:
    """The share of a scalogram of ``n`` samples that ``influence`` leaves."""
    reach = [int(np.ceil(np.sqrt(2) * s)) for s in CENTRE * periods]
    left = F.aggregate(F.array(*map(F.lit, reach)), F.lit(0).cast("bigint"), lambda a, h: a + n - 2 * F.least(h.cast("bigint"), F.floor(n / 2)))
    return ratio(left.cast("double"), n * float(len(reach)))


def cwt_confidence(df: DataFrame, column: str, cadence: str, cover: float = 0.70, gap: float = 0.10, run: int = 8, least: int = 300) -> DataFrame:
    """The flag of low confidence of scalograms: a small share outside the edges' influence counts as well."""
    flag = low_confidence(df, column, cadence, gap, run, least)
    flag = flag.withColumn("cover_ratio", F.coalesce(cover_ratio(F.col("n")), F.lit(0.0)))
    return flag.withColumn("low_conf", F.greatest("low_conf", (F.col("cover_ratio") < cover).cast("int")))


def legacy_windows(df: DataFrame, columns: list[str], cadence: str) -> DataFrame:
    """The older spectral features of each series with the flag of low confidence.

    Only the spread is detrended; where the returns are flat their features are null and the confidence is low.
    """
    each = {c: partial(legacy_fft_features, detrend=c == "spread_vwap_norm") for c in columns}
    flags = low_confidence(df, "r_close", cadence).drop("n")
    out = per_window(df, columns, cadence, LEGACY_FFT_NAMES, each).join(flags, ["ticker", "win_end"])
    lost = (F.col("series") == "r_close") & F.col("degenerate")
    return out.withColumns({n: F.when(~lost, F.col(n)) for n in LEGACY_FFT_NAMES})
