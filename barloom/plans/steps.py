"""Steps in sequence: named builders over one state of DataFrames, with checks between them.

Every table is written once in the shared folder and counted while it is written. Tickers and windows that a step
cannot use go to the table ``quarantine``; a ticker that is in it takes no part in later steps.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import calendar, features, indicators, merge, quarantine, spectral
from barloom.operators.calendar import CADENCES
from barloom.session import counted_cut, cut
from barloom.sources.tables import build_bars

ORDER = ("load", "merge", "agg", "fft", "cwt")


@dataclass(frozen=True)
class Config:
    sampling: str = "hour"
    cadences: tuple[str, ...] = ("week",)
    reducer: str = "median"
    half_bar: str = "drop"
    fft_series: tuple[str, ...] = ("r_close", "bb_bw_20")
    cwt_series: tuple[str, ...] = ("r_close",)
    extra: tuple[str, ...] = ("atr_14", "bb_bw_20")
    fill: int = 1
    fill_extra: int = 2
    nperseg: int = 256
    noverlap: int = 128
    checks: bool = True
    #: Samples below which a spectral window fails.
    least_samples: int = 0
    #: A price of zero sets its ticker aside, as one below zero always does; else its return is missing.
    no_zeros: bool = False
    #: No price sets a ticker aside: returns are missing where prices are not positive or not there.
    any_price: bool = False

    def __post_init__(self):
        if self.sampling not in ("minute", "hour", "day"):
            raise ValueError(f"sampling {self.sampling!r}")
        if bad := [c for c in self.cadences if c not in CADENCES]:
            raise ValueError(f"cadences {bad}")
        if self.fill_extra < self.fill:
            raise ValueError("the extra fill is below the fill")
        if not self.fft_series or not self.cwt_series:
            raise ValueError("a series list is empty")
        if self.no_zeros and self.any_price:
            raise ValueError("no_zeros beside any_price")
        if self.reducer not in ("median", "mean", "weighted_mean"):
            raise ValueError(f"reducer {self.reducer!r}")


def load_config(path: str) -> Config:
    """A Config from a JSON file, or from YAML where a parser for it is installed; unknown keys raise."""
    text = Path(path).read_text(encoding="utf-8-sig")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("YAML needs a parser that is not installed; use JSON") from e
        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    if unknown := set(found) - {f.name for f in fields(Config)}:
        raise ValueError(f"unknown keys: {sorted(unknown)}")
    return Config(**{k: tuple(v) if isinstance(v, list) else v for k, v in found.items()})


def cadence_path(template: str, cadence: str) -> str:
    return template.replace("{cad}", cadence)


@dataclass
class State:
    ticks: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)
    #: Rows of every table.
    rows: dict[str, int] = field(default_factory=dict)
    bad: DataFrame | None = None

    def put(self, name: str, df: DataFrame) -> None:
        self.tables[name], self.rows[name] = counted_cut(df, name)

    def reject(self, bad: DataFrame) -> None:
        """Rows of barloom.operators.quarantine; what is in ``tables`` already stays as it is."""
        bad, n = counted_cut(bad, "quarantine")
        self.rows["quarantine"] = self.rows.get("quarantine", 0) + n
        self.bad = bad if self.bad is None else self.bad.unionByName(bad)

    def good(self, name: str) -> DataFrame:
        return self.tables[name] if self.bad is None else quarantine.without(self.tables[name], self.bad)


def _load(s: State, c: Config) -> None:
    bars = cut(build_bars(s.ticks, c.sampling), "bars")
    if not c.any_price:
        low = F.min("low")
        s.reject(quarantine.faults(bars, "load", {"no price": F.count("close") == 0, "price not positive": low <= 0 if c.no_zeros else low < 0}))
        bars = quarantine.without(bars, s.bad)
    s.put("bars", indicators.grid_indicators(bars))


def _merge(s: State, c: Config) -> None:
    bars = s.good("bars")
    made = merge.merged_days(bars, list(c.extra)) if c.sampling == "day" else merge.merged(bars, list(c.extra), c.sampling, c.half_bar, c.fill, c.fill_extra)
    s.put("merged", made)
    s.reject(quarantine.lost(bars, s.tables["merged"], "merge", "no bars in the session"))


def _agg(s: State, c: Config) -> None:
    merged = s.good("merged")
    s.put("agg_day", features.daily(merged))
    for cadence in c.cadences:
        if cadence == "hour":
            s.put("agg_hour", features.daily(merged.withColumn("win_end", calendar.window_end(F.col("ts"), "hour")), ["ticker", "win_end"]))
        elif cadence != "day":
            s.put(f"agg_{cadence}", features.reduce_windows(s.tables["agg_day"], cadence, c.reducer, c.sampling))


def _windows(s: State, step: str, columns: tuple[str, ...], c: Config, made) -> None:
    """Spectral tables of every cadence; windows that fail go to the quarantine, and their tickers after this step."""
    df, found = spectral.with_series(s.good("merged"), list(columns))
    bad = []
    for cadence in c.cadences:
        whole = cut(made(df, found, cadence), step)
        s.put(f"{step}_{cadence}", whole.where("error is null"))
        bad.append(quarantine.failed_windows(whole, step))
    for x in bad:
        s.reject(x)


def _fft(s: State, c: Config) -> None:
    _windows(s, "fft", c.fft_series, c, lambda df, found, cadence: spectral.fft_windows(df, found, cadence, c.sampling, c.nperseg, c.noverlap, least=c.least_samples))


def _cwt(s: State, c: Config) -> None:
    _windows(s, "cwt", c.cwt_series, c, lambda df, found, cadence: spectral.cwt_windows(df, found, cadence, c.sampling, least=c.least_samples))


STEPS: dict[str, Callable[[State, Config], None]] = {"load": _load, "merge": _merge, "agg": _agg, "fft": _fft, "cwt": _cwt}


def run_state(ticks: DataFrame, steps: tuple[str, ...] = ORDER, config: Config | None = None) -> State:
    """The state after the steps, in the order given; with ``checks`` a step that leaves an empty table raises."""
    config = config or Config()
    if unknown := [x for x in steps if x not in STEPS]:
        raise ValueError(f"unknown steps: {unknown}")
    state = State(ticks)
    for name in steps:
        before = set(state.tables)
        STEPS[name](state, config)
        for made in sorted(set(state.tables) - before) if config.checks else ():
            if not state.rows[made]:
                raise ValueError(f"step {name} left {made} empty")
    return state


def run_steps(ticks: DataFrame, steps: tuple[str, ...] = ORDER, config: Config | None = None) -> dict[str, DataFrame]:
    """The tables of the steps, and ``quarantine`` where a step has looked for faults."""
    state = run_state(ticks, steps, config)
    return state.tables | ({} if state.bad is None else {"quarantine": state.bad})
