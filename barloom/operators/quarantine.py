"""Series that a step cannot use, kept apart as rows (step, ticker, win_end, reason) that flow beside the good ones."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "step string, ticker string, win_end timestamp_ntz, reason string"


def faults(df: DataFrame, step: str, rules: dict[str, Column]) -> DataFrame:
    """The tickers that a rule (an aggregate over a ticker's rows) is true of, with the first such rule as the reason."""
    reason = F.coalesce(*(F.when(rule, F.lit(name)) for name, rule in rules.items()))
    found = df.groupBy("ticker").agg(reason.alias("reason")).where("reason is not null")
    return found.select(F.lit(step).alias("step"), "ticker", F.lit(None).cast("timestamp_ntz").alias("win_end"), "reason")


def lost(before: DataFrame, after: DataFrame, step: str, reason: str) -> DataFrame:
    """The tickers that have rows in ``before`` and none in ``after``."""
    gone = before.select("ticker").distinct().join(after.select("ticker").distinct(), "ticker", "left_anti")
    return gone.select(F.lit(step).alias("step"), "ticker", F.lit(None).cast("timestamp_ntz").alias("win_end"), F.lit(reason).alias("reason"))


def failed_windows(df: DataFrame, step: str) -> DataFrame:
    """The windows that have an ``error``, each once; of several series the first message."""
    bad = df.where("error is not null").groupBy("ticker", "win_end").agg(F.min("error").alias("reason"))
    return bad.select(F.lit(step).alias("step"), "ticker", "win_end", "reason")


def without(df: DataFrame, bad: DataFrame) -> DataFrame:
    """``df`` without the tickers of ``bad``."""
    return df.join(bad.select("ticker").distinct(), "ticker", "left_anti")


def strict(f: Callable[[np.ndarray], list[float]], least: int) -> Callable[[np.ndarray], list[float]]:
    """``f`` that fails on a window of fewer than ``least`` samples instead of giving nulls."""

    def checked(x: np.ndarray) -> list[float]:
        if (n := int(np.isfinite(x).sum())) < least:
            raise ValueError(f"{n} of {least} samples")
        return f(x)

    return checked
