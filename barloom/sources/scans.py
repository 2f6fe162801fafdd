"""Scans that a configuration names: one typed scan of CSV files for each cadence.

A configuration has a path ``template`` with ``{cad}``, the ``cadences``, and the ``series`` and ``suffixes`` whose
products are the columns wanted. Headers are checked before anything is read; columns that nobody wants are not parsed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.tables import file_stem

TIME = "timestamp"


@dataclass(frozen=True)
class Scans:
    template: str
    cadences: tuple[str, ...]
    series: tuple[str, ...]
    suffixes: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f"{s}_{x}" for s in self.series for x in self.suffixes]

    def path(self, cadence: str) -> str:
        return self.template.replace("{cad}", cadence)


def load(spark: SparkSession, path: str) -> Scans:
    """Scans from a JSON file in any file system that Spark reads; missing or unknown keys raise."""
    found = json.loads(spark.read.text(path, wholetext=True).first().value)
    known = {f.name for f in fields(Scans)}
    if set(found) != known:
        raise ValueError(f"keys are {sorted(found)}, not {sorted(known)}")
    if "{cad}" not in found["template"] and len(found["cadences"]) > 1:
        raise ValueError("several cadences need {cad} in the template")
    return Scans(found["template"], *(tuple(found[k]) for k in ("cadences", "series", "suffixes")))


def header(spark: SparkSession, path: str) -> list[str]:
    """The columns of the files under ``path``, which must be the same in all of them."""
    first = spark.read.csv(path, header=True, pathGlobFilter="*.csv").columns
    lines = spark.read.text(path, pathGlobFilter="*.csv").where(F.col("value").startswith(first[0] + ",")).select("value").distinct()
    if (found := [r.value for r in lines.limit(2).collect()]) != [",".join(first)]:
        raise ValueError(f"headers differ under {path}: {found}")
    return first


def scan(spark: SparkSession, scans: Scans, cadence: str) -> DataFrame:
    """(ticker, cadence, ts, columns...) of one cadence; the ticker is the file's name."""
    path = scans.path(cadence)
    names = header(spark, path)
    if lost := [c for c in [TIME, *scans.columns] if c not in names]:
        raise ValueError(f"{path} has no {', '.join(lost)}")
    kinds = {TIME: T.TimestampNTZType()} | dict.fromkeys(scans.columns, T.DoubleType())
    rows = spark.read.schema(T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in names])).csv(path, header=True, pathGlobFilter="*.csv")
    return rows.select(file_stem().alias("ticker"), F.lit(cadence).alias("cadence"), F.col(TIME).alias("ts"), *scans.columns)


def scan_all(spark: SparkSession, scans: Scans) -> DataFrame:
    """The scans of all cadences, one below the other."""
    first, *others = (scan(spark, scans, c) for c in scans.cadences)
    for df in others:
        first = first.unionByName(df)
    return first
