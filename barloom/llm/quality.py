"""Quality rules: a learned decision list over text statistics, applied as ordered Spark conditionals.

Statistics of every whole text come from one Arrow pass. The list is learned by sequential covering: grow a
conjunction of thresholds that singles out low quality on two thirds of the labelled rows, prune it on the other
third, keep it if it is nearly pure, take away what it covers, repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unique_words", "n_digits")
#: Labelled rows that the list is learned from, at most: the lowest seeded hashes of their ids.
FIT_ROWS = 20_000
SEED = 11
MAX_RULES, MAX_CONDITIONS, THRESHOLDS = 12, 3, 48
#: A rule stays only if at most this share of the labelled rows it covers is good.
MAX_IMPURITY, LEAST_COVER = 0.02, 5


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; null counts as empty."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeated = np.zeros(n, bool)
    if n > 3:
        pairs = np.unique(code[:-1] * len(ids) + code[1:], return_inverse=True)[1]
        _, window, times = np.unique(pairs[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)
        twice = times[window] > 1
        for k in range(3):
            repeated[k : k + n - 2] |= twice
    return n, chars, sum(map(text.count, SYMBOLS)), dup, int(repeated.sum()), lines, len(ids), sum(map(text.count, "0123456789"))


def with_counts(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and COUNTS of ``text``; columns of those names in ``df`` give way to the counts.

    The text goes to Python once, whether it is kept or not.
    """
    keep = [c for c in dict.fromkeys(keep) if c not in COUNTS]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.LongType(), False) for c in COUNTS)])
    read = [*keep] if text in keep else [*keep, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([count_text(t.as_py()) for t in batch.column(read.index(text))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *(pa.array(made[:, k]) for k in range(len(COUNTS)))], names=[*keep, *COUNTS])

    return df.select(*read).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Name -> numerator, denominator; a zero denominator counts as one.
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "line_words": ("n_words", "n_lines"),
    "unique_ratio": ("n_unique_words", "n_words"),
    "digit_ratio": ("n_digits", "word_chars"),
}
FEATURES = ("n_words", *RATIOS)


def feature(name: str) -> Column:
    if name not in RATIOS:
        return F.col(name).cast("double")
    a, b = RATIOS[name]
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def mask(self, x: pd.DataFrame) -> np.ndarray:
        return (x[self.feature] >= self.threshold).to_numpy() if self.above else (x[self.feature] <= self.threshold).to_numpy()

    def column(self) -> Column:
        return feature(self.feature) >= self.threshold if self.above else feature(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: pd.DataFrame) -> np.ndarray:
    return reduce(np.logical_and, (c.mask(x) for c in rule), np.ones(len(x), bool))


def _grow(x: pd.DataFrame, bad: np.ndarray, barred: set[tuple[str, bool]]) -> Rule:
    """Conditions, each of the most information, until no good row is left; ``barred`` ones do not come first."""
    rule: list[Condition] = []
    live = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and bad[live].any() and (~bad[live]).any():
        p0, n0 = bad[live].sum(), live.sum()
        best, gain = None, 1e-9
        for name in FEATURES:
            values = x[name].to_numpy()
            inside = values[live]
            sides = [a for a in (True, False) if rule or (name, a) not in barred]
            for t in np.unique(np.quantile(inside, np.linspace(0, 1, THRESHOLDS))) if sides else ():
                for above in sides:
                    hit = inside >= t if above else inside <= t
                    p = (hit & bad[live]).sum()
                    if p and (g := p * (np.log2(p / hit.sum()) - np.log2(p0 / n0))) > gain:
                        best, gain = Condition(name, above, float(t)), g
        if best is None:
            break
        rule.append(best)
        live &= best.mask(x)
    return tuple(rule)


def _prune(rule: Rule, x: pd.DataFrame, bad: np.ndarray) -> Rule:
    """The shortest prefix with the best share of bad less good rows."""

    def worth(r: Rule) -> float:
        hit = covers(r, x)
        return (bad[hit].sum() - (~bad[hit]).sum()) / max(hit.sum(), 1)

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def learn(x: pd.DataFrame, bad: np.ndarray) -> list[Rule]:
    """Ordered rules, each a conjunction; a row that any covers is bad. Without rows of both kinds: none.

    A rule that is not pure enough on all rows, or finds nothing on those held out, is dropped, and the next one
    starts from another feature or side; there are a few of these, so the search ends.
    """
    rules: list[Rule] = []
    barred: set[tuple[str, bool]] = set()
    x, bad = x.reset_index(drop=True), np.asarray(bad, bool)
    while len(rules) < MAX_RULES and bad.any() and not bad.all():
        held = np.arange(len(x)) % 3 == 2
        if not (rule := _grow(x[~held], bad[~held], barred)):
            break
        rule = _prune(rule, x[held], bad[held])
        hit = covers(rule, x)
        pure = all((~bad[h]).sum() <= MAX_IMPURITY * h.sum() for h in (hit, hit & held))
        if bad[hit].sum() < LEAST_COVER or not bad[hit & held].any() or not pure:
            barred.add((rule[0].feature, rule[0].above))
            continue
        rules.append(rule)
        barred = set()
        x, bad = x[~hit].reset_index(drop=True), bad[~hit]
    return rules


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> list[Rule]:
    """Rules from the labelled documents that pass the base rule.

    The ids of the ``rows`` lowest seeded hashes are the sample (a hash threshold, then a sort of at most about
    that many); it is the one thing that comes to the driver, and the bound on the broadcast that picks its texts.
    An id counts once, however often it repeats: with its lowest label, and with the least of its texts' statistics.
    Null labels and null ids are left out.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).select(
        F.col(key).alias("__id"),
        F.col("quality").cast("int").alias("__quality"),
    )
    known = known.groupBy("__id").agg(F.min("__quality").alias("__quality"))
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "__id"), 11)
    n = known.count()
    share = 1.0 if n <= rows else 1.02 * rows / n
    picked = sorted(tuple(r) for r in known.where(h <= int(share * (1 << 53))).select(h.alias("h"), "__id", "__quality").collect())[:rows]
    if not picked:
        return []
    # from Arrow, as rows would go through Python workers of their own kind, which executors then keep
    sample = spark.createDataFrame(pa.table({"__id": [i for _, i, _ in picked], "__quality": [q for _, _, q in picked]}), known.schema)
    found = with_counts(docs.join(F.broadcast(sample), F.col(key) == F.col("__id")), ["__id", "__quality"], text).where(~base_failed())
    one = found.groupBy("__id", "__quality").agg(F.min(F.struct(*(feature(f).alias(f) for f in FEATURES))).alias("f"))
    table = one.select("__id", "__quality", "f.*").toPandas().sort_values("__id", ignore_index=True)
    order = np.random.default_rng(SEED).permutation(len(table))
    table = table.iloc[order]
    return learn(table[list(FEATURES)], (table["__quality"] == 0).to_numpy())


def verdict(rules: list[Rule]) -> Column:
    """True where a row passes the base rule and no learned rule, as one ordered conditional."""
    out = F.when(base_failed(), F.lit(False))
    for rule in rules:
        out = out.when(reduce(Column.__and__, (c.column() for c in rule)), F.lit(False))
    return out.otherwise(F.lit(True))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document.

    Null or empty text has no words and fails the base rule; repeated rows each get their verdict; an empty table
    gives an empty result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_counts(docs, ["doc_id"]).select("doc_id", *COUNTS[:5], base_failed().alias("base_failed"), verdict(rules).alias("kept"))


def filter_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Null and empty texts have no words and go; each copy of a repeated row gets its own, equal verdict; columns that
    are named like a count stay as they are; an empty table gives an empty result, and without labels only the base
    rule holds.
    """
    rules = fit(docs, labels)
    named = {c: f"__in_{k}" for k, c in enumerate(docs.columns)}
    rows = with_counts(docs.withColumnsRenamed(named), list(named.values()), named["text"])
    return rows.where(verdict(rules)).select(*(F.col(v).alias(k) for k, v in named.items()))
