"""Substring dedup on sliding sentence spans.

A text is cut into sentences: after words that end one, at line feeds, and after word pairs whose hash says so (one
in CUT_RATE), so that text without full stops is cut too, and a passage alike wherever it stands. Every run of several
consecutive sentences is hashed; the first place of a hash in the corpus (by id, then position) keeps it, and every
sentence that another place's run covers is removed.

Limits: a passage is found if a run fits between its cuts, so a few words at its edges stay where it starts or ends
inside a sentence, and one of hardly over 50 words without any full stop can be missed. Words end at white space, so
text written without spaces has too few words for a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run has at least so many sentences and words.
SENTENCES, WORDS = 3, 20
#: Inside a sentence, one of so many word pairs ends a piece (a power of two).
CUT_RATE = 8
#: Hashes that a task remembers before it passes them on.
REMEMBERED = 40_000
SEED = 3
_TOKEN = re.compile(r"[^ \t\n\v\f\r]+[ \t\n\v\f\r]*")
_SPACES = " \t\n\v\f\r"
_ENDS = (".", "!", "?", "…", "。", "！", "？", '."', '!"', '?"', ".)", ".”")
_BASES = [(b, pow(b, -1, 1 << 64)) for b in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
_ROW = "h1 bigint, h2 int, doc_id bigint, tie bigint, start int, end int, later boolean"


class _Tokens(dict):
    """64 bits of a word with the space after it: its hash, the lowest bit set where a sentence ends."""

    def __missing__(self, token: str) -> int:
        if len(self) > 120_000:
            self.clear()
        word = token.rstrip(_SPACES)
        ends = word.endswith(_ENDS) or "\n" in token
        self[token] = code = xxhash.xxh3_64_intdigest(word) & ~1 | ends
        return code


def sentences(text: str, known: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of the words, the number of the first word of each sentence with the end as last, where words start)."""
    tokens = _TOKEN.findall(text)
    n = len(tokens)
    code = np.fromiter(map(known.__getitem__, tokens), np.uint64, n)
    at = np.zeros(n + 1, np.int64)
    np.cumsum(np.fromiter(map(len, tokens), np.int64, n), out=at[1:])
    at += len(text) - at[-1]  # white space before the first word
    if not n:
        return code, np.zeros(1, np.int64), at
    word = code >> np.uint64(1)
    pair = (word[:-1] * np.uint64(_BASES[0][0]) + word[1:]) * np.uint64(_BASES[1][0])
    ends = (code & np.uint64(1)).astype(bool)
    ends[:-1] |= (pair >> np.uint64(40)) % np.uint64(CUT_RATE) == 0
    ends[-1] = True
    return code, np.concatenate([[0], np.flatnonzero(ends) + 1]), at


def run_ends(bounds: np.ndarray, least: int, words: int) -> np.ndarray:
    """For each sentence, the sentence that follows the shortest run from there with enough of both; 0: none."""
    n = len(bounds) - 1
    after = np.maximum(np.searchsorted(bounds, bounds[:-1] + words, "left"), np.arange(n) + least)
    return np.where(after <= n, after, 0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hashes(code: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of polynomial hashes of the words first..last - 1, whatever stands before them."""
    out = []
    word = code >> np.uint64(1)
    for k, (base, inverse) in enumerate(_BASES):
        x = word * np.uint64(0xD6E8FEB86659FD93) ^ (word >> np.uint64(29)) if k else word
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(x * _powers(base, len(x)))])
        out.append(((sums[last] - sums[first]) * _powers(inverse, len(x) + 1)[first] + (last - first).astype(np.uint64)).view(np.int64))
    return out[0], (out[1] >> 32).astype(np.int32)


def _runs(least: int, words: int):
    """Runs by hash, combined in the task: of two places of a hash the later one is settled at once.

    A settled row gets a hash of its own, so that a hash that many documents share reaches the shuffle once for each
    time that a task's memory fills.
    """

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 2, pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["h1", "h2", "doc_id", "tie", "start", "end", "later"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Tokens()
        seen: dict[tuple[int, int], tuple] = {}
        done: list[tuple] = []
        for batch in batches:
            for d, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                code, bounds, at = sentences(text.as_py() or "", known)
                after = run_ends(bounds, least, words)
                places = np.flatnonzero(after)
                if not len(places):
                    continue
                first, last = bounds[places], bounds[after[places]]
                h1, h2 = run_hashes(code, first, last)
                order = (d is None, d or 0, t)
                for key, start, end in zip(zip(h1.tolist(), h2.tolist()), at[first].tolist(), at[last].tolist()):
                    mine = (order, start, end)
                    if (old := seen.setdefault(key, mine)) is not mine and old != mine:
                        if mine < old:
                            seen[key], mine = mine, old
                        (none, doc, tie), start, end = mine
                        done.append((tie ^ start, end, None if none else doc, tie, start, end, True))
            if len(done) + len(seen) > REMEMBERED:
                yield made(done + [(*k, None if o[0] else o[1], o[2], s, e, False) for k, (o, s, e) in seen.items()])
                done, seen = [], {}
        yield made(done + [(*k, None if o[0] else o[1], o[2], s, e, False) for k, (o, s, e) in seen.items()])

    return run


def _remove(keep: list[str], schema: T.StructType, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, chars, spans, counts = [], [], [], []
            for t, marks in zip(batch.column("__text"), batch.column("__marks")):
                t = t.as_py()
                cuts: list[list[int]] = []
                for m in sorted((m["start"], m["end"]) for m in marks.as_py() or ()):
                    if cuts and m[0] <= cuts[-1][1]:
                        cuts[-1][1] = max(cuts[-1][1], m[1])
                    else:
                        cuts.append([*m])
                left, at = [], 0
                for a, b in cuts:
                    left.append(t[at:a])
                    at = b
                texts.append("".join(left) + t[at:] if cuts else t)
                counts.append(len(cuts))
                chars.append(sum(b - a for a, b in cuts))
                spans.append(",".join(f"{a}:{b}" for a, b in cuts))
            made = {text: pa.array(texts, pa.string()), "n_removed": pa.array(counts, pa.int64()), "removed_chars": pa.array(chars, pa.int64()), "removed_spans": pa.array(spans, pa.string())}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in schema.names], names=schema.names)

    return run


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``df`` with repeated passages cut out of ``text``, and n_removed (stretches cut), removed_chars, removed_spans.

    ``key`` is an integer column; null keys come last in the order. Null text stays null; texts too short for a run
    stay as they are. Rows that agree in key and text are one document, so repeated rows keep the same text. Spans
    (start:end in code points of the old text, comma-joined) run to the start of the next sentence. Columns of the
    added names and ``__*`` are replaced; an empty table gives an empty result.

    Runs are combined in each task and dealt by their hash in one shuffle, where a rank by place finds the later
    ones; the stretches to cut then meet their texts.
    """
    added = ("n_removed", "removed_chars", "removed_spans")
    keep = [c for c in df.columns if c not in added and not c.startswith("__")]
    # tells rows of one id apart; rows without an id have nothing else
    tie = F.when(F.col(key).isNull(), F.xxhash64(F.lit(SEED), F.col(text))).otherwise(F.hash(F.lit(SEED), F.col(key), F.col(text)).cast("bigint"))
    rows = df.select(*keep, F.col(key).cast("bigint").alias("__id"), tie.alias("__tie"))
    runs = rows.select("__id", "__tie", text).mapInArrow(_runs(least, words), _ROW)
    rank = F.rank().over(W.partitionBy("h1", "h2", "later").orderBy(F.col("doc_id").asc_nulls_last(), "tie", "start"))
    later = runs.withColumn("r", rank).where("later or r > 1")
    marks = later.groupBy(F.col("doc_id").alias("__mid"), F.col("tie").alias("__mtie")).agg(F.collect_set(F.struct("start", "end")).alias("__marks"))
    joined = rows.join(marks, F.col("__id").eqNullSafe(F.col("__mid")) & (F.col("__tie") == F.col("__mtie")), "left")
    joined = joined.select(*[c for c in keep if c != text], F.col(text).cast("string").alias("__text"), "__marks")
    schema = T.StructType(
        [
            *(T.StructField(text, T.StringType()) if c == text else df.schema[c] for c in keep),
            *(T.StructField(c, T.StringType() if c == "removed_spans" else T.LongType(), False) for c in added),
        ],
    )
    return joined.mapInArrow(_remove(keep, schema, text), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its repeated passages cut out."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
