"""Language identification by compression.

A language is a zstandard dictionary of raw content: excerpts of documents that carry its label. A text is folded to
lower-case letters and single spaces, cut into chunks, and every chunk is encoded with each dictionary; the language
whose frames are the smallest in sum is the text's. Chunks are short, so that what a text repeats of itself weighs less
than what it shares with the dictionary. Where two languages come close, the text is encoded once more with a finer
search. Of languages that still tie, the one whose dictionary has more of the text's words wins, then the more frequent.

An answer whose lead stays narrow is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fit's bound: languages (the most frequent), documents of each, code points of each, bytes of a dictionary.
LANGUAGES, ROWS, EXCERPT, DICTIONARY = 256, 512, 512, 1 << 17
SEED = 12
#: Bytes of a chunk.
CHUNK = 512
#: A lead below this share of the smallest size is looked at again with the finer search.
CLOSE = 0.03
#: A lead below this share, or of a byte at most, is rejected.
NARROW = 0.01
#: Of documents, one in so many is held out.
FOLDS = 5
NONE = "und"


def held_out(key: Column) -> Column:
    """Whether a document takes no part in the fit, by its id; a null id counts as an empty one."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == 0


def letters(text: Column) -> Column:
    """Lower-case letters and marks with single spaces between them; empty where there is no letter."""
    folded = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))
    return F.when(folded.rlike(r"\p{L}"), folded).otherwise("")


def fit(df: DataFrame, text: str, lang: str) -> list[tuple[str, bytes]]:
    """(language, dictionary) of the most frequent labels, in falling order, from a bounded sample of ``df``.

    The documents of the lowest seeded hashes count, a text once however many copies it has; each gives one excerpt
    that starts at a place given by its hash.
    """
    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not sizes:
        return []
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "text"), 11)
    # several times as many as are wanted, since copies count once
    most = F.element_at(F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 8 * ROWS / n)))), F.col("lang"))
    some = rows.withColumn("h", h).where(F.col("h") <= most * (1 << 53)).dropDuplicates(["lang", "h"])
    some = some.withColumn("text", letters(F.col("text"))).where("text != ''")
    some = some.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).where(F.col("k") <= ROWS)
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    found: dict[str, list[tuple[int, bytes]]] = {}
    for r in some.select("lang", "k", F.substr("text", start, F.lit(EXCERPT)).alias("text")).collect():
        found.setdefault(r.lang, []).append((r.k, r.text.encode()))
    # the excerpts of the lowest hashes last, nearest to the text
    return [(k, b" " + b" ".join(x for _, x in sorted(found[k], reverse=True))[-DICTIONARY:] + b" ") for k in sizes if k in found]


def _compressors(dictionaries: list[tuple[str, bytes]], level: int, **more) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, content in dictionaries:
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(level, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False, **more)
        made.precompute_compress(compression_params=how)
        out.append(zstandard.ZstdCompressor(dict_data=made, compression_params=how))
    return out


class Identifier:
    """The compressors of every language."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.dictionaries = dictionaries
        self.fast, self.fine = _compressors(dictionaries, 5), _compressors(dictionaries, 13, min_match=3, search_log=4)

    def sizes(self, data: bytes, compressors: list[zstandard.ZstdCompressor]) -> list[int]:
        chunks = [data[k : k + CHUNK] for k in range(0, len(data), CHUNK)]
        return [sum(len(c.compress(x)) for x in chunks) for c in compressors]

    def __call__(self, text: str) -> tuple[str, float, bool]:
        """(language, score, rejected) of folded text; the score is the odds that the lead in bytes gives."""
        if not text or not self.dictionaries:
            return NONE, 0.0, True
        data = b" " + text.encode() + b" "
        best, lead = self.leader(self.sizes(data, self.fast))
        if lead < CLOSE * best[0]:
            sizes = self.sizes(data, self.fine)
            best, lead = self.leader(sizes)
            if not lead:
                tied = [k for k, x in enumerate(sizes) if x == best[0]]
                words = [b" " + w + b" " for w in data.split()]
                has = lambda k: sum(len(w) for w in words if w in self.dictionaries[k][1])
                best = best[0], max(tied, key=lambda k: (has(k), -k))
        return self.dictionaries[best[1]][0], 1 / (1 + 2.0 ** -min(lead, 50)), lead <= max(1, NARROW * best[0])

    @staticmethod
    def leader(sizes: list[int]) -> tuple[tuple[int, int], int]:
        """The smallest size and whose it is, and its lead over the next; alone it leads by its own size."""
        order = sorted((x, k) for k, x in enumerate(sizes))
        return order[0], (order[1][0] if len(order) > 1 else 2 * order[0][0]) - order[0][0]


def identify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; columns of those names are replaced.

    Whole texts are encoded, however long. Null texts and texts without letters are ``und`` with score 0, and so is
    everything where there is nothing to learn from. Repeated rows get the same answer; an empty table gives an empty
    result. Rejected answers keep the likeliest language.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    made = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False), T.StructField("rejected", T.BooleanType(), False)]
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Identifier(sent.value)
        for batch in batches:
            found = [of(t.as_py() or "") for t in batch.column("__letters")]
            columns = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, "lang_pred", "score", "rejected"])

    rows = docs.select(*keep, letters(F.col(text).cast("string")).alias("__letters"))
    return rows.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *made]))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the labelled ones that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    out = held_out(F.col("doc_id"))
    dictionaries = fit(docs.where(~out), "text", "lang")
    # what a prediction sees: the text, and the id only to name the row
    return identify(docs.select("doc_id", out.alias("held_out"), "text"), dictionaries).drop("text")
