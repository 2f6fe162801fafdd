"""Mix sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Every row gets a hash-random key; within its source rows stand in key order. Because keys are uniform, equal
key ranges hold near-equal shares of a source, so a source is range-split into as many ranges as its rows need
and the prefix sums are taken in two levels: over the ranges of a source, then inside a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import cut

SEED = 77
#: Rows that a key range holds on average: the largest group that one task sorts for the inner prefix sums.
RANGE_ROWS = 2048
#: No source is repeated more often than this.
MAX_EPOCHS = 3


def count_words(text: Column) -> Column:
    """Number of runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))), F.lit(0)).cast("bigint")


def source_targets(rows: DataFrame, source: str = "source", size: str = "size", weights: tuple = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, n_rows, target): sources by code point, null last, weigh ``weights`` in turn.

    The targets share the sum of all sizes by weight. A target above ``max_epochs`` times its source stops
    there and the excess is shared again by weight, until none is above; each round is one aggregate of one row.
    """
    spark = rows.sparkSession
    by = rows.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    by = by.withColumn("__rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    by = cut(by.withColumn("weight", pick).drop("__rank"), "mix-sources")
    total = by.agg(F.sum("source_size")).first()[0] or 0
    level, room = 0.0, F.col("source_size") * float(max_epochs)
    while total:
        full = room <= F.col("weight") * level
        capped, free = by.agg(F.sum(F.when(full, room).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not free or (now := (total - capped) / free) <= level * (1 + 1e-12):
            break
        level = now
    return by.select("source", "source_size", "n_rows", F.least(room, F.col("weight") * F.lit(float(level))).alias("target"))


def mix(df: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", weights: tuple = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``taken``, the words that the mix takes from each row.

    A source with a target of e whole epochs and a rest takes every row e times, then rows in hash order until
    the rest is used up; the row at the cut gives only the words still missing, so the words taken of a source
    equal its target rounded down. Null sources form one source; null or zero sizes take nothing; rows that
    repeat a key sort by size. The order depends on key, size and seed alone, so reruns agree; sizes are part of the
    hash so that rows without a key, however many, spread over the ranges too.
    """
    keep = [c for c in df.columns if c not in ("source_size", "target", "taken") and not c.startswith("__")]
    rows = df.select(*keep)
    targets = source_targets(rows, source, size, weights, max_epochs).withColumnsRenamed({"source": "__source"})
    h = F.xxhash64(F.lit(seed), F.col(key), F.col(size).cast("bigint"))
    rows = rows.withColumn("__key", h).join(F.broadcast(targets) if targets.count() <= 10_000 else targets, F.col(source).eqNullSafe(F.col("__source")))
    # the unsigned position of the key in [0, 1), cut into as many ranges as the source needs
    place = (F.shiftrightunsigned(F.col("__key"), 11).cast("double")) / float(1 << 53)
    rows = rows.withColumn("__range", F.floor(place * F.ceil(F.col("n_rows") / RANGE_ROWS)).cast("bigint"))
    sums = rows.groupBy("__source", "__range").agg(F.sum(F.coalesce(size, F.lit(0))).alias("__s"))
    ahead = sums.withColumn("__ahead", F.sum("__s").over(W.partitionBy("__source").orderBy("__range").rowsBetween(W.unboundedPreceding, -1))).drop("__s")
    ahead = ahead.withColumnsRenamed({"__source": "__asource", "__range": "__arange"})
    rows = rows.join(ahead, F.col("__source").eqNullSafe(F.col("__asource")) & (F.col("__range") == F.col("__arange")))
    inner = W.partitionBy("__source", "__range").orderBy(F.shiftrightunsigned(F.col("__key"), 11), F.col(key), F.col(size)).rowsBetween(
        W.unboundedPreceding,
        -1,
    )
    rows = rows.withColumn("__before", F.coalesce("__ahead", F.lit(0)) + F.coalesce(F.sum(size).over(inner), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.floor(F.col("target")).cast("bigint") - epochs * F.col("source_size")
    words = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    taken = epochs * words + F.greatest(F.lit(0).cast("bigint"), F.least(words, rest - F.col("__before")))
    return rows.select(*keep, "source_size", "target", taken.cast("bigint").alias("taken"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document for weights 1, 2, 3 in turn over 100 % of all words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", count_words(F.col("text")).alias("size"))
    docs = cut(docs, "mix-sizes")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def repeat_mixed(df: DataFrame, key: list[str], size: Column, source: str = "source", weights: tuple = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Whole rows of ``df`` as often as the mix takes them: once per full epoch, once more before the cut of the source.

    The row at the cut is repeated if at least half of it is taken; rows of size 0 stay once. Only hashed keys and
    sizes are sorted: they give each source its epochs and the hash of its last repeated row, against which the whole
    rows are compared where they stand, so these never shuffle. Rows equal in all of ``key`` are taken alike, null
    keys like any other; an empty table gives an empty result. Columns named ``__*`` are left out.
    """
    keep = [c for c in df.columns if not c.startswith("__")]
    row = F.xxhash64(F.lit(seed), *key)
    narrow = cut(df.select(row.alias("row"), F.col(source).alias("source"), size.alias("size")), "mix-sizes")
    mixed = mix(narrow, "row", "source", "size", weights, max_epochs, seed).where("size > 0")
    epochs = F.floor(F.col("target") / F.col("source_size"))
    once_more = F.floor(F.col("taken") / F.col("size") + 0.5) > epochs
    order = F.struct(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "row", F.col("size").cast("bigint")), 11).alias("h"), F.col("row"))
    by = mixed.groupBy(F.col("source").alias("__source")).agg(F.min(epochs).cast("int").alias("__epochs"), F.max(F.when(once_more, order)).alias("__last"))
    by = cut(by, "mix-cuts")
    rows = df.select(*keep, row.alias("__row"), size.alias("__size"))
    rows = rows.join(F.broadcast(by) if by.count() <= 10_000 else by, F.col(source).eqNullSafe(F.col("__source")), "left")
    place = F.struct(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__row", F.col("__size").cast("bigint")), 11).alias("h"), F.col("__row").alias("row"))
    times = F.when(F.col("__size") > 0, F.col("__epochs") + F.coalesce(place <= F.col("__last"), F.lit(False)).cast("int")).otherwise(1)
    rows = rows.withColumn("__times", times).where("__times > 0")
    return rows.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*keep)
