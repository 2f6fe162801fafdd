"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 scatters rows uniformly into memory-sized buckets by seeded hashes; pass 2 shuffles each bucket with
Spark's own Fisher-Yates (``shuffle``) and numbers the result. The shard of a row depends on its id and on the
number of shards alone (the ``key`` law): it is the shard whose seeded hash with the id is highest, so one more
shard only ever takes rows into itself.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import cut, shared_dir

SHARDS = 24
SEED = 20_240_117
#: Bytes of a bucket in pass 2: what one task holds at a time.
BUCKET_BYTES = 16 << 20
#: Tasks of pass 2 at most.
MOST_TASKS = 100_000


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest seeded hash; ties go to the lower shard."""
    scores = [F.struct(F.xxhash64(F.lit(seed), key, F.lit(k)).alias("h"), F.lit(-k).alias("k")) for k in range(shards)]
    return (-F.array_max(F.array(*scores))["k"]).cast("int")


def assign_shards(df: DataFrame, key: str, weight: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with ``shard`` and ``slot``: the slots of a shard run from 0 without gaps, in shuffled order.

    ``weight`` names a column with the bytes that a row takes; it only sizes the buckets. Rows with a null key
    hash like any other value; repeated rows (the same key) share a shard and get slots of their own. An empty
    table gives an empty result. Columns named ``shard``, ``slot`` or ``__*`` of the input are replaced.

    A bucket is (shard, part); parts come from a second seeded hash over the whole row, so rows that share a key
    and differ elsewhere still spread over all parts. Copies of a row that would fill a quarter of a bucket are
    counted and dealt over all parts in turn. One pass over ``weight`` sizes the parts: their number grows with the
    input, and no bucket does, unless one row outgrows it. The hashes fix the order inside a bucket before it is
    shuffled, and rows and sizes alone fix the tasks, so another run, also on another cluster, gives the same slots.
    """
    row = [c for c in df.columns if c not in ("shard", "slot") and not c.startswith("__")]
    df = df.select(*row)
    total = df.agg(F.sum(F.col(weight)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    need = max((total["b"] or 0) + 64 * total["n"], 1)
    parts = max(1, math.ceil(need / bucket_bytes / shards))
    spread = F.pmod(F.xxhash64(F.lit(seed + 1), *row), F.lit(parts)) if parts > 1 else F.lit(0).cast("bigint")
    scattered = df.withColumn("__shard", shard_of(F.col(key), shards, seed)).withColumn("__part", spread)
    if parts > 1:
        scattered = _deal_copies(scattered, row, weight, parts, bucket_bytes // 4)
    # as many tasks as buckets, whatever the cluster's setting: with them the shuffle's seeds repeat
    tasks = min(shards * parts, MOST_TASKS)
    buckets = scattered.repartition(tasks, "__shard", "__part").groupBy("__shard", "__part").agg(
        F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 2), *row).alias("__h"), *row))).alias("__rows"),
    )
    shuffled = buckets.sortWithinPartitions("__shard", "__part").withColumn("__rows", F.shuffle("__rows", seed))
    counts = scattered.groupBy("__shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(W.partitionBy("__shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))).drop("__n")
    placed = shuffled.join(before, ["__shard", "__part"]).select("__shard", "__before", F.posexplode("__rows").alias("__pos", "__row"))
    return placed.select(
        *[F.col("__row")[c].alias(c) for c in row],
        F.col("__shard").alias("shard"),
        (F.coalesce("__before", F.lit(0)) + F.col("__pos")).cast("bigint").alias("slot"),
    )


def _deal_copies(scattered: DataFrame, row: list[str], weight: str, parts: int, most: int) -> DataFrame:
    """``scattered`` with the copies of rows that take more than ``most`` bytes together dealt over all parts in turn."""
    hashed = scattered.withColumn("__h", F.xxhash64(*row))
    hot = hashed.groupBy("__h").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(weight)).alias("b")).where(F.col("n") > 1)
    hot = cut(hot.where(F.coalesce("b", F.lit(0)) + 64 * F.col("n") > most).select("__h"), "copies")
    if hot.isEmpty():
        return scattered
    hot = F.broadcast(hot)
    # rows are told apart by their values here, so another row with the same hash does no harm
    counted = hashed.join(hot, "__h", "left_semi").groupBy(*row, "__shard", "__part").agg(F.count(F.lit(1)).alias("__n"))
    turns = F.sequence(F.lit(0), F.least(F.col("__n"), F.lit(parts)).cast("int") - 1)
    dealt = counted.select("*", F.explode(turns).alias("__turn")).withColumn("__n", F.floor((F.col("__n") - 1 - F.col("__turn")) / parts).cast("int") + 1)
    dealt = dealt.withColumn("__part", F.pmod(F.col("__part") + F.col("__turn"), F.lit(parts)).cast("bigint"))
    dealt = dealt.repartition("__shard", "__part").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return hashed.join(hot, "__h", "left_anti").select(*row, "__shard", "__part").unionByName(dealt.select(*row, "__shard", "__part"))


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED) -> None:
    """Write whole rows as Parquet, one folder per shard, each file in slot order."""
    placed = assign_shards(df.withColumn("size", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8), key, "size", shards, seed)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written whole into 24 shards under the ``key`` law and read back, with the shard of each under 25.

    Null text: size 8, null checksum. Null doc_id: a key like any other.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = f"{shared_dir(spark).rstrip('/')}/barloom/shards-{uuid.uuid4().hex}"
    write_shards(docs, path)
    held = spark.read.schema(docs.select("doc_id", "text").schema.add("slot", "long").add("shard", "integer")).parquet(path)
    return held.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )
