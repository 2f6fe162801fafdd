"""The corpus pipeline: five stages from raw documents to tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of ``documents``, and any others that came with them,
whatever their names. An empty table gives an empty result in each; what becomes of null texts and repeated rows is
said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, mixing, neardup, quality, secrets
from barloom.session import cut, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The rules are learned from the labels of the documents at hand.

    Null and empty texts go; each copy of a repeated row stays or goes like the others.
    """
    ship_package(spark)
    return quality.filter_quality(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Of a row that repeats whole, one copy stays; texts without words, null ones too, are in no group and all stay.
    """
    ship_package(spark)
    return neardup.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text becomes ``[SECRET]``; n_chars follows. No document goes; null texts and repeats stay as they are."""
    found = secrets.scan(docs)
    found = found.withColumn("__clean", secrets.redacted(F.col("text"), F.col("secret_spans")))
    length = F.when(F.size("secret_spans") > 0, F.length("__clean")).otherwise(F.col("n_chars"))
    made = {"text": F.col("__clean"), "n_chars": length.cast(docs.schema["n_chars"].dataType)}
    return found.select(*(made[c].alias(c) if c in made else F.col(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 1, 2, 3 in turn over all words.

    Texts without words, null ones too, stay once; rows that repeat whole are taken alike.
    """
    return mixing.repeat_mixed(docs, ["doc_id", "text"], mixing.count_words(F.col("text")))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, token ids and their number for every row of the mix, and whether they decode to its text.

    Null texts have no tokens; each copy of a repeated row gets the same.
    """
    import public_tokenizers

    ship_package(spark)
    vocabulary = public_tokenizers.path(bpe.VOCABULARY)
    tokens = bpe.encode(docs.select("doc_id", "source", "text", F.sha2("text", 256).alias("sha256")), vocabulary, public_tokenizers.PATTERN)
    # the mix's text ends here: its digest stands for it beside the decoded bytes; written, as a task that encodes and
    # decodes needs two Python workers, and executors keep twice as many with all that they remember
    tokens = cut(tokens.select("doc_id", "source", "sha256", "ids"), "tokens")
    whole = bpe.decode(tokens, vocabulary)
    same = F.sha2("decoded", 256) == F.coalesce("sha256", F.sha2(F.lit(""), 256))
    return whole.select("doc_id", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("decodes_to_text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("secret_scans", secret_scans),
    ("mixing_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the learned rules, the set join or the tokens; tests/llm/test_queries.py holds run() against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
