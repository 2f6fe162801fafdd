"""How far the sources of a language differ in their words, by an inverted index with corrected baselines.

Terms are counted by language and source; a language keeps those of enough documents. With p and q the smoothed shares
of a term in two groups, scaled to SCALE, their divergence is the sum of f = (p - q)^2 / q over all kept terms, rounded
down term by term. Most terms are missing in most groups, so a pair of groups starts at V times the f of two zero
counts. Then terms correct it where it is not so:

* a term that one group has is first set against a zero in the other; only the distinct counts of a group and how many
  terms have each matter for that;
* a posting list (the groups that have a term, with their shares) adds what is left where both have the term. Tasks
  add up the pairs of their lists before they send them on. Long lists are dealt out in blocks of groups, a task sees
  two blocks at most.

The strongest terms of a group are those of the greatest f against the whole language, ranked by a window.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import cut, discard

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
#: Documents of its language that a term needs; what shares are scaled to; terms reported of a group.
DOCUMENTS, SCALE, TOP = 3, 1_000_000_000, 200
#: Different terms of groups that a task counts before it sends them on.
HELD = 1 << 19
#: Pairs of postings that are measured at a time.
PAIRS = 1 << 18
#: Groups of a block: what a task holds for two of them is (2 * BLOCK)^2 sums.
BLOCK = 256
#: Most groups that are broadcast; with more of them the joins shuffle.
BROADCAST_GROUPS = 10_000


def _count(most: int):
    """(lang, source, term, n, docs) of a task, summed before they leave it, and a row without a term for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "docs"]
        kinds = pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in found.items():
                terms = [None, *n]
                columns = [lang] * len(terms), [source] * len(terms), terms, [0, *n.values()], [0, *(docs[t] for t in n)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=names)
            found.clear()

        held = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                # bytes lower A-Z only
                terms = TERM.findall(text.encode().lower().decode())
                held -= len(n)
                n.update(terms)
                docs.update(set(terms))
                held += len(n)
                if held > most:
                    yield from out()
                    held = 0
        yield from out()

    return run


def _share(n: Column, total: Column, kept: Column) -> Column:
    wide = (n + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + _div(wide, total + kept)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def f(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def postings(docs: DataFrame, lang: str, source: str, text: str, documents: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, total) of kept terms, total over the language; and all groups (lang, source)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    counted = rows.mapInArrow(_count(HELD), "lang string, source string, term string, n bigint, docs bigint")
    counted = cut(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    of_term = W.partitionBy("lang", "term")
    kept = counted.where("term is not null").withColumns({"total": F.sum("n").over(of_term), "in_lang": F.sum("docs").over(of_term)})
    kept = cut(kept.where(F.col("in_lang") >= documents).select("lang", "source", "term", "n", "total"), "postings")
    groups = cut(counted.where("term is null").select("lang", "source"), "groups")
    discard(counted)
    return kept, groups


def measured(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, at, n_group, n_lang, v, zero, blocks) of each group: its number, its and its language's terms, the share of a term it lacks."""
    in_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n_lang"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    out = groups.join(in_lang, "lang", "left").join(own, ["lang", "source"], "left")
    out = out.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_group", "n_lang", "v")))
    of_lang = W.partitionBy("lang")
    at = (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int")
    blocks = F.ceil(F.count(F.lit(1)).over(of_lang) / BLOCK).cast("int")
    zero = F.when(F.col("v") > 0, _share(F.lit(0).cast("bigint"), F.col("n_group"), F.col("v")))
    return out.withColumns({"at": at, "blocks": blocks, "zero": zero})


def _joint(block: int):
    """Of posting lists sorted by language and blocks: (lang, a, b, value), what pairs in one list add."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple[str, int, int] | None = None
        total = np.zeros((0, 0), np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            lang, lo, hi = key
            number = np.concatenate([np.arange(block) + lo * block, np.arange(block) + hi * block])
            if lo == hi:
                number = number[:block]
                total[np.arange(block), np.arange(block)] = 0
            else:  # pairs inside a block have lists of their own
                total[:block, :block] = total[block:, block:] = 0
            a, b = np.nonzero(total)
            columns = [pa.array([lang] * len(a), pa.string()), pa.array(number[a].astype(np.int32)), pa.array(number[b].astype(np.int32)), pa.array(total[a, b])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "value"])

        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "lo", "hi"))))
            members = batch.column("members")
            length = members.value_lengths().to_numpy()
            begin = np.concatenate([[0], np.cumsum(length)])
            of = members.flatten()
            every = [of.field(c).to_numpy(zero_copy_only=False) for c in ("at", "p", "zero")]
            i = 0
            while i < len(rows):
                if rows[i] != key:
                    yield from out()
                    key, total = rows[i], np.zeros((block, block) if rows[i][1] == rows[i][2] else (2 * block, 2 * block), np.int64)
                j, pairs = i, 0
                while j < len(rows) and rows[j] == key and (j == i or pairs + length[j] ** 2 <= PAIRS):
                    pairs += length[j] ** 2
                    j += 1
                at, p, z = (x[begin[i] : begin[j]] for x in every)
                at = np.where(at // block == key[1], at - key[1] * block, at - key[2] * block + block)
                k = np.repeat(length[i:j], length[i:j])
                a = np.repeat(np.arange(len(at)), k)
                b = np.arange(pairs) + np.repeat(np.repeat(begin[i:j] - begin[i], length[i:j]) - (np.cumsum(k) - k), k)
                pl, pr, zl, zr = p[a], p[b], z[a], z[b]
                g = (pl - pr) ** 2 // pr - (pl - zr) ** 2 // zr - (zl - pr) ** 2 // pr + (zl - zr) ** 2 // zr
                np.add.at(total, (at[a], at[b]), g)
                i = j
        yield from out()

    return run


def divergences(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of all pairs of groups of a language; ``rows`` (lang, term, at, blocks, p, zero) are the postings."""
    other = groups.select("lang", F.col("at").alias("b"), F.col("zero").alias("z"))
    both = groups.select("lang", F.col("at").alias("a"), "zero", "v").join(other, "lang").where("a != b")
    start = both.select("lang", "a", "b", F.when(F.col("v") > 0, F.col("v") * f(F.col("zero"), F.col("z"))).otherwise(F.lit(0)).alias("value"))
    alike = rows.groupBy("lang", F.col("at").alias("a"), "p", "zero").agg(F.count(F.lit(1)).alias("m")).join(other, "lang").where("a != b")
    p, zero, z = F.col("p"), F.col("zero"), F.col("z")
    ahead = F.struct("lang", "a", "b", (F.col("m") * (f(p, z) - f(zero, z))).alias("value"))
    back = F.struct("lang", F.col("b").alias("a"), F.col("a").alias("b"), (F.col("m") * (f(z, p) - f(z, zero))).alias("value"))
    single = alike.select(F.inline(F.array(ahead, back))).where("value != 0")
    own, partner = F.floor(F.col("at") / BLOCK).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.select("lang", "term", "at", "p", "zero", own.alias("own"), partner.alias("partner"))
    lists = dealt.groupBy("lang", F.least("own", "partner").alias("lo"), F.greatest("own", "partner").alias("hi"), "term")
    lists = lists.agg(F.collect_list(F.struct("at", "p", "zero")).alias("members")).where(F.size("members") > 1)
    joint = lists.drop("term").sortWithinPartitions("lang", "lo", "hi").mapInArrow(_joint(BLOCK), "lang string, a int, b int, value bigint")
    return start.unionByName(single).unionByName(joint).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other, and its most telling terms.

    Part ``pair`` has a row for every other source of the language, whatever the value, part ``term`` the ``top`` terms
    that are more frequent in the source than in the language. Ranks count from 1 in each group and part, by falling
    value, then by the item's bytes. Null texts, languages and sources are empty strings; a group whose texts have no
    kept terms has all counts zero, and a language without any has values of zero. Repeated rows count each time; texts
    may be of any length; an empty table gives an empty result. Other columns are left out, whatever their names.
    """
    kept, groups = postings(docs, lang, source, text, documents)
    groups = cut(measured(kept, groups), "measured")
    near = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda df: df
    rows = kept.join(near(groups), ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("n_group"), F.col("v")))
    of_group = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    q = _share(F.col("total"), F.col("n_lang"), F.col("v"))
    terms = rows.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), f(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(of_group)).where(F.col("rank") <= top)
    pairs = divergences(rows.select("lang", "term", "at", "blocks", "p", "zero"), groups)
    name = groups.select("lang", "source", "at")
    pairs = pairs.join(near(name.withColumnRenamed("at", "a")), ["lang", "a"])
    pairs = pairs.join(near(name.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(of_group))
    return pairs.unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))
