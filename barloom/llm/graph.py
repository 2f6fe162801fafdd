"""Connected components of a link table by alternating stars, with joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barloom.session import cut, discard


def _least(edges: DataFrame) -> tuple[DataFrame, bool]:
    """(u, v), written: every vertex with a smaller neighbour and the least of them; and whether all links are stars.

    They are when no vertex has two smaller neighbours, or a smaller and a larger one. Counted while it is written.
    """
    none = F.lit(None).cast(edges.schema["v"].dataType)
    ends = edges.select("u", "v", F.lit(False).alias("above")).unionByName(edges.select(F.col("v").alias("u"), none.alias("v"), F.lit(True).alias("above")))
    ends = ends.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("most"), F.max("above").alias("above"))
    seen = Observation("least")
    ends = ends.observe(seen, F.count_if((F.col("v") < F.col("most")) | (F.col("v").isNotNull() & F.col("above"))).alias("n"))
    out = cut(ends.where("v is not null").select("u", "v"), "least")
    return out, not seen.get["n"]


def _round(edges: DataFrame, least: DataFrame) -> DataFrame:
    """One large and one small star over links (u, v) with u > v; ``least`` is their _least, written.

    Large: every neighbour above a vertex is linked to the least vertex at or below that one. A root has no entry in
    ``least``, so its many links meet nothing; both sides of that join are files, so where one vertex holds a large
    share of all links, Spark splits its partition. Small: every neighbour below a vertex, and the vertex itself, is
    linked to the least of them. No step adds links, so repeats go at the end only.
    """
    large = edges.join(least.toDF("c", "m"), F.col("v") == F.col("c"), "left").select("u", F.coalesce("m", "v").alias("v"))
    below = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    small = large.join(below, F.col("u") == F.col("c")).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return small.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every vertex that is not the least of its component, with the least. ``edges`` has u and v.

    Loops, repeats and both directions are allowed; null ends link nothing. ``edges`` is read twice, so it should be
    written. Each round halves path lengths at least; the rounds end when all links are stars, as a pass over their
    ends shows that the next round would need anyway. Each round is written to the shared folder, and the one before
    goes.
    """
    before = None
    now = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        least, done = _least(now)
        if not done:
            now = cut(_round(now, least), "links")
            discard(least)
        if before is not None:
            discard(before)
        if done:
            return least
        before = now
