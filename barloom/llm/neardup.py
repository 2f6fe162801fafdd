"""Near-duplicates by a chosen-path set similarity join: trees that branch by minwise tokens.

A document's set has its distinct word shingles. Documents with equal sets are one record. In each of several
independent trees a record goes to the nodes named by its minwise tokens at the places that the tree selects. The
records of a small node are compared exhaustively, first by sketches, then on full sets. A large node is first
compared in blocks that share a few leaders, which joins groups of many copies cheaply; nodes whose records are then
all in one component hold no news and go. Where few records are left beside a node's largest component, so that pairs
of records from different components are no more than WORK, the node counts as small as well and these pairs are
compared. Any other large node branches: it selects BRANCHES places by its own seed, and each record goes to the
children named by its tokens there; children branch again, MAX_DEPTH levels deep. What is still large at the end,
because its tokens do not separate it, is compared whole like those with few pairs, block by block.

A pair of similarity s shares a node of a tree with the chance s, and a child with the chance 1 - (1 - s)^BRANCHES a
level. The number of trees follows from that chance over all levels and the recall wanted, and so does the agreement
of sketches that is asked for. So a pair is missed with at most twice the chance 1 - recall, as far as minwise tokens
behave like independent ones. Texts of any length are read whole; a long one has one set like all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.arrow import matrix, runs
from barloom.llm.graph import components
from barloom.session import counted_cut, cut, discard

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
#: The same for the pipeline, whose stages on word shingles link at 0.8 or more.
STAGE_PERCENT = 80
#: Wanted chance that a pair at the threshold meets, and that its sketches then agree enough to compare full sets.
RECALL = 1 - 1e-6
#: Minwise tokens of a sketch.
SKETCH = 64
#: Records and shingles of a node or block that is compared exhaustively; leaders that the blocks of a node share.
BLOCK_RECORDS, BLOCK_SHINGLES, LEADERS = 2048, 1 << 21, 4
#: Pairs of records of different components up to which a node is compared without branching.
WORK = 1 << 24
#: Places that a large node selects for its children, and how many levels branch below the first.
BRANCHES, MAX_DEPTH = 3, 3
_MULTIPLIERS = np.random.default_rng(20_231).integers(1 << 62, 1 << 63, SKETCH, np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 13
#: Words whose hashes a task remembers.
REMEMBERED = 100_000


def meeting(similarity: float) -> float:
    """The least chance that a pair meets in a tree, whatever the depth at which its nodes are small."""
    return similarity * (1 - (1 - similarity) ** BRANCHES) ** MAX_DEPTH


def trees_for(recall: float, similarity: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting(similarity)))


def agreement_for(recall: float, similarity: float) -> int:
    """The most tokens of two sketches that agree with the chance ``recall`` at least, for sets of that similarity."""
    less = 0.0
    for k in range(SKETCH):
        less += math.comb(SKETCH, k) * similarity**k * (1 - similarity) ** (SKETCH - k)
        if less > 1 - recall:
            return k
    return SKETCH


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, known: _WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; A-Z are lowered, words end at ASCII white space."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = _mix(out * _STEP + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def minwise(elements: np.ndarray) -> np.ndarray:
    """The least product of the elements with each multiplier."""
    low = np.full(SKETCH, ~np.uint64(0))
    for k in range(0, len(elements), CHUNK):
        np.minimum(low, (_MULTIPLIERS[:, None] * elements[None, k : k + CHUNK]).min(axis=1), out=low)
    return low


def sketch_of(low: np.ndarray) -> np.ndarray:
    """One byte of each minwise token: tokens that differ agree in 1 of 256, tokens that agree always do."""
    return (_mix(low) >> np.uint64(56)).astype(np.uint8)


def set_id(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


def _describe(trees: int, words: int):
    """Row-wise: size, id and sketch of the set, and the first nodes of every tree."""
    extra = [t for t in range(trees) if math.floor((t + 1) / 6) > math.floor(t / 6)]  # a second token in every sixth tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        names = np.array([_mix(np.uint64([t + 1]))[0] for t in range(trees)], np.uint64)
        picks = np.array([*range(trees), *(SKETCH - 1 - t for t in extra)])
        owner = np.array([*range(trees), *extra])
        for batch in batches:
            sizes, ids, sketches, nodes = [], [], [], []
            for t in batch.column("__text"):
                s = shingles(t.as_py(), known, words)
                sizes.append(len(s))
                if not len(s):
                    for x in (ids, sketches, nodes):
                        x.append(None)
                    continue
                low = minwise(s)
                ids.append(set_id(s))
                sketches.append(sketch_of(low).tobytes())
                nodes.append(_mix(low[picks] ^ names[owner] ^ _mix(picks.astype(np.uint64))).astype(np.int64))
            made = [pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(sketches, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *made], names=["doc_id", "row", "n_shingles", "set_id", "sketch", "nodes"])

    return run


def _rows(sketch: np.ndarray, n: np.ndarray, code: np.ndarray, agree: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): for one record after another, those of other components whose sketches and sizes allow a link.

    ``code`` numbers the components and may change between two records. Components stand together, the largest last,
    so that its records are compared with those of the others only. Only one record's candidates are held.
    """
    counts = np.bincount(code)
    order = np.lexsort((code, counts[code]))
    first, sketch, n = code[order], sketch[order], n[order]
    cuts = np.append(np.flatnonzero(np.diff(first)) + 1, len(first))
    ends = np.repeat(cuts, np.diff(cuts, prepend=0))
    for i in range(len(cuts) > 1 and int(cuts[-2])):
        k = int(ends[i])
        left = np.flatnonzero(code[order[k:]] != code[order[i]]) + k
        small, large = np.minimum(n[left], n[i]), np.maximum(n[left], n[i])
        left = left[100 * small >= percent * large]
        if len(left):
            left = left[(sketch[left] == sketch[i]).sum(axis=1) >= agree]
        if len(left):
            yield int(order[i]), order[left]


def _codes(comp: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(comp), "S16"), return_inverse=True)[1]


def _promising(agree: int, percent: int):
    """Of each block, the records with a candidate in another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pa.Table] = []
        held = 0
        for block in runs(batches, "block"):
            if block.num_rows > 1:
                hit = np.zeros(block.num_rows, bool)
                for i, others in _rows(matrix(block["sketch"], np.uint8, SKETCH), block["n"].to_numpy(), _codes(block["comp"].to_pylist()), agree, percent):
                    hit[i] = hit[others] = True
                if hit.any():
                    out.append(block.filter(pa.array(hit)))
                    held += int(hit.sum())
            if held > BLOCK_RECORDS or len(out) > 500:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, held = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return run


class _Sets:
    """The sets of a block as one array of small numbers, and a mark for the set that others are compared with."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.code = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
        self.has = np.zeros(int(self.code.max()) + 1, bool)

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``i`` with others."""
        mine = self.code[self.at[i] : self.at[i + 1]]
        self.has[mine] = True
        out = np.array([np.count_nonzero(self.has[self.code[self.at[j] : self.at[j + 1]]]) for j in others.tolist()], np.int64)
        self.has[mine] = False
        return out


def _confirm(agree: int, percent: int, words: int):
    """(u, v): of each block, every component that links on full sets join to a lesser one, and the least it is joined to.

    Records that links have joined already are not compared again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        links: list[tuple[bytes, bytes]] = []
        for block in runs(batches, "block"):
            records: dict[bytes, tuple[bytes, np.ndarray]] = {}
            for key, comp, text in zip(block["set_id"], block["comp"], block["text"]):
                if (k := key.as_py()) not in records:
                    s = shingles(text.as_py(), known, words)
                    if set_id(s) == k:  # else another text under the same doc_id
                        records[k] = (comp.as_py(), s)
            del block
            keys = sorted(records)
            if len(keys) < 2:
                continue
            comp = [records[k][0] for k in keys]
            code = _codes(comp)
            for _ in _joined(code, [records[k][1] for k in keys], agree, percent):
                pass
            least: dict[int, bytes] = {}
            for c, name in zip(code.tolist(), comp):
                least[c] = min(name, least.get(c, name))
            links += sorted({(name, least[c]) for c, name in zip(code.tolist(), comp) if name != least[c]})
            if len(links) > 50_000:
                yield _link_batch(links)
                links = []
        if links:
            yield _link_batch(links)

    return run


def _joined(code: np.ndarray, sets: list[np.ndarray], agree: int, percent: int) -> Iterator[tuple[int, int]]:
    """Of the links between records of different components, those that join two components not joined before.

    A record is compared with a few others at a time, because each link found spares the rest of what it joins.
    ``code`` has the components after the links at the end.
    """
    sketch = np.stack([sketch_of(minwise(s)) for s in sets])
    held = _Sets(sets)
    for i, others in _rows(sketch, held.size, code, agree, percent):
        step = 1
        while len(others := others[code[others] != code[i]]):
            part, others = others[:step], others[step:]
            common = held.common(i, part)
            for j in part[100 * common >= percent * (held.size[i] + held.size[part] - common)].tolist():
                if code[j] != code[i]:
                    code[code == code[j]] = code[i]
                    yield i, j
            step = min(2 * step, 256)


def _link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], names=["u", "v"])


class _Join:
    """The components found so far and the steps that find more."""

    def __init__(self, docs: DataFrame, records: DataFrame, percent: int, words: int, recall: float):
        self.docs, self.records, self.percent, self.words = docs, records, percent, words
        self.agree = agreement_for(recall, percent / 100)
        self.comp: DataFrame | None = None
        self.texts: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the component of ``set_id`` so far."""
        rows = rows.drop("comp")
        if self.comp is None:
            return rows.withColumn("comp", F.col("set_id"))
        return rows.join(self.comp.withColumnsRenamed({"u": "set_id", "v": "__root"}), "set_id", "left").withColumn("comp", F.coalesce("__root", "set_id")).drop("__root")

    def blocks(self, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The promising records of the blocks of ``nodes`` (node, set_id, n, round), and the members of split nodes."""
        rows = self.labelled(nodes)
        lead = [F.min(F.struct(F.xxhash64(F.lit(k), "node", "set_id").alias("h"), "set_id"))["set_id"].alias(f"l{k}") for k in range(LEADERS)]
        stats = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("round").alias("round"), *lead).where("size > 1 and a != b")
        parts = _parts(F.col("size"), F.col("weight"), BLOCK_RECORDS, BLOCK_SHINGLES)
        stats = cut(stats.select("node", "round", parts.alias("parts"), F.array_distinct(F.array(*(f"l{k}" for k in range(LEADERS)))).alias("leaders")), "nodes")
        members = cut(nodes.join(stats.select("node", "parts"), "node"), "members")
        shared = stats.where("parts > 1").select("node", "round", F.explode("leaders").alias("set_id"), "parts")
        shared = shared.select("node", "round", "set_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        blocks = members.select("node", "round", "set_id", _part("parts").alias("part")).unionByName(shared)
        blocks = blocks.groupBy(F.xxhash64("node", "part").alias("block"), "set_id").agg(F.min("round").alias("round"))
        return self.promising(blocks), members.where("parts > 1").select("node", "set_id", "n", "round")

    def sizes(self, rows: DataFrame) -> DataFrame:
        """Of labelled nodes that hold several components: the largest one, what all hold, and the pairs between components."""
        sizes = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"))
        stats = sizes.groupBy("node").agg(F.max(F.struct("size", "weight", "comp")).alias("m"), F.sum("size").alias("size"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("comps"))
        return stats.where("comps > 1").withColumn("work", (F.col("size") - F.col("m.size")) * F.col("size"))

    def children(self, split: DataFrame) -> DataFrame | None:
        """The next level of the nodes with more than WORK pairs: a record follows its tokens at the node's places.

        A node's first place is random, the others stand apart from it, so the places differ. None where no node
        has as many pairs.
        """
        rows = self.labelled(split)
        large = cut(self.sizes(rows).where(F.col("work") > WORK).select("node"), "large")
        if large.isEmpty():
            return None
        rows = rows.join(large, "node").join(self.records.select("set_id", "sketch"), "set_id")
        place = F.pmod(F.xxhash64(F.lit(7), "node"), F.lit(SKETCH)).cast("int")
        token = lambda k: F.substring(F.col("sketch"), (place + k * (SKETCH // BRANCHES)) % SKETCH + 1, F.lit(1))
        made = F.explode(F.array(*(F.xxhash64("node", F.lit(k), token(k)) for k in range(BRANCHES))))
        return rows.select(made.alias("node"), "set_id", "n", "round")

    def pairs(self, split: DataFrame, whole: bool) -> DataFrame | None:
        """The promising records of all pairs of blocks of ``split`` that may hold news; None where no node does.

        Unless ``whole``, only nodes of at most WORK pairs count.

        The largest component of a node needs no comparison inside itself: each of its parts meets each part of the
        other records once, and only those parts meet each other, too.
        """
        rows = self.labelled(split)
        stats = self.sizes(rows)
        if not whole:
            stats = stats.where(F.col("work") <= WORK)
        # half as much in a block, as two meet
        limits = BLOCK_RECORDS // 2, BLOCK_SHINGLES // 2
        others = _parts(F.col("size") - F.col("m.size"), F.col("weight") - F.col("m.weight"), *limits)
        stats = cut(stats.select("node", F.col("m.comp").alias("main"), _parts(F.col("m.size"), F.col("m.weight"), *limits).alias("mains"), others.alias("others")), "nodes")
        if stats.isEmpty():
            return None
        rows = rows.join(stats, "node").withColumn("in_main", F.col("comp") == F.col("main"))
        rows = rows.withColumn("part", F.when(F.col("in_main"), _part("mains")).otherwise(_part("others")))
        mains, others = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("mains", "others"))
        meet = lambda kind, a, b: F.xxhash64("node", F.lit(kind), a, b)
        part = F.col("part")
        outside = F.transform(mains, lambda p: meet(0, p, part))
        among = F.transform(F.filter(others, lambda p: p != part), lambda p: meet(1, F.least(p, part), F.greatest(p, part)))
        block = F.when(F.col("in_main"), F.transform(others, lambda p: meet(0, part, p))).otherwise(F.concat(outside, among))
        return self.promising(rows.select(F.explode(block).alias("block"), "set_id", "round"))

    def promising(self, blocks: DataFrame) -> DataFrame:
        """Of each block (block, set_id, round; n, sketch, row, too, or none), the records with a candidate in another component."""
        rows = blocks
        if "sketch" not in blocks.columns:
            rows = blocks.select("block", "set_id", "round").join(self.records.select("set_id", "n", "sketch", "row"), "set_id")
        rows = self.labelled(rows).select("block", "round", "set_id", "n", "sketch", "row", "comp")
        rows = rows.repartition("block").sortWithinPartitions("block", "set_id")
        return cut(rows.mapInArrow(_promising(self.agree, self.percent), rows.schema), "promising")

    def fetch(self, found: DataFrame, split: DataFrame) -> None:
        """Reads the texts of all records that may be compared, in one pass over the documents."""
        need = found.select("set_id", "row").unionByName(split.join(self.records, "set_id").select("set_id", "row")).distinct()
        # repeated rows bring their text once
        self.texts = cut(self.docs.hint("merge").join(need, "row").select("set_id", "text").dropDuplicates(["set_id"]), "texts")

    def confirm(self, found: DataFrame) -> None:
        """Adds the links of ``found`` (block, set_id, comp) to the components, whose names are those of now.

        Only the components that links join go through rounds, and the new names then reach their members in one join.
        """
        rows = found.select("block", "set_id", "comp").join(self.texts, "set_id").repartition("block").sortWithinPartitions("block", "set_id")
        links, n = counted_cut(rows.mapInArrow(_confirm(self.agree, self.percent, self.words), "u binary, v binary"), "found")
        if n:
            joined, before = components(links), self.comp
            self.comp = joined
            if before is not None:
                moved = before.join(joined.toDF("__was", "__now"), F.col("v") == F.col("__was"), "left")
                self.comp = cut(moved.select("u", F.coalesce("__now", "v").alias("v")).unionByName(joined), "comp")
                discard(before)
                discard(joined)
        discard(links)


def _parts(size: Column, weight: Column, records: int, shingles: int) -> Column:
    """Parts of so many records and shingles."""
    return F.greatest(F.ceil(size / records), F.ceil(weight / shingles), F.lit(1)).cast("int")


def _part(parts: str) -> Column:
    """The part of a record, by the node's own seed."""
    return F.pmod(F.xxhash64(F.lit(5), "node", "set_id"), F.col(parts).cast("bigint")).cast("int")


def _groups(docs: DataFrame, words: int, percent: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Of ``docs`` (doc_id, text, row): (doc_id, row, n_shingles, set_id) of each row, and (set_id, comp, component_id).

    ``row`` is a hash of the row: it finds the text of a set again, also where ids are null or repeat.
    """
    trees = trees_for(recall, percent / 100)
    described = docs.select("doc_id", "row", F.col("text").alias("__text")).mapInArrow(
        _describe(trees, words),
        "doc_id bigint, row bigint, n_shingles bigint, set_id binary, sketch binary, nodes array<bigint>",
    )
    described = cut(described, "sets")
    records = described.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"),
        F.min("row").alias("row"),
        F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch"),
        F.first("nodes").alias("nodes"),
    )
    records = cut(records, "records")
    join = _Join(docs, records, percent, words, recall)
    # the second tokens stand after those of all trees, in every sixth one
    tree = F.when(F.col("__place") < trees, F.col("__place")).otherwise((F.col("__place") - trees) * 6 + 5)
    nodes = records.select("set_id", "n", F.posexplode("nodes").alias("__place", "node"))
    found, split = join.blocks(nodes.select("node", "set_id", "n", F.least(tree, F.lit(1)).alias("round")))
    join.fetch(found, split)
    # the first tree joins most groups, so that the others find most of their blocks settled
    join.confirm(found.where("round = 0"))
    rest = join.promising(found.where("round > 0"))
    discard(found)
    join.confirm(rest)
    discard(rest)
    for level in range(MAX_DEPTH + 1):
        # one tree first, so that the others find most of it settled
        for k in (0, 1):
            if (found := join.pairs(split.where(F.col("round") == k), level == MAX_DEPTH)) is not None:
                join.confirm(found)
                discard(found)
        if level == MAX_DEPTH or (nodes := join.children(split)) is None:
            break
        found, split = join.blocks(nodes)
        join.confirm(found)
        discard(found)
    label = join.labelled(records.select("set_id", "rep")).select("set_id", "rep", "comp")
    least = label.groupBy("comp").agg(F.min("rep").alias("component_id"))
    return described.select("doc_id", "row", "n_shingles", "set_id"), label.join(least, "comp").select("set_id", "comp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, recall: float = RECALL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``; ``key`` is an integer column.

    The component is named by its smallest id. Texts without words, null or empty, have no shingles and are their
    own component. Rows with a null id link like others; they keep a null component unless one of their group has
    an id, and are kept only then not. Repeated rows get the same values. Other columns are left out; an empty
    table gives an empty result.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    described, label = _groups(docs.withColumn("row", F.xxhash64("doc_id", "text")), words, percent, recall)
    out = described.join(label, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = STAGE_PERCENT, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` with one row left of each group of near-duplicates.

    The row with the smallest id stays (null ids last), of rows with that id the one with the least hash of all its
    columns; of a row that repeats whole, one copy. Rows without words are in no group and all stay. An empty table
    gives an empty result; columns named ``__*`` are left out.
    """
    keep = [c for c in docs.columns if not c.startswith("__")]
    row = F.xxhash64(*(F.col(c) for c in keep))
    narrow = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), row.alias("row"))
    described, label = _groups(narrow, words, percent, recall)
    rows = described.join(label.select("set_id", "comp"), "set_id", "left").groupBy("comp", "doc_id", "row").agg(F.count(F.lit(1)).alias("times"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"), F.col("times"))
    best = rows.where("comp is not null").groupBy("comp").agg(F.min(first).alias("r")).select("r.doc_id", "r.row", "r.times")
    best = best.unionByName(rows.where("comp is null").select("doc_id", "row", F.lit(1).cast("bigint").alias("times")))
    best = cut(best.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), "times"), "kept")

    def of(chosen: DataFrame) -> DataFrame:
        same = (F.col("__hash") == F.col("__row")) & F.col(key).cast("bigint").eqNullSafe(F.col("__id"))
        return docs.select(*keep, row.alias("__hash")).join(chosen.select("__id", "__row"), same)

    out = of(best.where("times = 1")).select(*keep)
    if not (repeated := best.where("times > 1")).isEmpty():
        out = out.unionByName(of(repeated).dropDuplicates(["__hash", key]).select(*keep))
    return out
