"""Spelling variants: words one edit apart, by tries and distance-one Levenshtein automata.

The words of all texts are counted, sorted, and cut into shards of bounded size; a shard becomes a compact trie, in
which a node carries all letters up to the next fork. A wave broadcasts a few shards; every word then walks each trie
of the wave depth-first together with its own automaton and keeps of the words that the automaton accepts only their
number and the best of them. What the waves found is reduced by word. No pair of words is ever written.

The automaton reads a word exactly until the trie leaves it; there it may take a letter of the trie for one of the
word's, besides the word's, or leave one of the word's out, and reads the rest exactly. Two words at distance one
differ first at one place only, so each neighbour is accepted once.

Words longer than LONG letters stay out of the tries, which so keep their bound. They meet by hashes of what is left
of them without one letter, and are then compared letter by letter.
"""

from __future__ import annotations

import gc
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import cut, discard

#: Runs of letters that are words; all of them are Latin-1, one byte each.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Of the runs of a document, one in so many loses a letter.
DAMAGE = 97
#: Code points and occurrences that a word needs; a form is so many times as frequent as its variant.
LETTERS, TIMES, FACTOR = 5, 3, 2
#: Words and letters of a shard, and words of a wave: the bound of what is broadcast and of the tries a worker holds.
SHARD_WORDS, SHARD_LETTERS, WAVE_WORDS = 1 << 16, 1 << 20, 1 << 18
#: Words that a task walks through the tries of a wave.
TASK_WORDS = 1 << 14
#: Longest word in a trie.
LONG = 255
#: Different words that a task counts before it sends them on.
HELD = 1 << 18


def damaged(word: str, prefix: int) -> str:
    """``word`` without one letter if its checksum, after that of what stands before it, says so."""
    h = zlib.crc32(word.encode(), prefix)
    if h % DAMAGE:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _count(letters: int):
    """(word, n) of the texts of a task, summed before they leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                prefix = zlib.crc32(f"{key.as_py() or ''}:".encode())
                # bytes lower A-Z only
                for word, n in Counter(RUN.findall((text.as_py() or "").encode().lower().decode())).items():
                    if len(word) >= letters and len(word := damaged(word, prefix)) >= letters:
                        total[word] += n
                if len(total) > HELD:
                    yield batch_of()
        if total:
            yield batch_of()

    return run


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n) of every word of ``docs`` that is long and frequent enough; null texts have none, null keys count as empty."""
    rows = docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(_count(letters), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def _pack(most: int):
    """Shards of sorted words: their letters and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        counts: list[int] = []
        letters = 0

        def shard() -> pa.RecordBatch:
            row = [[b"\n".join(words)], [np.array(counts, np.int64).tobytes()], [len(words)]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.binary(), pa.binary(), pa.int64()))], names=["letters", "counts", "size"])

        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(words) >= most or letters >= SHARD_LETTERS:
                    yield shard()
                    words, counts, letters = [], [], 0
                words.append(word.encode("latin-1"))
                counts.append(n)
                letters += len(word)
        if words:
            yield shard()

    return run


#: A node of a trie: its letters, the count of the word that ends there or 0, and the nodes below by their first letter.
Node = tuple[bytes, int, dict]


def build_trie(words: list[bytes], counts: list[int]) -> Node:
    """The compact trie of sorted distinct words."""
    # open nodes from the root down: [depth where its letters end, word's count, nodes below]
    spine: list[list] = [[0, 0, {}]]
    before = b""

    def close(depth: int) -> None:
        """Closes what hangs below ``depth``, with a fork there if none stands yet."""
        while spine[-1][0] > depth:
            end, n, below = spine.pop()
            if spine[-1][0] < depth:
                spine.append([depth, 0, {}])
            start = spine[-1][0]
            spine[-1][2][before[start]] = (before[start:end], n, below)

    for word, n in zip(words, counts):
        same = 0
        for a, b in zip(before, word):
            if a != b:
                break
            same += 1
        close(same)
        spine.append([len(word), n, {}])
        before = word
    close(0)
    return b"", spine[0][1], spine[0][2]


def _rest(node: Node, at: int, word: bytes, p: int) -> int:
    """The count of the word that ``word`` from ``p`` on leads to from letter ``at`` of a node; 0 if there is none."""
    while True:
        label, n, below = node
        if not word.startswith(label[at:] if at else label, p):
            return 0
        p += len(label) - at
        if p == len(word):
            return n
        if (node := below.get(word[p])) is None:
            return 0
        at = 0


def neighbours(root: Node, word: bytes) -> Iterator[tuple[bytes, int]]:
    """(word, count) of all words of a trie at distance one: the automaton of ``word`` walks it depth-first."""
    end = len(word)

    def leave(node: Node, at: int, p: int) -> Iterator[tuple[bytes, int]]:
        """The trie has another letter, the one before ``at``, than the word at ``p``."""
        c = node[0][at - 1]
        if n := _rest(node, at, word, p):
            yield word[:p] + bytes((c,)) + word[p:], n
        if p < end and (n := _rest(node, at, word, p + 1)):
            yield word[:p] + bytes((c,)) + word[p + 1 :], n
        if p + 1 < end and word[p + 1] == c and (n := _rest(node, at, word, p + 2)):
            yield word[:p] + word[p + 1 :], n

    node, p = root, 0
    while True:
        label, n, below = node
        if not word.startswith(label, p):
            at = 0
            while p < end and label[at] == word[p]:
                at, p = at + 1, p + 1
            yield from leave(node, at + 1, p)
            return
        p += len(label)
        if n and p == end - 1:
            yield word[:p], n
        next_letter = word[p] if p < end else -1
        for c, kid in below.items():
            if c != next_letter:
                yield from leave(kid, 1, p)
        if (node := below.get(next_letter)) is None:
            return


_TRIES: dict[str, list[Node]] = {}


def _tries(name: str, shards: list[tuple[bytes, bytes]]) -> list[Node]:
    """The tries of a wave, built once by each worker; those of another wave go."""
    if name not in _TRIES:
        _TRIES.clear()
        gc.disable()
        try:
            _TRIES[name] = [build_trie(w.split(b"\n"), np.frombuffer(n, np.int64).tolist()) for w, n in shards]
        finally:
            gc.enable()
    return _TRIES[name]


def _search(name: str, wave, factor: int):
    """Of each word: how many neighbours the wave's tries hold, and the best that is frequent enough to be its form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = _tries(name, wave.value)
        for batch in batches:
            out: list[tuple[str, int, int | None, str | None]] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                near, best, form = 0, factor * n - 1, None
                for trie in tries:
                    for found, m in neighbours(trie, word.encode("latin-1")):
                        near += 1
                        if m > best or m == best and form is not None and found < form:
                            best, form = m, found
                if near:
                    out.append((word, near, best if form else None, form.decode("latin-1") if form else None))
            if out:
                kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["word", "n_near", "form_n", "form"])

    return run


NEAR = "word string, n_near bigint, form_n bigint, form string"


def _in_tries(words: DataFrame, factor: int) -> list[DataFrame]:
    """What each wave finds, written."""
    spark = words.sparkSession
    short = words.where(F.length("word") <= LONG)
    shards = cut(short.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_pack(SHARD_WORDS), "letters binary, counts binary, size bigint"), "shards")
    # of the shards only sizes and names come here; a wave's content is bounded by WAVE_WORDS and SHARD_LETTERS
    name = F.xxhash64("letters")
    waves: list[list[int]] = []
    held, total = WAVE_WORDS, 0
    for k, size in shards.select(name, "size").toLocalIterator():
        if held + size > WAVE_WORDS or len(waves[-1]) >= WAVE_WORDS // SHARD_WORDS * 4:
            waves.append([])
            held = 0
        waves[-1].append(k)
        held += size
        total += size
    # a walk takes far longer than the row's bytes tell, so tasks are not left to the size of the table
    short = short.repartition(math.ceil(total / TASK_WORDS) or 1, "word")
    out = []
    for k, names in enumerate(waves):
        wave = spark.sparkContext.broadcast([(bytes(r.letters), bytes(r.counts)) for r in shards.where(name.isin(names)).collect()])
        out.append(cut(short.mapInArrow(_search(f"{shards.cut_path}-{k}", wave, factor), NEAR), "near"))
        wave.destroy()
    discard(shards)
    return out


_POWER = 0x9E3779B97F4A7C15
_LETTER = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)


def deletions(word: bytes) -> np.ndarray:
    """Distinct hashes of ``word`` and of all that is left of it without one letter: equal strings have equal ones."""
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(word), _POWER, np.uint64)]))
    part = np.concatenate([[np.uint64(0)], np.cumsum(_LETTER[np.frombuffer(word, np.uint8)] * power[:-1])])
    shorter = part[:-1] + (part[-1] - part[1:]) * np.uint64(pow(_POWER, -1, 1 << 64))
    return np.unique(np.append(shorter, part[-1])).astype(np.int64)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _long_pairs(words: DataFrame, factor: int) -> DataFrame:
    """The same for words over LONG letters, and what those find among the others."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(batch.column(0), batch.column(1)):
                h = deletions(word.as_py().encode("latin-1"))
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([key.as_py()] * len(h), pa.binary())], names=["h", "id"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [one_edit(a.as_py().encode("latin-1"), b.as_py().encode("latin-1")) for a, b in zip(batch.column("word"), batch.column("other"))]
            yield batch.filter(pa.array(near, pa.bool_()))

    some = cut(words.where(F.length("word") >= LONG).withColumn("id", F.unhex(F.md5("word"))), "long")
    if some.where(F.length("word") > LONG).isEmpty():
        return some.sparkSession.createDataFrame([], NEAR)
    h = some.select("id", "word").mapInArrow(spread, "h bigint, id binary")
    pairs = h.join(h.withColumnRenamed("id", "of"), "h").where("id != of").select("id", "of").distinct()
    pairs = pairs.join(some, "id").join(some.select(F.col("id").alias("of"), F.col("word").alias("other"), F.col("n").alias("m")), "of")
    pairs = pairs.where(F.greatest(F.length("word"), F.length("other")) > LONG).select("word", "n", "other", "m")
    pairs = pairs.mapInArrow(check, pairs.schema).withColumn("ok", F.col("m") >= factor * F.col("n"))
    best = F.min(F.when(F.col("ok"), F.struct((-F.col("m")).alias("m"), "other")))
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.other").alias("form"))


def roots(links: DataFrame, depth: int) -> DataFrame:
    """(word, root): where following (word, form) ends, for chains of at most ``depth`` links; the steps double."""
    now = cut(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(depth, 1)))):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        before, now = now, cut(now.join(ahead, "root", "left").select("word", F.coalesce("__next", "root").alias("root")), "roots")
        discard(before)
    return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = LETTERS, times: int = TIMES, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` of so many letters that occurs so often.

    ``n_near`` counts the words at distance one. ``form`` is the most frequent of them, of equal ones the smallest in
    code-point order, where it is ``factor`` times as frequent as the word at least; else form and form_n are null.
    ``root`` ends the chain of forms. Null and empty texts have no words; a null key counts as an empty one; repeated
    rows count each time; an empty table gives an empty result. Other columns are left out, whatever their names.
    Texts and words may be of any length.
    """
    words = cut(count_words(docs, key, text, letters, times), "words")
    waves = _in_tries(words, factor)
    found = _long_pairs(words, factor)
    for wave in waves:
        found = found.unionByName(wave)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("m"), "form")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    out = words.join(found, "word", "left").select("word", F.col("b.form").alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("b.m")).alias("form_n"))
    out = cut(out, "variants")
    for done in waves:
        discard(done)
    discard(words)
    # a form is ``factor`` times as frequent, so the most frequent word bounds a chain
    most = out.agg(F.max("n")).first()[0] or 1
    ends = roots(out.where("form is not null"), math.floor(math.log(most / times, factor)) + 1 if most > times else 1)
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
