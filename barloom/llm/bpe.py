"""Byte-level BPE: encoding by a segment tree over byte positions, decoding by a gather from the vocabulary.

A piece (one match of the splitting pattern) that is not a token itself starts as single bytes. Leaf i of the tree
holds the rank of the pair that starts at byte i, joined with i, so the root is the leftmost pair of lowest rank.
A merge changes three leaves: the pair it used goes, and the pairs of its live neighbours get new ranks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces whose ids a worker remembers, twice so many at most, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 200_000, 48
#: Rows that are encoded, or tokens that are decoded, at a time.
CHUNK_ROWS, CHUNK_TOKENS = 256, 1 << 20


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    width = 1 << (n - 1).bit_length()
    none = 1 << 62  # above every rank joined with a position
    find = ranks.get
    tree = [none] * (2 * width)
    for i in range(n - 1):
        if (r := find(piece[i : i + 2])) is not None:
            tree[width + i] = r * width + i
    for p in range(width - 1, 0, -1):
        x, y = tree[2 * p], tree[2 * p + 1]
        tree[p] = x if x < y else y
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    low = width - 1
    while (least := tree[1]) != none:
        i = least & low
        gone = after[i]
        end = after[i] = after[gone]
        r = None
        if end < n:
            before[end] = i
            r = find(piece[i : after[end]])
        tree[width + gone] = none
        tree[width + i] = none if r is None else r * width + i
        if (left := before[i]) >= 0:
            r = find(piece[left:end])
            tree[width + left] = none if r is None else r * width + left
        else:
            left = i
        # the three leaves stand in order, and so do their parents, which soon are one
        p, q, s = (width + left) >> 1, (width + i) >> 1, (width + gone) >> 1
        while p != s:
            x, y = tree[2 * p], tree[2 * p + 1]
            tree[p] = x if x < y else y
            if q != p and q != s:
                x, y = tree[2 * q], tree[2 * q + 1]
                tree[q] = x if x < y else y
            x, y = tree[2 * s], tree[2 * s + 1]
            tree[s] = x if x < y else y
            p, q, s = p >> 1, q >> 1, s >> 1
        while p:
            x, y = tree[2 * p], tree[2 * p + 1]
            if tree[p] == (x := x if x < y else y):
                break
            tree[p] = x
            p >>= 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class _Pieces(dict):
    """Ids by piece, as bytes of int32; when full it starts anew, and takes over what is asked for again from before."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.before = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.before.get(piece)) is None:
            ids = np.array(merge_piece(piece.encode(), self.ranks), np.int32).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


#: What a worker process has loaded, by the vocabulary's content and pattern.
_loaded: dict[tuple[int, str], tuple] = {}


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """token -> rank from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def _encoder(data: bytes, pattern: str) -> tuple:
    key = (hash(data), pattern)
    if key not in _loaded:
        import regex

        _loaded.clear()
        _loaded[key] = (regex.compile(pattern), _Pieces(parse_ranks(data)))
    return _loaded[key]


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids`` (array<int>), replacing a column of that name. Null text counts as empty: no ids.

    Each copy of a repeated row gets the same ids; an empty table gives an empty result.

    ``vocabulary`` is a rank file; its content (under 1 MB) goes to the executors as a broadcast variable.
    """
    spark = df.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c != ids]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces = _encoder(shared.value, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(k, CHUNK_ROWS)
                flat, counts = [], []
                for s in part.column(part.schema.get_field_index(text)):
                    found = split.findall(s.as_py() or "")
                    one = np.frombuffer(b"".join(map(pieces.__getitem__, found)), np.int32)
                    flat.append(one)
                    counts.append(len(one))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), column], names=[*keep, ids])

    return df.select(*dict.fromkeys([*keep, text] if text in df.columns else keep)).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded`` (binary), the bytes of its tokens joined; a column of that name is replaced.

    Null ids give null, empty ids empty bytes, each copy of a repeated row the same; an empty table gives an empty result.

    The vocabulary is one Arrow array; some rows at a time are one gather from it, whose bytes are the rows'. An id outside it raises.
    """
    spark = df.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c != decoded]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rank = {r: t for t, r in parse_ranks(shared.value).items()}
        tokens = pa.array([by_rank.get(i) for i in range(max(by_rank) + 1)], pa.binary())
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = np.diff(np.asarray(column.offsets))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            k = 0
            while k < batch.num_rows:
                stop = max(k + 1, int(np.searchsorted(bounds, bounds[k] + CHUNK_TOKENS, "right")) - 1)
                part = column.slice(k, stop - k)
                said = tokens.take(part.flatten())  # the tokens' bytes, one after another
                if said.null_count:
                    raise ValueError("a token id is not in the vocabulary")
                offsets = np.frombuffer(said.buffers()[1], np.int32, len(said) + 1) if len(said) else np.zeros(1, np.int32)
                out = said.buffers()[2] or pa.py_buffer(b"")
                ends = np.concatenate([[0], np.cumsum(sizes[k:stop])])
                valid = None if not part.null_count else pa.py_buffer(np.packbits(part.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
                made = pa.Array.from_buffers(pa.binary(), stop - k, [valid, pa.py_buffer(np.ascontiguousarray(offsets[ends])), out])
                rest = batch.slice(k, stop - k)
                yield pa.RecordBatch.from_arrays([*(rest.column(rest.schema.get_field_index(c)) for c in keep), made], names=[*keep, decoded])
                k = stop

    return df.mapInArrow(run, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    import public_tokenizers

    vocabulary = public_tokenizers.path(VOCABULARY)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokens = encode(docs, vocabulary, public_tokenizers.PATTERN).select("doc_id", "ids")
    tokens = tokens.select(
        "doc_id",
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
    )
    whole = decode(tokens, vocabulary)
    return whole.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
