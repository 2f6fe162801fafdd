import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from barloom.llm import bpe, chat

SF = "/root/testdata/sf0.001"
CONV = "conv_id bigint, turn bigint, role string, text string"


def digests(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest(), sum(len(t) for r, t in ts if r == "assistant"), hashlib.sha256("".join(t for r, t in ts if r == "assistant").encode()).hexdigest())
        for c, ts in out.items()
    }


def read_back(df):
    out = chat.format_chat(df).mapInArrow(chat._read_back, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return {r.conv_id: tuple(r)[1:5] for r in out.collect()}


def test_chat_round_trip_with_control_strings_nulls_and_ties(spark):
    rnd = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>", "<", "|", "\\", "<\\|", "\n", "é😀", "assistant", " ", "<\\\\|", "|>"]
    rows = [(rnd.choice([None, -5, *range(9)]), rnd.choice([None, 0, 1, 2, 3]), rnd.choice(["user", "assistant", None, "a\\b\nc<|im_end|>", "system"]), rnd.choice([None, "", *("".join(rnd.choices(bits, k=rnd.randint(1, 12))) for _ in range(9))])) for _ in range(400)]
    assert read_back(spark.createDataFrame(rows, CONV).repartition(5)) == digests(rows)


def test_chat_empty_table_and_long_conversation_over_small_batches(spark):
    assert read_back(spark.createDataFrame([], CONV)) == {}
    rows = [(c, t, "assistant" if t % 2 else "user", f"t{t}" * 50) for c, n in ((1, 5000), (2, 1), (3, 40)) for t in range(n)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert read_back(spark.createDataFrame(rows, CONV)) == digests(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_op3_on_the_table(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r)[1:5] for r in chat.op3_chat_formatting(spark, SF).collect()}
    assert found == digests([*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)])


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.parse_ranks(open(public_tokenizers.path(bpe.VOCABULARY), "rb").read())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_merge_as_the_library_merges(reference):
    ranks, own = reference
    rnd = random.Random(5)
    for n in [1, 2, 3, 7, 8, 9, 31, 64, 65, 1000]:
        for alphabet in ("a", "ab", "étionaux", "0123456789", "\n "):
            piece = "".join(rnd.choices(alphabet, k=n))
            assert bpe.merge_piece(piece.encode(), ranks) == own._encode_single_piece(piece), piece


def test_encode_and_decode_whole_texts(spark, reference):
    _, own = reference
    odd = [None, "", " ", "a" * 30_000, "<|endoftext|> x", "日本語😀\u0000\r\n\t  b", "  lead  trail  ", "it's we'll I'D"]
    texts = [*odd, *(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), "same", "same"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    path = public_tokenizers.path(bpe.VOCABULARY)
    out = bpe.decode(bpe.encode(df.repartition(3), path, public_tokenizers.PATTERN), path).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.ids == own.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded).decode() == (texts[r.doc_id] or "")
    assert bpe.encode(df.limit(0), path, public_tokenizers.PATTERN).count() == 0


def test_op4_digests(spark, reference):
    _, own = reference
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in bpe.op4_byte_bpe(spark, SF).collect():
        ids = own.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
