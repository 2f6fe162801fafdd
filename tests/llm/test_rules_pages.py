import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import bpe, quality, secrets

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def test_counts_against_a_plain_count():
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "b", " ", "\n", "é", "#", "\x0b", " ", "a b c ", "7"]) for _ in range(rnd.randint(0, 60)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(windows)
        hit = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        got = quality.count_text(text)
        assert got[:5] == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))
    assert quality.count_text(None) == (0,) * len(quality.COUNTS)


def test_rules_find_a_planted_conjunction_and_leave_the_rest():
    rng = np.random.default_rng(1)
    x = pd.DataFrame({f: rng.uniform(size=3000) for f in quality.FEATURES})
    bad = ((x["symbol_ratio"] > 0.8) & (x["word_length"] < 0.5)).to_numpy()
    rules = quality.learn(x, bad)
    found = np.any([quality.covers(r, x) for r in rules], axis=0)
    assert (found & bad).sum() > 0.95 * bad.sum() and (found & ~bad).sum() <= 0.02 * found.sum()
    assert quality.learn(x, np.zeros(3000, bool)) == []


def test_rules_go_on_after_one_that_is_not_pure():
    rng = np.random.default_rng(2)
    x = pd.DataFrame({f: rng.uniform(size=6000) for f in quality.FEATURES})
    mixed, clear = (x["word_length"] > 0.7).to_numpy(), (x["digit_ratio"] > 0.9).to_numpy() & (x["word_length"] <= 0.7).to_numpy()
    bad = (mixed & (rng.uniform(size=6000) < 0.5)) | clear
    first = quality._grow(x, bad, set())
    assert first[0].feature == "word_length" and (~bad[quality.covers(first, x)]).mean() > quality.MAX_IMPURITY
    found = np.any([quality.covers(r, x) for r in quality.learn(x, bad)], axis=0)
    assert (found & clear).sum() > 0.9 * clear.sum() and (found & ~bad).sum() <= 0.02 * found.sum()


def test_quality_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("lang", "n_words")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = corpus_pipeline.quality_rules(spark, docs, SF)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.select("doc_id").collect()}
    want = {r.doc_id for r in quality.op7_quality_rules(spark, SF).where("kept").select("doc_id").collect()}
    assert kept == want
    assert quality.fit(docs, labels.limit(0)) == [] and quality.filter_quality(spark, docs.limit(0), labels).count() == 0


def test_secret_spans_against_re(spark):
    rnd = random.Random(8)
    bits = ["token", "token: ", "PassWord=", "secret", "api_key", "'", '"', " ", ":", "=", "abc", "abcdef12", "AKIA", "AKIA" + "Q7" * 9, "deadbeef" * 3, "0123456789abcdef", "é😀", "\u0001", "\n", "x-y"]
    texts = [None, "", *("".join(rnd.choices(bits, k=rnd.randint(1, 14))) for _ in range(400)), "token=abcdefg " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in secrets.scan(df).collect():
        text = texts[r.doc_id] or ""
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [tuple(s) for s in r.secret_spans if s.kind < 3] == sorted(want)
    assert secrets.scan(df.limit(0)).count() == 0


def test_random_keys_are_found_and_words_are_not(spark):
    rnd = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rnd.choices(letters, k=48)) for _ in range(40)]
    plain = ["path/to/the/internationalization/settings", "some_rather_long_identifier_name_here", "https://example.org/a/b", "donaudampfschifffahrtsgesellschaft", "1234567890123456789012"]
    rows = [(i, f"see {k} there") for i, k in enumerate(keys)] + [(100 + i, f"see {w} there") for i, w in enumerate(plain)]
    out = {r.doc_id: [tuple(s) for s in r.secret_spans] for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(out[i] == [(4, 3, 52)] for i in range(40)) >= 36
    assert all(out[100 + i] == [] for i in range(len(plain)))


def test_redaction(spark):
    rows = [(1, 'a token = "ce0cc631f6559e745b37cb8be6fc63ae2d235c5f" b', 9), (2, None, 0), (3, "clean", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.secret_scans(spark, df, SF).collect()}
    assert out == {1: ('a [SECRET]" b', 13), 2: (None, 0), 3: ("clean", 5)}


def test_pipeline_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.cut(stage(spark, at, SF), name)
        assert at.columns == docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == at.count()


def test_the_last_stage_decodes_its_tokens(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "s", "one \u00e9\u4e2d \n two"), (2, None, ""), (3, "s", None)], "doc_id bigint, source string, text string")
    assert {r.doc_id: r.decodes_to_text for r in corpus_pipeline.byte_bpe(spark, docs, SF).collect()} == {1: True, 2: True, 3: True}
    encode = bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda *a: encode(*a).withColumn("ids", F.slice("ids", 1, 1)))
    assert {r.doc_id: r.decodes_to_text for r in corpus_pipeline.byte_bpe(spark, docs, SF).collect()} == {1: False, 2: True, 3: True}


def test_samples_count_copies_once(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60 + i))) for i in range(90)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id bigint, quality int")
    hot = docs.where("doc_id = 7").crossJoin(spark.range(300).select()), labels.where("doc_id = 7").crossJoin(spark.range(300).select())
    assert quality.fit(docs.unionByName(hot[0]), labels.unionByName(hot[1])) == quality.fit(docs, labels)
