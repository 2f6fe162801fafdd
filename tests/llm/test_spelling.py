"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from barloom.llm import spelling
from barloom.llm.entries import queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    out = {}
    for w, c in n.items():
        near = [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if distance_one(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 2 * c else None
        out[w] = [form, w, c, len(near), n[form] if form else None]
    for w in out:
        while (form := out[out[w][1]][0]) is not None:
            out[w][1] = form
    return {w: tuple(x) for w, x in out.items()}


def got(df):
    rows = [(r.word, (r.form, r.root, r.n, r.n_near, r.form_n)) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_query_is_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got(queries()["op13_spelling_variants"](spark, SF)) == plain(rows)


def documents(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id long, text string, n long, word string, form long")


def test_small_alphabet_shards_and_waves(spark, monkeypatch):
    """Dense neighbourhoods over several shards and waves, with ties, repeats, nulls and clashing columns."""
    monkeypatch.setattr(spelling, "SHARD_WORDS", 40)
    monkeypatch.setattr(spelling, "WAVE_WORDS", 100)
    r = random.Random(5)
    words = ["".join(r.choices("abé", k=r.randrange(4, 9))) for _ in range(700)]
    rows = [(k, " ".join(r.choices(words[: 40 + 10 * k], k=120)).replace("a", r.choice("aA"))) for k in range(60)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (4, None), (5, ""), (None, None), (6, "1 2 ... \n")]
    want = plain(rows)
    assert len(want) > 250 and max(x[3] for x in want.values()) > 5
    assert got(spelling.variants(documents(spark, rows))) == want


def test_chains_of_forms(spark):
    text = "abcde " * 40 + "abcdf " * 20 + "abcxf " * 10 + "abyxf " * 5 + "azcde " * 30
    want = plain([(k, text) for k in range(3)])
    assert want["abyxf"][1] == "abcde" and want["azcde"][0] is None
    assert got(spelling.variants(documents(spark, [(k, text) for k in range(3)]))) == want


@pytest.mark.parametrize("length", [254, 255, 256, 257, 5000])
def test_long_words(spark, length):
    r = random.Random(length)
    base = "".join(r.choices("abc", k=length))
    at = r.randrange(length)
    words = [base, base[:at] + "z" + base[at + 1 :], base[:at] + base[at + 1 :], base + "q", base[:at] + "zz" + base[at:], base[: at + 1] + "x" + base[at + 1 :]]
    rows = [(k, " ".join(words) + " " + base) for k in range(4)] + [(9, "a" * length)] * 3 + [(10, "a" * (length + 1))] * 6
    assert got(spelling.variants(documents(spark, rows))) == plain(rows)


def test_empty(spark):
    assert spelling.variants(documents(spark, [])).collect() == []
    assert spelling.variants(documents(spark, [(1, None), (2, "one two")])).collect() == []


def test_trie_accepts_each_neighbour_once():
    r = random.Random(1)
    words = sorted({"".join(r.choices("ab", k=r.randrange(1, 8))).encode() for _ in range(150)})
    trie = spelling.build_trie(words, list(range(1, len(words) + 1)))
    for w in [*words, b"", b"aaaaaaaaa", b"zz"]:
        found = list(spelling.neighbours(trie, w))
        assert sorted(found) == [(x, k + 1) for k, x in enumerate(words) if distance_one(x, w)]
