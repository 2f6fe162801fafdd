"""The divergence audit against plain loops over all kept terms of all pairs."""

import random
import re
from collections import Counter, defaultdict

import pytest

from barloom.llm import divergence
from barloom.llm.entries import queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = set()
    for lang in docs:
        kept = [t for t, k in docs[lang].items() if k >= 3]
        groups = sorted(s for g, s in counts if g == lang)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in groups), Counter()))
        p = {s: shares(counts[lang, s]) for s in groups}
        for s in groups:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for k, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or k <= top:
                        out.add((lang, s, part, item, value, k))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n long")


def test_query_is_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "source", "text").collect()]
    assert got(queries()["op11_source_divergence"](spark, SF)) == plain(rows)


@pytest.mark.parametrize("block", [256, 3, 1])
def test_nulls_ties_repeats_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", 50)
    r = random.Random(2)
    words = [f"{a}{b}" for a in "abcdéß漢" for b in "xyzÄ"]
    rows = []
    for k in range(160):
        text = " ".join(r.choices(words, [1 / (i + 1) for i in range(len(words))], k=r.randrange(0, 30)))
        rows.append((r.choice(["en", "fr", None]), r.choice([f"s{i}" for i in range(7)] + [None, ""]), text.upper() if k % 9 == 0 else text))
    rows += [rows[0]] * 4 + [("en", "empty", None), ("en", "blank", " 12 ... "), ("zz", "only", None), ("zz", "other", "rare"), ("en", "s1", "x" * 100_000 + " ax" * 50_000)]
    assert got(divergence.audit(frame(spark, rows))) == plain(rows)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    rows = [("en", f"s{k % 5}", f"common w{k % 3} w{k % 7}") for k in range(60)]
    assert got(divergence.audit(frame(spark, rows), top=2)) == plain(rows, top=2)


def test_empty(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    assert divergence.audit(frame(spark, [("en", "a", None)])).collect() == []
