"""The queries without SQL, whole, against plain versions that share no code with them."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import quality, secrets, spans

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def table(spark, path, rows, schema, name="documents"):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# ---- op1


def plain_sentences(text):
    """(start of each sentence and the end, in words), (start of each word and the end, in code points)."""
    found = list(WORD.finditer(text))
    mask = (1 << 64) - 1
    code = [xxhash.xxh3_64_intdigest(m[0]) >> 1 for m in found]
    bounds = [0]
    for i, m in enumerate(found):
        after = text[m.end() : found[i + 1].start()] if i + 1 < len(found) else ""
        pair = i + 1 < len(found) and (((code[i] * 0x9E3779B97F4A7C15 + code[i + 1]) * 0xC2B2AE3D27D4EB4F & mask) >> 40) % 8 == 0
        if m[0].endswith((".", "!", "?", "…", "。", "！", "？", '."', '!"', '?"', ".)", ".”")) or "\n" in after or pair or i + 1 == len(found):
            bounds.append(i + 1)
    return bounds, [m.start() for m in found] + [len(text)], [m[0] for m in found]


def plain_repeats(rows):
    """Text of each (id, text) left, with the stretches cut."""
    order = sorted({(d is None, d or 0, t) for d, t in rows if t}, key=lambda x: (x[0], x[1]))
    seen, out = set(), {}
    for none, d, text in order:
        bounds, at, words = plain_sentences(text)
        gone = np.zeros(len(text), bool)
        for s in range(len(bounds) - 1):
            e = next((e for e in range(s + 3, len(bounds)) if bounds[e] - bounds[s] >= 20), None)
            if e:
                run = tuple(words[bounds[s] : bounds[e]])
                if run in seen:
                    gone[at[bounds[s]] : at[bounds[e]]] = True
                seen.add(run)
        out[None if none else d, text] = "".join(c for c, g in zip(text, gone) if not g)
    return out


def test_op1_against_plain_repeats(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_repeats(rows)
    got = {r.doc_id: r for r in spans.op1_substring_dedup(spark, SF).collect()}
    assert len(got) == len(rows)
    assert {d: got[d].text for d, _ in rows} == {d: want.get((d, t), t) for d, t in rows}
    assert sum(r.n_removed > 0 for r in got.values()) > 20
    for d, t in rows:
        cuts = [tuple(map(int, x.split(":"))) for x in got[d].removed_spans.split(",") if x]
        assert len(cuts) == got[d].n_removed and sum(b - a for a, b in cuts) == got[d].removed_chars == len(t) - len(got[d].text)


def test_op1_with_null_and_repeated_ids_long_texts_and_clashing_columns(spark, tmp_path):
    rnd = random.Random(3)
    said = lambda n: " ".join(f"q{rnd.randrange(10**6)}" + ("." if k % 9 == 8 else "") for k in range(n))
    one, long = said(60), said(30_000)
    rows = [(None, f"{said(30)}\n{one}", "a", 1), (3, one, "b", 2), (3, one, "b", 2), (3, said(9), "c", 3), (5, long, "d", 4), (6, f"{one} {long}", "e", 5), (7, None, "f", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, removed_spans string, n_removed int").repartition(3)
    out = [tuple(r) for r in spans.remove_repeats(df).select("doc_id", "text").collect()]
    want = plain_repeats([r[:2] for r in rows])
    assert Counter(out) == Counter((d, want.get((d, t), t)) for d, t, *_ in rows)
    left = {d: t for d, t in out}
    assert left[3] is not None and one not in left[None] and len(left[6]) < 400 and left[5] == long


# ---- op6


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def check_secrets(rows, texts):
    names = ("assign", "access", "hex", "random")
    for r in rows:
        base = base_spans(texts[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        every = [x.split(":") for x in r.spans.split(",") if x]
        assert [(int(a), names.index(k), int(b)) for k, a, b in every if k != "random"] == base
        for k, a, b in every:
            if k == "random":
                assert re.fullmatch(r"[A-Za-z0-9+/_-]{20,}={0,2}", texts[r.doc_id][int(a) : int(b)])
                assert all(int(b) <= x or y <= int(a) for x, _, y in base)


def test_op6_against_plain_patterns(spark, tmp_path):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_secrets(secrets.op6_secret_scan(spark, SF).collect(), texts)
    many = "password: abcdef " * 5000 + "0123456789abcdef" * 2
    rows = [(1, None), (2, ""), (3, many), (4, many), (5, "é😀 token=abcdefgh\u0001 AKIA" + "Q" * 16)]
    found = secrets.op6_secret_scan(spark, table(spark, tmp_path, rows, "doc_id bigint, text string")).collect()
    assert len(found) == 5
    check_secrets(found, dict(rows))


def test_op6_with_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "token: abcdef123", "old")] * 3
    out = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string, secret_spans string")).collect()
    assert [len(r.secret_spans) for r in out] == [1, 1, 1]


ALPHABETS = {
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "upper hex": "0123456789ABCDEF",
}
#: Found of planted keys, at least, by encoding and length: what the battery can tell falls with length.
RECALL = {
    ("base64", 24): 0.85, ("base64", 40): 0.95, ("base64", 64): 0.95, ("base36", 32): 0.8, ("base36", 40): 0.9, ("base36", 64): 0.95,
    ("base32", 40): 0.65, ("base32", 64): 0.95, ("upper hex", 32): 0.8, ("upper hex", 40): 0.88, ("upper hex", 64): 0.95,
}


def planted(spark, per_kind=200):
    rnd = random.Random(12)
    rows, kind = [], {}
    for name, letters in ALPHABETS.items():
        for n in (24, 32, 40, 64):
            for _ in range(per_kind):
                kind[len(rows)] = (name, n)
                rows.append((len(rows), f"see {''.join(rnd.choices(letters, k=n))} there"))
    said = "".join(r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de')").limit(60).collect())
    words = sorted({w.lower() for w in re.findall("[A-Za-z]{3,12}", said)})
    made = {"path": "/", "snake": "_", "kebab": "-", "camel": "", "plain": ""}
    for name, join in made.items():
        for _ in range(3 * per_kind):
            w = rnd.choices(words, k=rnd.randint(4, 8))
            kind[len(rows)] = (name, 0)
            rows.append((len(rows), f"see {join.join(x.title() if name == 'camel' else x for x in w)}{rnd.choice(['', '', '2', '2024'])} there"))
    out = secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string"))
    hits = {r.doc_id for r in out.where(F.exists("secret_spans", lambda s: s["kind"] == 3)).select("doc_id").collect()}
    share = {k: np.mean([i in hits for i in kind if kind[i] == k]) for k in set(kind.values())}
    return share, [rows[i][1] for i in sorted(hits) if kind[i][0] in made]


def test_random_keys_by_encoding_and_length_and_names_that_are_none(spark):
    share, false = planted(spark)
    for k, least in RECALL.items():
        assert share[k] >= least, (k, share)
    assert all(share[name, 0] <= 0.02 for name in ("path", "snake", "kebab", "camel", "plain")), false[:5]


# ---- op7


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_op7_counts_and_verdicts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.op7_quality_rules(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        counts = plain_counts(texts[r.doc_id])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r.base_failed and r.kept)
    good = [r for r in rows if label.get(r.doc_id) == 1 and not r.base_failed]
    assert good and np.mean([r.kept for r in good]) > 0.9


def test_verdicts_of_rules_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rules = quality.fit(docs, labels.where("doc_id % 3 <> 0"))
    held = labels.where("doc_id % 3 = 0 and quality is not null").select("doc_id", "quality")
    rows = quality.with_counts(docs.join(held, "doc_id"), ["quality"]).where(~quality.base_failed()).select("quality", quality.verdict(rules).alias("kept")).collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert rules and np.mean(good) > 0.9 and np.mean(good) - np.mean(bad) > 0.2


def test_op7_with_nulls_long_texts_and_repeats(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "word other " * 100_000), (3, "word other " * 100_000), (None, " ".join(f"w{k}" for k in range(60)))]
    path = table(spark, tmp_path, rows, "doc_id bigint, text string")
    spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, quality int").write.parquet(f"{path}/labels.parquet")
    out = Counter((r.doc_id, r.n_words, r.n_repeat_words, r.kept) for r in quality.op7_quality_rules(spark, path).collect())
    assert out == Counter({(1, 0, 0, False): 1, (2, 0, 0, False): 1, (3, 200_000, 200_000, False): 2, (None, 60, 0, True): 1})


# ---- the pipeline


def plain_pipeline(spark, docs, labels):
    """(doc_id, text) and how often each is in the mix, from plain loops; the learned rules are taken as they are."""
    rules = quality.fit(docs, labels)
    kept = {r.doc_id for r in quality.with_counts(docs, ["doc_id"]).where(quality.verdict(rules)).select("doc_id").collect()}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in kept}
    assert all(plain_counts(r.text)[0] >= 50 for r in rows.values())
    sets = {}
    for d, r in rows.items():
        w = r.text.encode().lower().split()
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    ids, gone = sorted(sets), set()
    up = {d: d for d in ids}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    gone = {d for d in ids if find(d) != d}
    out = {}
    for d in ids:
        if d not in gone:
            text, at = "", 0
            for a, _, b in base_spans(rows[d].text):
                if a >= at:
                    text += rows[d].text[at:a] + ("" if text and a == at and text.endswith("[SECRET]") else "[SECRET]")
                at = max(at, b)
            out[d] = (rows[d].source, text + rows[d].text[at:])
    return out


def plain_shares(sizes):
    """Words that each source gives, by weights 1, 2, 3 in turn and at most three epochs."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, target, free = {s: k % 3 + 1 for k, s in enumerate(order)}, {}, set(order)
    while free:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 3 * sizes[s] <= weight[s] * level}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 3 * sizes[s] for s in full}
        free -= full
    return target


def test_pipeline_rows_against_plain_loops(spark, tmp_path):
    import public_tokenizers
    import tiktoken

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "", "en", "s", 0), (90_003, " ".join(f"extra{k}" for k in range(80)), "en", None, 600)], docs.schema)
    docs.unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = plain_pipeline(spark, docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        import base64

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {d: encoding.encode_ordinary(t) for d, (_, t) in want.items()}
    assert all(r.decodes_to_text for r in got) and {r.doc_id for r in got} <= set(want)
    assert all(list(r.ids) == ids[r.doc_id] and r.n_tokens == len(r.ids) and r.source == want[r.doc_id][0] for r in got)
    words = {d: len(WORD.findall(t)) for d, (_, t) in want.items()}
    times, sizes = Counter(r.doc_id for r in got), Counter()
    for d, (source, _) in want.items():
        sizes[source] += words[d]
    share = plain_shares(sizes)
    for source in sizes:
        mine = [d for d in want if want[d][0] == source]
        epochs = int(share[source] // sizes[source])
        assert {times[d] for d in mine} <= {epochs, epochs + 1}
        assert abs(sum(words[d] * times[d] for d in mine) - share[source]) <= max(words[d] for d in mine)


STAGE_ROWS = [(1, None, "en", None, 0, "x"), (1, None, "en", None, 0, "x"), (2, "", "en", "s", 0, "x"), (3, "token: abcdef123 " + " ".join(f"w{k}" for k in range(70)), None, "s", 9, "x")]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_with_nulls_repeats_clashes_and_no_rows(spark, tmp_path, name, stage):
    spark.createDataFrame([(3, 1)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([*STAGE_ROWS, STAGE_ROWS[-1]], "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string")
    out = stage(spark, docs, str(tmp_path))
    if name != "byte_bpe":
        assert out.columns == docs.columns
    n = {"quality_rules": 2, "minhash_near_dedup": 4, "secret_scans": 5, "byte_bpe": 5}
    assert out.count() == n[name] if name in n else out.count() >= 4
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_no_task_of_the_last_stage_has_two_python_workers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = corpus_pipeline.byte_bpe(spark, docs, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
