import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from barloom.llm import neardup, spans, vectors

DOC = "doc_id bigint, text string, kept string"


def groups(links, ids):
    up = {i: i for i in ids}

    def find(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_expected(rows):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    return sets, groups(links, sets)


def corpus(n, seed):
    rnd = random.Random(seed)
    rows, base = [], []
    for i in range(n):
        kind = rnd.random()
        if base and kind < 0.6:
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(400)}"
        else:
            w = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([1, 3, 5, 6, 40, 90]))]
        base.append(w)
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(w), "clash"))
    return rows + [(n, None, "x"), (n + 1, "", "x"), (n + 2, " \t\n", "x"), (n + 3, "Word WORD " * 4000, "x"), (n + 4, "word word " * 4000, "x")]


@pytest.mark.parametrize("records,depth", [(4096, 3), (6, 3), (6, 1), (2, 2)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, records, depth):
    monkeypatch.setattr(neardup, "BLOCK_RECORDS", records)
    monkeypatch.setattr(neardup, "MAX_DEPTH", depth)
    monkeypatch.setattr(neardup, "WORK", records * 4)
    rows = corpus(160, 7)
    sets, of = near_expected(rows)
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found} == {(i, len(sets[i]), of[i], of[i] == i) for i in sets}


def test_large_nodes_branch_until_they_are_small(spark, monkeypatch):
    """Records that share a line meet in large nodes; children are small, hold no strangers, and lose no pair."""
    monkeypatch.setattr(neardup, "BLOCK_RECORDS", 8)
    monkeypatch.setattr(neardup, "WORK", 64)
    rnd = random.Random(3)
    line = [f"c{k}" for k in range(20)]
    rows = []
    for i in range(0, 240, 2):
        own = [f"d{i}w{k}" for k in range(80)]
        rows += [(i, " ".join([*line, *own]), "x"), (i + 1, " ".join([*line, *own[: rnd.choice([74, 78, 80])], "end"]), "x")]
    levels, pairs = [], []
    children, late = neardup._Join.children, neardup._Join.pairs

    def counted(self, split):
        if (out := children(self, split)) is None:
            return None
        levels.append(sorted(r["count"] for r in out.groupBy("node").count().collect()))
        return out

    def last(self, split, whole):
        pairs.append((whole, split.count()))
        return late(self, split, whole)

    monkeypatch.setattr(neardup._Join, "children", counted)
    monkeypatch.setattr(neardup._Join, "pairs", last)
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == near_expected(rows)[1]
    assert levels and levels[0][-1] > 8  # the first level was split and its children were not all small
    assert len(levels) > 1 and sum(levels[-1]) < sum(levels[0])


def test_recall_of_the_trees():
    for similarity in (0.8, 0.85, 0.95):
        t = neardup.trees_for(neardup.RECALL, similarity)
        assert (1 - neardup.meeting(similarity)) ** t <= 1 - neardup.RECALL < (1 - neardup.meeting(similarity)) ** (t - 1)
        assert t + t // 6 <= neardup.SKETCH


def test_copies_of_one_original_in_groups_over_the_block_size(spark, monkeypatch):
    # a copy has two words changed: 150 / 170 shingles in common with the original, 140 / 180 with most other copies
    monkeypatch.setattr(neardup, "BLOCK_RECORDS", 6)
    rnd = random.Random(11)
    rows = []
    for g in range(4):
        w = [f"g{g}w{k}" for k in range(164)]
        rows.append((100 * g, " ".join(w), "x"))
        for c in range(1, 70):
            copy = list(w)
            for k in rnd.sample(range(5, 159), 2):
                copy[k] = f"c{c}k{k}"
            rows.append((100 * g + c, " ".join(copy), "x"))
    _, of = near_expected(rows)
    assert len(set(of.values())) < 20
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == of


def test_sketches_agree_with_the_recall_wanted():
    for similarity in (0.8, 0.85):
        k = neardup.agreement_for(1 - 1e-6, similarity)
        short = lambda k: sum(math.comb(64, i) * similarity**i * (1 - similarity) ** (64 - i) for i in range(k))
        assert short(k) <= 1e-6 < short(k + 1)


def test_near_duplicates_with_null_ids_repeats_and_no_rows(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(None, text, ""), (5, text, ""), (5, text, ""), (9, "x", ""), (None, None, "")], DOC)
    found = Counter((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect())
    assert found == Counter({(None, 5, False): 1, (5, 5, True): 2, (9, 9, True): 1, (None, None, True): 1})
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_the_stage_links_copies_from_0_8_on(spark):
    # one word of w changes 5 of w - 4 shingles on each side: similarities 45 / 55 and 35 / 45
    rows = []
    for i, words in enumerate((54, 44)):
        w = [f"t{i}w{k}" for k in range(words)]
        rows += [(2 * i, " ".join(w), "x"), (2 * i + 1, " ".join([*w[:20], "other", *w[21:]]), "x")]
    left = corpus_pipeline.minhash_near_dedup(spark, spark.createDataFrame(rows, DOC), "")
    assert sorted(map(tuple, left.collect())) == [rows[0], rows[2], rows[3]]


def test_repeated_passages_go_from_all_but_the_first(spark):
    rnd = random.Random(1)
    said = lambda n: " ".join(f"v{rnd.randrange(900)}" + ("." if rnd.random() < 0.1 else "") for _ in range(n)) + "."
    passage = said(60)
    rows = [(i, f"{said(rnd.randint(5, 80))} {passage if i % 3 == 0 else ''} {said(20)}", "x") for i in range(30)] + [(40, None, "x"), (41, "", "x"), (42, "Short. Text.", "x")]
    out = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, DOC).repartition(4)).collect()}
    middle = " ".join(passage.split()[15:-5])
    for i, text, _ in rows:
        if i % 3 == 0 and 0 < i < 30:
            assert middle not in out[i].text and out[i].n_removed == 1
        else:
            assert out[i].text == text and out[i].n_removed == 0
    assert spans.remove_repeats(spark.createDataFrame([], DOC)).count() == 0


def test_spans_against_brute_force_with_a_full_memory(spark, monkeypatch):
    monkeypatch.setattr(spans, "REMEMBERED", 20)
    rnd = random.Random(4)
    rows = [(i, "\n".join(rnd.choice(["one two three four five.", "six seven eight nine!", "ten " * 9, "Ⅻ é eleven twelve"]) for _ in range(rnd.randint(0, 9))), "x") for i in range(60)]
    out = {r.doc_id: r.text for r in spans.remove_repeats(spark.createDataFrame(rows, DOC).repartition(3)).collect()}
    seen, known = set(), spans._Tokens()
    for i, text, _ in rows:
        _, bounds, at = spans.sentences(text, known)
        words, b, gone = text.split(), bounds.tolist(), set()
        for s in range(len(b) - 1):
            e = next((e for e in range(s + 3, len(b)) if b[e] - b[s] >= 20), None)
            if e:
                h = tuple(words[b[s] : b[e]])
                gone |= set(range(at[b[s]], at[b[e]])) if h in seen else set()
                seen.add(h)
        assert out[i] == "".join(c for k, c in enumerate(text) if k not in gone)


def test_vectors_against_brute_force_with_small_nodes(spark, monkeypatch):
    for name, value in (("NODE", 60), ("CELL", 25), ("TILE", 16), ("SMALL", 9)):
        monkeypatch.setattr(vectors, name, value)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 8))
    x[100:200] = x[0] + 0.15 * rng.normal(size=(100, 8))
    x[200:260] = x[1] + 0.01 * rng.normal(size=(60, 8))
    x[300:320] = x[2]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] + [1.0] * 7, 1), (903, [None] + [1.0] * 7, 1), (904, [1.0, 2.0], 1), (905, [], 1)]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    of = groups(map(tuple, np.argwhere(near).tolist()), [r[0] for r in rows])
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links int")
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df.repartition(3)).collect()}
    assert found == {(r[0], int(near[r[0]].sum()) if r[0] < 400 else 0, of[r[0]], of[r[0]] == r[0]) for r in rows}
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_with_null_and_repeated_ids(spark):
    a, b = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(None, a), (4, a), (4, a), (7, [2.0, 0.0]), (None, b), (9, None), (None, None)], "vec_id bigint, embedding array<float>")
    found = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect())
    assert found == Counter({(None, 3, 4, False): 1, (4, 3, 4, True): 2, (7, 3, 4, False): 1, (None, 0, None, True): 2, (9, 0, 9, True): 1})


def tree(x):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(x)), pa.array([v.tobytes() for v in x], pa.binary())], names=["node", "raw"])
    (grown,) = vectors._grow(x.shape[1], np.float64)(iter([batch]))
    levels = np.stack([np.frombuffer(v, np.int32) for v in grown.column("levels").to_pylist()])
    return vectors.Subtree(vectors.unit(x), levels, np.arange(len(x)))


def test_the_traversal_of_clusters_compares_few_pairs():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(60, 32)), 50, axis=0) + 0.02 * rng.normal(size=(3000, 32))
    t = tree(vectors.unit(x))
    links = vectors._Links(len(x), np.ones(len(x), np.int64))
    vectors.Traversal(links, (0, 0), 0.95).open(t, t, True)
    near = t.x @ t.x.T >= 0.95
    np.fill_diagonal(near, False)
    assert (links.count == near.sum(axis=1)).all() and near.sum() >= 3000 * 40
    assert links.compared < 0.05 * 3000 * 2999 / 2


def test_levels_of_a_tree_are_nested_and_cover():
    rng = np.random.default_rng(6)
    x = vectors.unit(np.repeat(rng.normal(size=(20, 6)), 20, axis=0) + 0.3 * rng.normal(size=(400, 6)))
    t = tree(x)
    assert len({*t.levels[:, 0].tolist()}) == 1
    sizes = [len({*t.levels[:, k].tolist()}) for k in range(len(vectors.RADII))]
    assert sizes == sorted(sizes) and sizes[1] < sizes[2] < sizes[3]
    for k, radius in enumerate(vectors.RADII):
        own = t.levels[:, k]
        assert (np.linalg.norm(x - x[own], axis=1) <= radius + 1e-9).all()
        assert all(len({*t.levels[own == c, k - 1].tolist()}) == 1 for c in {*own.tolist()} if k)


def test_a_block_of_thousands_of_near_copies_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.permutation(200)[:195]], rng.integers(0, 1 << 62, 4).astype(np.uint64)])) for _ in range(4000)]
    sketch = np.stack([neardup.sketch_of(neardup.minwise(s)) for s in sets])
    agree = neardup.agreement_for(neardup.RECALL, 0.85)
    tracemalloc.start()
    joined = list(neardup._joined(np.arange(len(sets)), sets, agree, 85))
    hit = sum(len(others) for _, others in neardup._rows(sketch[:500], np.full(500, 199), np.arange(500), agree, 85))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(joined) == 3999 and hit > 400 * 499 / 2 * 0.9
    assert peak < 100e6


def test_one_row_of_a_group_stays(spark):
    t, other = "a b c d e f g h", "q r s t u v"
    rows = [(5, t, "x"), (5, t, "x"), (5, t, "y"), (None, t, "x"), (None, other, "x"), (7, t.upper(), "x"), (8, None, "x"), (8, None, "x"), (9, "", "x")]
    left = Counter(map(tuple, neardup.keep_one(spark.createDataFrame(rows, DOC)).collect()))
    assert left.pop((5, t, "x"), 0) + left.pop((5, t, "y"), 0) == 1
    assert left == Counter({(None, other, "x"): 1, (8, None, "x"): 2, (9, "", "x"): 1})
    assert neardup.keep_one(spark.createDataFrame(rows, DOC).limit(0)).count() == 0


def test_recall_of_pairs_just_over_the_threshold(spark):
    # 300 pairs of sets with 85 to 88 % in common, each pair apart from all others
    rnd = random.Random(21)
    rows, want = [], {}
    for i in range(300):
        w = [f"p{i}w{k}" for k in range(rnd.randint(120, 200))]
        copy = list(w)
        while True:
            copy[rnd.randrange(len(w))] = f"p{i}n{rnd.random()}"
            a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (w, copy))
            if len(a & b) / len(a | b) < 0.89:
                break
        rows += [(2 * i, " ".join(w), ""), (2 * i + 1, " ".join(copy), "")]
        want[2 * i + 1] = 2 * i if 100 * len(a & b) >= 85 * len(a | b) else 2 * i + 1
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert sum(v < k for k, v in want.items()) > 150
    assert {k: found[k] for k in want} == want
