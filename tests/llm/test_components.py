import random

import pytest

from barloom.llm import graph, neardup
from barloom.session import cut


def expected(links):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {(x, find(x)) for x in up if find(x) != x}


def some(n, m, seed):
    rnd = random.Random(seed)
    return [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("links,most", [
    ([], 0),
    ([(1, 1), (None, 2), (3, None)], 0),
    ([(0, i) for i in range(1, 60)] + [(i, 0) for i in range(30)], 0),
    ([(99, i) for i in range(60)], 1),
    (some(80, 70, 1), 4),
    (some(80, 160, 2), 4),
    ([(i, i + 1) for i in range(64)], 7),
])
def test_components_against_brute_force_end_at_stars(spark, monkeypatch, links, most):
    """Stars take no round, and none is made only to see that nothing changes."""
    rounds, made = [], graph._round
    monkeypatch.setattr(graph, "_round", lambda *a: rounds.append(1) or made(*a))
    found = [tuple(r) for r in graph.components(cut(spark.createDataFrame(links, "u bigint, v bigint"), "test")).collect()]
    assert sorted(found) == sorted(expected(links))
    assert len(rounds) <= most


def test_only_what_links_join_goes_through_rounds(spark, monkeypatch):
    """Members of a component found before are in no later call, and steps that find no links make none."""
    monkeypatch.setattr(neardup, "BLOCK_RECORDS", 6)
    calls, made = [], neardup.components

    def seen(edges):
        calls.append([(bytes(r.u), bytes(r.v)) for r in edges.collect()])
        return made(edges)

    monkeypatch.setattr(neardup, "components", seen)
    rows, rnd = [], random.Random(5)
    for g in range(6):
        w = [f"g{g}w{k}" for k in range(164)]
        rows.append((100 * g, " ".join(w)))
        for c in range(1, 30):
            copy = list(w)
            for k in rnd.sample(range(5, 159), 2):
                copy[k] = f"c{c}k{k}"
            rows.append((100 * g + c, " ".join(copy)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i // 100 * 100 for i, _ in rows}
    assert len(calls) > 1 and all(calls)
    joined = set()
    for links in calls:
        assert not joined & {x for link in links for x in link}
        joined |= {u for u, _ in expected(links)}
