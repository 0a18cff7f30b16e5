"""The Jaccard join and connected components against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from dimweave.llm import components as stars
from dimweave.llm import jaccard
from dimweave.llm.components import components
from helpers import DOCS, frame, shingles


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            name[r] = min(name.get(r, d), d)
    return sorted(((d, len(s), name.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(n=40, seed=5):
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        w = list(base) if i % 3 else [f"c{j}" for j in range(80)]
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = f"e{i}{rnd.random()}"
        rows.append((100 + i, " ".join(w[:rnd.randint(60, len(w))] if i % 5 == 0 else w)))
    return rows


@pytest.mark.parametrize("block", [jaccard.BLOCK, 300])
def test_components_match_all_pairs(spark, block):
    rows = DOCS + near_copies()
    got = jaccard.similar_documents(frame(spark, rows).repartition(4), block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_exact_threshold(spark):
    """8 of 10 shingles shared links, 8 of 11 doesn't."""
    a = [f"t{i}" for i in range(13)]  # 9 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:12])), (3, " ".join(a + ["x"])), (4, " ".join(a[:11] + ["q", "r"]))]
    got = jaccard.similar_documents(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_search_finds_every_partner():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(40, 60), replace=False),
                                      rng.integers(0, 2**63, rng.integers(0, 8)).astype(np.uint64)])) for _ in range(50)]
    sets.sort(key=len)
    search = jaccard.Search(sets, 80)
    for q, s in enumerate(sets):
        want = [r for r in range(q + 1, len(sets)) if (c := len(np.intersect1d(s, sets[r]))) * 100 >= 80 * (len(s) + len(sets[r]) - c)]
        assert sorted(search.partners(q, np.zeros(len(sets), bool)).tolist()) == want


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(120)] + [(i, i + 1) for i in range(200, 260)] + [(7, 7)]
    label = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in label.items() if any(label[y] == r and y != x for y in label)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _rounds(spark, links, monkeypatch):
    """Components by node, and how many stars were drawn."""
    drawn, star = [], stars._star
    with monkeypatch.context() as m:
        m.setattr(stars, "_star", lambda rows, large: (drawn.append(large), star(rows, large))[1])
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    return got, len(drawn)


def test_stars_take_no_round(spark, monkeypatch):
    got, drawn = _rounds(spark, [(-3, 5), (9, -3), (5, -3), (7, 8), (4, 4)], monkeypatch)
    assert (got, drawn) == ({-3: -3, 5: -3, 9: -3, 7: 7, 8: 7}, 0)
    # one more round than needed would draw two more
    got, drawn = _rounds(spark, [(1, 2), (2, 3), (11, 13), (12, 13)], monkeypatch)
    assert (got, drawn) == ({1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11}, 2)


def test_components_of_random_links(spark, monkeypatch):
    rnd = random.Random(2)
    nodes = [rnd.randrange(-2**62, 2**62) for _ in range(300)]
    links = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(160)] + [(nodes[0], n) for n in nodes[:40]]
    links += list(zip(nodes[200:230], nodes[201:231]))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert _rounds(spark, links, monkeypatch)[0] == {n: find(n) for n in linked}


def test_links_of_a_task_are_stars():
    rows = [[i, *range(100, 140)] for i in range(5)] + [[90, *range(200, 240)], [91, *range(200, 240)]]
    nodes = [14, 11, 13, 12, 15, 22, 21]
    table = pa.table({"node": nodes, "part": [0] * 7, "blob": [jaccard.squeeze_sorted(np.array(sorted(r), np.uint64)) for r in rows]})
    got = jaccard._link(80)(table)
    assert sorted(zip(got["a"].to_pylist(), got["b"].to_pylist())) == [(12, 11), (13, 11), (14, 11), (15, 11), (22, 21)]


def test_empty_table(spark):
    assert jaccard.similar_documents(frame(spark, [])).count() == 0
