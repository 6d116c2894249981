import random
import re

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import jaccard_join as module
from parley.llm.common import components
from parley.llm.jaccard_join import jaccard_join
from parley.llm.shingles import shingle_sets
from prose import prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    """doc_id to (set size, smallest doc_id reachable), from all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def changed(rng, text, times):
    words = text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


@pytest.mark.parametrize("frequent, window", [(1 << 17, 4_000_000), (8, 500)])
def test_against_all_pairs(as_docs, monkeypatch, frequent, window):
    monkeypatch.setattr(module, "FREQUENT", frequent)
    monkeypatch.setattr(module, "WINDOW", window)
    monkeypatch.setattr(module, "CHECKS", 3)
    rng = random.Random(7)
    shared = prose(0, 40)
    rows = []
    for k in range(25):
        base = prose(k + 1, rng.choice([6, 30, 90, 200]))
        rows += [changed(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 4])) for _ in range(rng.choice([1, 2, 5, 12]))]
        rows.append(shared + " " + prose(k + 500, rng.choice([2, 8, 10, 40])))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(as_docs(rows)).collect()}
    assert got == expected(rows)


def test_edge_rows(edge_docs, edge_rows):
    got = jaccard_join(edge_docs).collect()
    assert len(got) == len(edge_rows)
    want = expected({i: t for i, t in edge_rows if i is not None}.items())
    for r in got:
        assert r.component_id is None if r.doc_id is None else (r.n_shingles, r.component_id) == want[r.doc_id]


def test_no_rows_and_no_links(no_docs, as_docs):
    assert jaccard_join(no_docs).count() == 0
    got = jaccard_join(as_docs([(1, None), (2, ""), (3, "one two three four five six")])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(1, 0, 1), (2, 0, 2), (3, 2, 3)]


def test_shingle_counts_and_overlaps():
    texts = ["a b c d e f", "A  B\tC\nd e\x0bf", "x", "", None, "a a a a a a a a", "é b c d e", "b c d e f g"] + [prose(i, 50) for i in range(9)]
    sets = list(shingle_sets(pa.array(texts, pa.string())))
    want = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])


def test_shingles_of_long_texts_in_segments(monkeypatch):
    texts = pa.array([prose(1, 300), "", prose(2, 90), "w" * 200 + " a b c d e", None])
    whole = [s.tolist() for s in shingle_sets(texts)]
    monkeypatch.setattr("parley.llm.shingles.SEGMENT", 64)
    assert [s.tolist() for s in shingle_sets(texts)] == whole


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 150), (101, 150), (150, 150), (7, None)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in (100, 101, 150)} | {i: 200 for i in range(200, 260)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_meet_once_and_not_by_shingle(spark):
    rows = [(1, 5, [1, 2, 3]), (2, 5, [3, 2, 9]), (3, 4, [7])]
    prefixes = spark.createDataFrame(rows, "doc long, n int, prefix array<long>")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    got = {(r.a, r.b): (r.n_a, r.n_b, r.shared) for r in module.prefix_overlap(pairs, prefixes).collect()}
    assert got == {(1, 2): (5, 5, 2), (1, 3): (5, 4, 0)}
