import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parley.llm import lexical_search as module
from parley.llm.lexical_search import Blocks, Queries, Weighted, _levels, bounds, lexical_search
from prose import prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def all_scores(docs, items):
    """(item number, document number): score, every document against every item."""
    counted = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(c) for c in counted), sum(c.total() for c in counted)
    df = Counter(t for c in counted for t in c)
    out = {}
    for i, (_, text) in enumerate(items):
        wanted = Counter(terms(text))
        for d, held in enumerate(counted):
            if not held:
                continue
            m, score = 25 + 75 * held.total() * n_docs // n_terms, 0
            for t, times in wanted.items():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * weight * (10**9 * held[t] // (1000 * held[t] + 8 * m))
            out[i, d] = score
    return out


def expected(docs, items, k=10):
    scores, rows = all_scores(docs, items), []
    for i, (item, _) in enumerate(items):
        found = [(-s, docs[d][0] is None, docs[d][0] or 0, docs[d][0]) for (j, d), s in scores.items() if j == i and s]
        rows += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, n=600):
    rng = random.Random(seed)
    words = [prose(i, 1) for i in range(400)] + ["Äther", "東京", "x9", "ß"]
    weights = [1 / (k + 1) for k in range(len(words))]
    texts = []
    for _ in range(n):
        size = rng.choice([1, 3, 20, 80, 300])
        text = rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=size))
        texts.append(text.upper() if rng.random() < 0.2 else text)
    texts += rng.choices(texts, k=n // 3) + [texts[0]] * (n // 3)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(70)]
    return list(enumerate(texts)), items


def test_against_every_pair(spark, as_docs):
    docs, items = corpus(1)
    items += [(100, "nowhere to be found"), (101, ""), (102, None), (103, docs[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = found(lexical_search(as_docs(docs).repartition(6), benchmark))
    assert got == expected(docs, [(i, t) for i, t in items if t])


def test_passes_give_the_same(spark, as_docs):
    docs, items = corpus(2, 120)
    benchmark = spark.createDataFrame([(f"i{i}", t) for i, t in items], "item_id string, text string")
    got = found(lexical_search(as_docs(docs), benchmark, k=3, query_bytes=4000))
    assert got == expected(docs, [(f"i{i}", t) for i, t in items], 3)


@pytest.mark.parametrize("limits", [(1024, 1 << 19), (16, 1 << 19), (1024, 3000)])
def test_bounds_hold(monkeypatch, limits):
    monkeypatch.setattr(module, "BLOCK_DOCS", limits[0])
    monkeypatch.setattr(module, "BLOCK_ENTRIES", limits[1])
    docs, items = corpus(3)
    scores = all_scores(docs, items)
    queries = Queries(items)
    entries, starts, lengths, hashes, at = _levels(pa.array([t for _, t in docs]))
    row, number, _ = queries.found(hashes, at)
    first = np.searchsorted(row, np.arange(len(docs) + 1))
    held, rows = Blocks(), []
    for k in range(len(docs)):
        rows += held.add(k, int(lengths[k]), entries[starts[k] : starts[k + 1]], number[first[k] : first[k + 1]])
    rows = [r for b in [*rows, *held.rest()] for r in b.to_pylist()]
    assert sorted(k for r in rows for k in r["keys"]) == list(range(len(docs)))
    df = Counter()
    for r in rows:
        df.update(dict(zip(r["terms"], r["df"], strict=True)))
    assert max(df.values()) > 50
    whole = Weighted(queries, len(docs), int(lengths.sum()), df)
    groups, excess = whole.groups(), []
    for r in rows:
        bound = bounds(r, whole, groups)
        for j, k in enumerate(r["keys"]):
            for i in range(len(items)):
                assert bound[i, j] >= scores[i, k]
                excess.append(bound[i, j] - scores[i, k])
    # tight enough to exclude
    assert np.median(excess) <= 0.4 * np.mean(list(scores.values()))


def test_edge_rows(spark, edge_docs, edge_rows):
    items = [(1, edge_rows[0][1]), (1, prose(4, 20)), (None, "TEXT ünïcödé"), (2, "12"), (2, "12")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    got = found(lexical_search(edge_docs, benchmark))
    assert got == expected(edge_rows, items[:4])
    # A-Z alone are lower-cased, so the capital of another alphabet is a term of its own
    assert [r[2] for r in got if r[0] is None] == [11]


def test_sums_beyond_doubles():
    queries = Queries([(1, "rare common"), (2, "rare")])
    times = np.array([10**9 + 1, 10**9 + 3])
    queries.held = [(queries.held[0][0], times), queries.held[1]]
    whole = Weighted(queries, 50, 1000, {0: 3, 1: 40})
    ((_, terms, matrix),) = whole.groups()
    part = np.array([[999_999], [555_557]])
    assert matrix.dtype == np.int64 and len(terms) == 2
    exact = sum(int(t) * int(w) * int(p) for t, w, p in zip(times, whole.weights, part[:, 0], strict=True))
    assert int((matrix @ part)[0, 0]) == exact > 1 << 53


def test_empty_tables(no_docs, edge_docs, spark):
    benchmark = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    assert lexical_search(no_docs, benchmark).count() == 0
    assert lexical_search(edge_docs, benchmark.limit(0)).count() == 0
