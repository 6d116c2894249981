import random

import pyarrow as pa
import pytest

from parley.llm import decontamination as module
from parley.llm.decontamination import Windows, contaminated, decontaminate, windows_of
from prose import prose


def plain(t):
    data, _ = module.normal(pa.array([t]))
    return data.tobytes()


def least(pattern, text):
    """Fewest edits that turn ``pattern`` into a part of ``text``, by whole alignment."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return min(row)


def expected(index, texts):
    """(row, window) to least edits, where those are within 5 % of the window."""
    found = {}
    for r, t in enumerate(texts):
        for w in range(len(index.items)):
            n = int(index.length[w])
            edits = least(index.text[w, :n].tobytes(), plain(t))
            if edits * 100 <= 5 * n:
                found[r, w] = edits
    return found


def fewest(index, texts):
    found = {}
    for r, w, e in zip(*(x.tolist() for x in index.find(pa.array(texts)))):
        found[r, w] = min(e, found.get((r, w), e))
    return found


def edited(rng, text, times):
    for _ in range(times):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + "q" + text[k:], text[:k] + "Z" + text[k + 1 :]])
    return text


@pytest.mark.parametrize("segment", [None, 50])
def test_against_whole_alignment(monkeypatch, segment):
    rng = random.Random(4)
    items = [(i, prose(i, n)) for i, n in enumerate([4, 8, 20, 30, 45])]
    texts = []
    for _, item in items:
        for times in (0, 1, 2, 4, 6, 9):
            near = edited(rng, item, times)
            texts.append(prose(rng.random(), 8) + "\n" + near.upper().replace(" ", " - ") + prose(rng.random(), 5))
            texts.append(near[len(near) // 3 :])
    if segment:
        monkeypatch.setattr(module, "SEGMENT", segment)
    long, short = windows_of(items)
    assert long.items and short.items
    for index in (long, short):
        # a band may miss the very best alignment of a window that it finds within budget
        got, all_found = fewest(index, texts), expected(index, texts)
        assert got.keys() == all_found.keys()
        assert all(all_found[k] <= e <= index.edits[k[1]] for k, e in got.items())


@pytest.mark.parametrize("n", range(16, 72, 6))
def test_short_items_have_their_whole_budget(n):
    rng = random.Random(n)
    item = prose(n, 40)[:n].strip() or "x" * n
    (index,) = windows_of([(1, item)])
    texts = [prose(i, 6) + " " + edited(rng, item, i % 5) + " " + prose(i + 99, 6) for i in range(30)]
    assert fewest(index, texts).keys() == expected(index, texts).keys()


def test_runs_of_bands(monkeypatch):
    """More candidate bands than are aligned at a time, with different edits."""
    rng = random.Random(5)
    item = prose(70, 40)[:100]
    texts = [prose(i, 5) + " " + edited(rng, item, i % 6) + " " + prose(i + 9999, 5) for i in range(600)]
    index = Windows([(1, item)])
    found = index.find(pa.array(texts))
    assert len(found[0]) > 1024
    truth = expected(index, texts)
    assert len(truth) > 500 and {*truth.values()} == {0, 1, 2, 3, 4, 5}
    assert fewest(index, texts).keys() == truth.keys()
    right = sum(e == truth[k] for k, e in fewest(index, texts).items())
    assert right > 0.95 * len(truth)
    for size in (1, 511, 512, 513, 1024, len(found[0]), 1 << 20):
        monkeypatch.setattr(module, "ALIGNED", size)
        assert all((a == b).all() for a, b in zip(found, index.find(pa.array(texts)), strict=True))


@pytest.fixture(scope="module")
def benchmark_items(spark):
    rows = [(0, prose(50, 30)), (1, prose(51, 40)), (2, "short"), (3, None), (1, prose(51, 40)), (None, prose(52, 30))]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_documents_and_items(spark, as_docs, benchmark_items):
    one, two, three = prose(50, 30), prose(51, 40), prose(52, 30)
    docs = as_docs([(1, one), (2, prose(9, 99) + two.upper() + prose(8, 9) + one), (3, prose(7, 300)), (4, "short"), (5, three), (5, three), (6, "")])
    for block in (8 << 20, 40):
        got = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark_items, block).collect()}
        assert got == {(1, 0), (2, 1), (2, 0), (5, None)}
        assert sorted(r.doc_id for r in decontaminate(docs, benchmark_items, block).collect()) == [3, 4, 6]


def test_edge_rows(edge_docs, edge_rows, benchmark_items):
    assert contaminated(edge_docs, benchmark_items).count() == 0
    clean = decontaminate(edge_docs, benchmark_items)
    assert clean.columns == edge_docs.columns and clean.count() == len(edge_rows)
    items = edge_docs.filter("doc_id = 1").selectExpr("7L item_id", "text")
    assert {r.doc_id for r in contaminated(edge_docs, items).collect()} == {1, 2, 7, 10, None}


def test_empty_tables(no_docs, edge_docs, edge_rows, benchmark_items):
    assert contaminated(no_docs, benchmark_items).count() == 0
    assert contaminated(edge_docs, benchmark_items.limit(0)).count() == 0
    assert decontaminate(edge_docs, benchmark_items.limit(0)).count() == len(edge_rows)
