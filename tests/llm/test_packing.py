import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm.packing import pack, pack_documents, pack_group

SIZES = (8, 16, 32)


def checked(rows, lengths, sizes):
    """Every token of every document lies in one place, bins overflow nowhere and are as small as can be."""
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r.start, r.length))
        if r.length:
            bins[r.bin_id].append((r.bin_offset, r.length, r.bin_size))
        else:
            assert (r.bin_id, r.bin_offset, r.bin_size) == (None, None, None)
    for held in bins.values():
        held.sort()
        assert [o for o, _, _ in held] == [sum(x[1] for x in held[:k]) for k in range(len(held))]
        total, size = sum(x[1] for x in held), {x[2] for x in held}
        assert size == {min(s for s in sizes if s >= total)}
    for doc, pieces in parts.items():
        pieces.sort()
        assert [s for s, _ in pieces] == [sum(x[1] for x in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) == (lengths[doc] or 0)
    return bins


def test_any_lengths(spark):
    rng = random.Random(2)
    lengths = {i: rng.choice([None, 0, 1, 7, 8, 9, 31, 32, 33, rng.randint(1, 100)]) for i in range(300)}
    rows = pack(spark.createDataFrame(list(lengths.items()), "doc_id long, n_tokens long"), SIZES, 1, group=64).collect()
    bins = checked(rows, lengths, SIZES)
    used = sum(n for n in lengths.values() if n)
    assert sum(b[0][2] for b in bins.values()) < 1.1 * used
    assert set(lengths) == {r.doc_id for r in rows}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=60))
def test_best_fit_never_wastes_an_open_bin(lengths):
    lengths = np.array(sorted(lengths, reverse=True))
    bins, offsets, size = pack_group(lengths, SIZES, 1)
    for b in set(bins.tolist()):
        mine = bins == b
        assert lengths[mine].sum() <= size[mine][0]
    # no later bin's first piece would have fitted what is left free in a bin of the largest size
    assert len(set(bins.tolist())) <= 2 * lengths.sum() // SIZES[0] + 1


def best_fit(lengths, sizes, overhead):
    """Every open bin and every size tried for every piece."""
    rooms, out = [], []  # rooms: (when last filled, room) of each bin
    for i, length in enumerate(lengths):
        fits = [(room, -when, b) for b, (when, room) in enumerate(rooms) if room >= length]
        if fits:
            b = min(fits)[2]
        else:
            prices = []
            for size in sizes:
                if size >= length:
                    supply = sum(x for x in lengths[i + 1 :] if x <= size - length)
                    prices.append(((size + overhead) / (length + min(size - length, supply)), size))
            b = len(rooms)
            rooms.append((i, min(prices)[1]))
        rooms[b] = (i, rooms[b][1] - length)
        out.append(b)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=80), st.integers(0, 9))
def test_against_best_fit_by_trial(lengths, overhead):
    lengths = sorted(lengths, reverse=True)
    bins, _, _ = pack_group(np.array(lengths), SIZES, overhead)
    assert bins.tolist() == best_fit(lengths, SIZES, overhead)


def test_large_ids_beside_a_null(spark):
    ids = [None, 2**53 + 1, 2**62 + 3, -(2**62) - 1, None]
    rows = pack(spark.createDataFrame([(i, 5) for i in ids], "doc_id long, n_tokens long"), SIZES, 1).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i in ids if i is not None)
    assert sum(r.doc_id is None for r in rows) == 2
    words = pack(spark.createDataFrame([("a", 5), (None, 7)], "doc_id string, n_tokens long"), SIZES, 1).collect()
    assert {(r.doc_id, r.length) for r in words} == {("a", 5), (None, 7)}


def test_edge_rows(edge_docs, edge_rows):
    rows = pack_documents(edge_docs).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in edge_rows}
    starts = [r for r in rows if r.piece == 0]
    assert len(starts) == len(edge_rows)


def test_no_rows(no_docs):
    assert pack_documents(no_docs).count() == 0
