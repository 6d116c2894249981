"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of similar size lie in blocks. A block has a row of bits per signature position and a bit
per document in it; a term sets a few positions, and again for having been seen twice, four times
and so on. ANDing a query term's rows gives the documents that may hold it and how often at most,
so sums of weights over such rows bound every document's score from above. The documents with the
best bounds are scored first, which sets a bar; then all whose bound reaches the bar are scored
exactly from their texts. The rest are provably below it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.rows import best
from parley.llm import tokens
from parley.llm.common import key_filter, maybe_in, ship
from parley.llm.decontamination import blocks
from parley.llm.shingles import mix, string_bytes, word_hashes
from parley.session import staged

#: Documents of a block, and entries of all of them, at most.
BLOCK_DOCS, BLOCK_ENTRIES = 1024, 1 << 19
#: Documents and entries held back to find some of similar size.
HELD_DOCS, HELD_ENTRIES = 8192, 1 << 22
#: Signature positions per entry, and how many of them an entry sets.
WIDTH, POSITIONS = 8, 3
#: How often a term must occur for its entries; the last one stands for any number.
LEVELS = (1, 2, 4, 8, 16)
#: Text of queries that is searched for in one pass, and items scored together.
QUERY_BYTES, TOGETHER = 1 << 20, 32
#: 64-bit words of the filters on documents to be scored.
FIRST_WORDS, ALL_WORDS = 1 << 14, 1 << 18
_LOW = (1 << 52) - 1
_LEVEL = np.random.Generator(np.random.PCG64(20240301)).integers(0, 1 << 64, len(LEVELS), np.uint64)
_TABLE_BITS = 20

# What separates terms, and the scoring rule.
APART = np.zeros(256, bool)
APART[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
FLOOR, SLOPE, SCALE, STEP, SHARE = 25, 75, 1_000_000_000, 1000, 8

Batches = Iterator[pa.RecordBatch]


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each term, and where each text's terms begin and the last's end."""
    return word_hashes(*string_bytes(texts), APART)


def positions(entries: np.ndarray, width: int) -> np.ndarray:
    """The signature positions of each entry, along a new last axis."""
    step = (entries >> np.uint64(32)) | np.uint64(1)
    turn = np.arange(POSITIONS, dtype=np.uint64)
    return ((entries[..., None] & np.uint64(0xFFFFFFFF)) + turn * step[..., None]) % np.uint64(width)


class Queries:
    """Benchmark texts as terms: sorted distinct term hashes and how often each item has each."""

    def __init__(self, items: list[tuple]) -> None:
        hashes, at = terms_of(pa.array([t for _, t in items], pa.large_string()))
        self.ids = [item for item, _ in items]
        self.terms, numbers = np.unique(hashes, return_inverse=True)
        spans = zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
        self.held = [np.unique(numbers[a:b], return_counts=True) for a, b in spans]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.terms >> np.uint64(64 - _TABLE_BITS)] = True

    def found(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term number, how often) of the query terms in texts."""
        spot = np.flatnonzero(self.table[hashes >> np.uint64(64 - _TABLE_BITS)])
        if not len(spot) or not len(self.terms):
            return (np.zeros(0, np.int64),) * 3
        number = np.minimum(np.searchsorted(self.terms, hashes[spot]), len(self.terms) - 1)
        sure = self.terms[number] == hashes[spot]
        row = np.searchsorted(at, spot[sure], side="right") - 1
        pairs, times = np.unique(row * len(self.terms) + number[sure], return_counts=True)
        return pairs // len(self.terms), pairs % len(self.terms), times


class Weighted:
    """Queries with the weights of their terms in one corpus."""

    def __init__(self, queries: Queries, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.queries, self.n_docs, self.n_terms = queries, n_docs, n_terms
        ratios = ((2 * n_docs + 2) / (2 * df.get(t, 0) + 1) for t in range(len(queries.terms)))
        self.weights = np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)

    def groups(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(first item, its and its neighbours' terms, items x terms: weight by occurrences)."""
        out, queries = [], self.queries
        for first in range(0, len(queries.ids), TOGETHER):
            held = queries.held[first : first + TOGETHER]
            terms = np.unique(np.concatenate([t for t, _ in held]))
            matrix = np.zeros((len(held), len(terms)), np.int64)
            for row, (own, times) in zip(matrix, held, strict=True):
                row[np.searchsorted(terms, own)] = times * self.weights[own]
            # doubles hold these sums exactly up to 2**53, and are many times faster
            exact = matrix.sum(axis=1).max(initial=0) * (SCALE // STEP) < 1 << 53
            out.append((first, terms, matrix.astype(np.float64) if exact else matrix))
        return out

    def share(self, lengths: np.ndarray) -> np.ndarray:
        """What a document's length counts for, in integers of any size."""
        total = max(self.n_terms, 1)
        shares = [FLOOR + SLOPE * n * self.n_docs // total for n in lengths.tolist()]
        return np.array(shares, np.int64)


def saturation(times: np.ndarray, share: np.ndarray) -> np.ndarray:
    """A term's part of its weight, in millionths."""
    return SCALE * times // (STEP * times + SHARE * share)


def _levels(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(entries, where each text's begin, terms of each text, hashes, where they begin)."""
    hashes, at = terms_of(texts)
    lengths = np.diff(at)
    row = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    # rows of a batch are numbered in 12 bits; a clash of the other 52 only raises a bound
    keys = np.sort((row << np.uint64(52)) | (hashes >> np.uint64(12)))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, times = keys[new], np.diff(np.append(new, len(keys)))
    entries, rows = [], []
    for level, least in enumerate(LEVELS):
        here = keys[times >= least]
        entries.append(mix((here & np.uint64(_LOW)) ^ _LEVEL[level]))
        rows.append(here >> np.uint64(52))
    rows = np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    starts = np.searchsorted(rows[order], np.arange(len(lengths) + 1))
    return np.concatenate(entries)[order], starts, lengths, hashes, at


def signature(documents: list[np.ndarray]) -> tuple[int, bytes]:
    """(positions, bit slices) of a block; each document is its entries."""
    width = WIDTH * max(1, *map(len, documents))
    bits = np.zeros((width, len(documents)), bool)
    for number, entries in enumerate(documents):
        bits[positions(entries, width).ravel(), number] = True
    return width, np.packbits(bits, axis=1, bitorder="little").tobytes()


class Blocks:
    """Documents held back until some of similar size make a block."""

    def __init__(self) -> None:
        self.held: list[tuple] = []
        self.size = 0

    def add(self, key: int, length: int, entries: np.ndarray, watched: np.ndarray) -> Batches:
        self.held.append((len(entries), key, length, entries, watched))
        self.size += len(entries)
        if len(self.held) >= HELD_DOCS or self.size >= HELD_ENTRIES:
            yield from self.rest()

    def rest(self) -> Batches:
        held = sorted(self.held, key=lambda d: d[0])
        self.held, self.size, start = [], 0, 0
        for stop in range(1, len(held) + 1):
            if stop < len(held):
                size, count = held[stop][0], stop - start
                similar = size <= 2 * held[start][0] or count < 64
                if similar and count < BLOCK_DOCS and size * (count + 1) <= BLOCK_ENTRIES:
                    continue
            yield self._block(held[start:stop])
            start = stop

    @staticmethod
    def _block(documents: list[tuple]) -> pa.RecordBatch:
        _, keys, lengths, entries, watched = zip(*documents, strict=True)
        width, slices = signature(entries)
        terms, df = np.unique(np.concatenate(watched), return_counts=True)
        columns = {
            "keys": pa.array([keys], pa.list_(pa.int64())),
            "lengths": pa.array([lengths], pa.list_(pa.int64())),
            "width": pa.array([width], pa.int64()),
            "slices": pa.array([slices], pa.binary()),
            "terms": pa.array([terms], pa.list_(pa.int64())),
            "df": pa.array([df], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_pydict(columns)


def build_index(docs: DataFrame, queries: Queries | None = None, name: str = "doc_id") -> DataFrame:
    """Blocks (keys, lengths, width, slices, terms, df) over all texts that hold a term, written.

    The signatures serve any query. ``terms`` and ``df`` say how many documents of the block hold
    each term of ``queries``, so that the same reading of the texts also counts those. A document's
    key is a hash of its id; documents that share one are told apart when they are scored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(queries or Queries([]))

    def index(batches: Batches) -> Batches:
        held = Blocks()
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                entries, starts, lengths, hashes, at = _levels(batch.column("text"))
                row, number, _ = shared.value.found(hashes, at)
                first = np.searchsorted(row, np.arange(len(lengths) + 1))
                keys = batch.column("key").to_pylist()
                for k in np.flatnonzero(lengths).tolist():
                    own = entries[starts[k] : starts[k + 1]]
                    yield from held.add(keys[k], int(lengths[k]), own, number[first[k] : first[k + 1]])
        yield from held.rest()

    columns = "keys array<long>, lengths array<long>, width long, slices binary, terms array<long>, df array<long>"
    texts = docs.select(F.xxhash64(name).alias("key"), "text")
    return staged(texts.mapInArrow(index, columns), "signatures")


def weighted(index: DataFrame, queries: Queries) -> Weighted:
    """The queries with their weights; a row of counts per query term reaches the driver."""
    whole = index.agg(
        F.sum(F.size("keys")).alias("n_docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n_terms")
    ).first()
    pairs = index.select(F.explode(F.arrays_zip("terms", "df")).alias("p"))
    df = pairs.groupBy("p.terms").agg(F.sum("p.df").alias("df")).collect()
    return Weighted(queries, whole["n_docs"] or 0, whole["n_terms"] or 0, {r["terms"]: r["df"] for r in df})


def bounds(row: dict, weighted: Weighted, groups: list) -> np.ndarray:
    """items x documents of a block: a number that no score exceeds."""
    keys, lengths = row["keys"], np.array(row["lengths"], np.int64)
    slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
    share = weighted.share(lengths)
    most = np.array([0, *(2 * level - 1 for level in LEVELS[:-1]), np.iinfo(np.int32).max], np.int64)
    part = saturation(np.minimum(most[:, None], lengths), share).astype(np.float64)
    out = np.zeros((len(weighted.queries.ids), len(keys)))
    for first, terms, matrix in groups:
        short = weighted.queries.terms[terms] >> np.uint64(12)
        seen, level = None, np.zeros((len(terms), len(keys)), np.uint8)
        for salt in _LEVEL:
            rows = slices[positions(mix(short ^ salt), row["width"])]
            here = np.bitwise_and.reduce(rows, axis=1)
            seen = here if seen is None else seen & here
            if not seen.any():
                break
            level += np.unpackbits(seen, axis=1, count=len(keys), bitorder="little")
        held = part[level, np.arange(len(keys))]
        # a little more, for the rounding of sums beyond 2**53
        out[first : first + len(matrix)] = matrix.astype(np.float64) @ held * (1 + 1e-9)
    return out


def best_bounds(index: DataFrame, shared, count: int) -> DataFrame:
    """(item, key, bound): of each task's blocks the ``count`` documents of the highest bounds."""

    def pick(batches: Batches) -> Batches:
        weighted, groups, n = shared.value, shared.value.groups(), len(shared.value.queries.ids)
        top, keys = np.zeros((n, 0)), np.zeros((n, 0), np.int64)
        for batch in batches:
            for row in _rows(batch):
                top = np.hstack([top, bounds(row, weighted, groups)])
                keys = np.hstack([keys, np.tile(np.array(row["keys"], np.int64), (n, 1))])
                if top.shape[1] > count:
                    kept = np.argpartition(-top, count, axis=1)[:, :count]
                    top, keys = np.take_along_axis(top, kept, 1), np.take_along_axis(keys, kept, 1)
        item, place = np.nonzero(top)
        yield pa.RecordBatch.from_pydict({"item": item, "key": keys[item, place], "bound": top[item, place]})

    return index.mapInArrow(pick, "item long, key long, bound double")


def candidates(index: DataFrame, shared, bars) -> DataFrame:
    """(key): the documents whose bound reaches the bar of some item."""

    def pick(batches: Batches) -> Batches:
        weighted, groups, bar = shared.value, shared.value.groups(), bars.value[:, None]
        for batch in batches:
            for row in _rows(batch):
                near = (bounds(row, weighted, groups) >= bar).any(axis=0)
                yield pa.RecordBatch.from_pydict({"key": np.array(row["keys"], np.int64)[near]})

    return index.mapInArrow(pick, "key long")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def scored(docs: DataFrame, shared, bars, k: int, id_type: str, item_type: str, name: str = "doc_id") -> DataFrame:
    """(item, item_id, doc_id, score): of each task's texts the ``k`` best of each item, exactly.

    Scores below an item's bar are left out.
    """

    def score(batches: Batches) -> Batches:
        weighted = shared.value
        queries, groups, bar = weighted.queries, weighted.groups(), bars.value.copy()
        top: list[list[tuple]] = [[] for _ in queries.ids]
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                hashes, at = terms_of(batch.column("text"))
                row, number, times = queries.found(hashes, at)
                part = saturation(times, weighted.share(np.diff(at))[row])
                for first, terms, matrix in groups:
                    spot = np.minimum(np.searchsorted(terms, number), len(terms) - 1)
                    mine = terms[spot] == number if len(terms) else np.zeros(len(number), bool)
                    held = np.zeros((len(terms), batch.num_rows), matrix.dtype)
                    held[spot[mine], row[mine]] = part[mine]
                    scores = (matrix @ held).astype(np.int64)
                    item, place = np.nonzero(scores >= bar[first : first + len(scores), None])
                    ids = batch.column(name).take(pa.array(place)).to_pylist()
                    for i, p, d in zip((item + first).tolist(), place.tolist(), ids, strict=True):
                        top[i].append((-int(scores[i - first, p]), d is None, d))
                    for i in np.unique(item + first).tolist():
                        top[i] = sorted(top[i], key=lambda t: (t[0], t[1], 0 if t[1] else t[2]))[:k]
                        if len(top[i]) == k:
                            bar[i] = max(bar[i], -top[i][-1][0])
        rows = [(i, queries.ids[i], d, -s) for i, found in enumerate(top) for s, _, d in found]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        names = ["item", "item_id", "doc_id", "score"]
        kinds = [pa.int64(), item_kind, batch_kind(id_type), pa.int64()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    item_kind = batch_kind(item_type)
    schema = f"item long, item_id {item_type}, doc_id {id_type}, score long"
    return docs.select(name, "text").mapInArrow(score, schema)


def batch_kind(name: str) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(name, pa.int64())


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order: list[Column] = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return best(found, ["item"], order, k, "rank", "doc_id")


def lexical_search(docs: DataFrame, benchmark: DataFrame, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each benchmark text.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z as a-z. With N
    documents that hold a term, L terms in all, n in the document and df documents that hold the
    term, a term of weight floor(1000 ln((2 N + 2) / (2 df + 1))) that occurs tf times counts
    weight * (10**9 tf div (1000 tf + 8 m)) for each occurrence in the item, where m is
    25 + 75 n N div L. Only scores above 0 count; equal ones rank by ascending doc_id, null last.

    Null texts hold nothing. Every row of ``docs`` is a document of its own, also with a doc_id that
    others have. Benchmark rows that repeat id and text count once; others that share an id are
    ranked apart. No rows on either side give no rows; other columns are ignored. Many queries are
    searched for in several passes. Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    ship(spark)
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text")
    out = None
    for items in blocks(benchmark, query_bytes):
        found = _search(texts, Queries(items), k, *kinds)
        out = found if out is None else out.union(found)
    return out


def _search(docs: DataFrame, queries: Queries, k: int, id_type: str, item_type: str) -> DataFrame:
    spark = docs.sparkSession
    index = build_index(docs, queries)
    shared = spark.sparkContext.broadcast(weighted(index, queries))
    keyed = docs.withColumn("key", F.xxhash64("doc_id"))

    def survivors(keys: DataFrame, words: int) -> DataFrame:
        kept = staged(key_filter(keys, "key", words), "search-filter")
        return maybe_in(keyed, "key", kept, words).filter("maybe")

    low = spark.sparkContext.broadcast(np.ones(len(queries.ids), np.int64))
    likely = best(best_bounds(index, shared, 2 * k), ["item"], [F.col("bound").desc(), "key"], 2 * k, "place", "key")
    first = _ranked(scored(survivors(likely, FIRST_WORDS), shared, low, k, id_type, item_type), k)
    bar = np.ones(len(queries.ids), np.int64)
    for row in first.filter(F.col("rank") == k).select("item", "score").collect():
        bar[row["item"]] = row["score"]
    bars = spark.sparkContext.broadcast(bar)
    near = survivors(candidates(index, shared, bars), ALL_WORDS)
    return _ranked(scored(near, shared, bars, k, id_type, item_type), k).select("item_id", "rank", "doc_id", "score")
