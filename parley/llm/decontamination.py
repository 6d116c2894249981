"""Benchmark decontamination: q-gram counts in diagonal bands, then banded alignment.

Benchmark texts are cut into windows. A window of m characters that occurs in a document with at
most e edits shares at least m - q + 1 - q * e q-grams with it, all within e + 1 neighbouring
diagonals (document position less window position). Hits are counted in bands of diagonals that
overlap by half; bands with enough hits are aligned, within the band only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import tokens
from parley.llm.common import ship
from parley.llm.shingles import string_bytes

Q = 16
#: Shorter windows are counted in shorter q-grams, as 5 % of edits would leave them no long one.
SHORT_Q, SHORT_WINDOW = 8, 64
LEAST = 16
WINDOW = 100
EDIT_PERCENT = 5
#: Text of benchmark items that is searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
#: Bytes of documents whose q-grams are looked up at a time.
SEGMENT = 4 << 20
#: Bands aligned at a time.
ALIGNED = 512
_K = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32
_TABLE_BITS = 22


def normal(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in lower case, runs of ASCII other than letters and digits as one blank."""
    data, offsets = string_bytes(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    data = _PLAIN[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def gram_keys(data: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` (8 or 16) bytes from each position on."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    if q == SHORT_Q:
        return words * _K[0]
    return words[: len(data) - q + 1] * _K[0] ^ (words[8:] * _K[1])


class Windows:
    """Windows of benchmark texts, all long or all short, and the places of their q-grams."""

    def __init__(
        self, items: list[tuple], short: bool = False, window: int = WINDOW, percent: int = EDIT_PERCENT
    ) -> None:
        self.q = SHORT_Q if short else Q
        self.items: list[object] = []
        starts, lengths, texts = [], [], []
        data, offsets = normal(pa.array([t for _, t in items], pa.large_string()))
        for (item, _), a, b in zip(items, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            while a < b and data[a] == 32:
                a += 1
            while a < b and data[b - 1] == 32:
                b -= 1
            if b - a < LEAST or (b - a < SHORT_WINDOW) != short:
                continue
            cuts = [*range(a, max(a + 1, b - window), window // 2)]
            if b - a > window and cuts[-1] < b - window:
                cuts.append(b - window)
            for cut in cuts:
                self.items.append(item)
                starts.append(cut - a)
                texts.append(data[cut : min(cut + window, b)])
                lengths.append(len(texts[-1]))
        self.start, self.length = np.array(starts, np.int64), np.array(lengths, np.int64)
        self.edits = self.length * percent // 100
        self.least = self.length - self.q + 1 - self.q * self.edits
        self.text = np.zeros((len(texts), max(lengths, default=0)), np.uint8)
        for i, t in enumerate(texts):
            self.text[i, : len(t)] = t
        keys = [gram_keys(t, self.q) for t in texts]
        flat = np.concatenate([*keys, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        place = np.concatenate([*(np.arange(len(k)) for k in keys), np.zeros(0, np.int64)])
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.keys, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.keys >> np.uint64(64 - _TABLE_BITS)] = True
        self.band = 1 << int(max(self.edits.max(initial=0), 7)).bit_length()

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, window, edits) of each window found within its budget in each text."""
        data, offsets = normal(texts)
        none = np.zeros(0, np.int64)
        if not len(self.keys):
            return none, none, none
        parts = [self._hits(data[i : i + SEGMENT + self.q - 1]) for i in range(0, len(data), SEGMENT)]
        at = np.concatenate([none, *(a + i * SEGMENT for i, (a, _) in enumerate(parts))])
        spot = np.concatenate([none, *(s for _, s in parts)])
        row = np.searchsorted(offsets, at, side="right") - 1
        whole = at + self.q <= offsets[row + 1]
        at, spot, row = at[whole], spot[whole], row[whole]
        if not len(at):
            return none, none, none
        times = self.count[spot]
        entry = np.repeat(self.first[spot] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        window = self.owner[entry]
        row, diagonal = np.repeat(row, times), np.repeat(at, times) - self.place[entry]
        band = diagonal // self.band
        hits = np.stack([np.tile(row, 2), np.tile(window, 2), np.concatenate([band, band - 1])], axis=1)
        hits = hits[np.lexsort(hits.T[::-1])]
        new = np.flatnonzero(np.concatenate([[True], (hits[1:] != hits[:-1]).any(axis=1)]))
        enough = np.diff(np.append(new, len(hits))) >= self.least[hits[new, 1]]
        row, window, band = hits[new[enough]].T
        turns = range(0, len(row), ALIGNED)
        parts = [slice(i, i + ALIGNED) for i in turns]
        edits = np.concatenate([none, *(self._align(data, offsets, row[p], window[p], band[p]) for p in parts)])
        good = edits <= self.edits[window]
        return row[good], window[good], edits[good]

    def _hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where q-grams of the benchmark begin, and which they are."""
        keys = gram_keys(data, self.q)
        at = np.flatnonzero(self.table[keys >> np.uint64(64 - _TABLE_BITS)])
        spot = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        sure = self.keys[spot] == keys[at]
        return at[sure], spot[sure]

    def _align(
        self, data: np.ndarray, offsets: np.ndarray, row: np.ndarray, window: np.ndarray, band: np.ndarray
    ) -> np.ndarray:
        """The least edits of each window against the text around its band of diagonals."""
        slack = int(self.edits.max())
        width = 2 * self.band + 2 * slack
        origin = band * self.band - slack
        longest = int(self.length[window].max())
        place = origin[:, None] + np.arange(width + longest)
        inside = (place >= offsets[row][:, None]) & (place < offsets[row + 1][:, None])
        text = np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0)
        step = np.arange(width)
        cost = np.zeros((len(row), width), np.int64)
        best = np.zeros(len(row), np.int64)
        for i in range(longest):
            change = cost + (text[:, i : i + width] != self.text[window, i][:, None])
            change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(change - step, axis=1) + step
            done = self.length[window] == i + 1
            if done.any():
                best[done] = cost[done].min(axis=1)
        return best


def windows_of(items: list[tuple]) -> list[Windows]:
    """The items' windows: long ones, and short ones if there are any."""
    both = [Windows(items, short) for short in (False, True)]
    return [w for w in both if w.items]


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """(item_id, text) of the benchmark in parts of about ``block_bytes``, each sent as a whole."""
    known = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    for i in range(count):
        part = F.pmod(F.xxhash64("text"), F.lit(count)) == i
        yield sorted(map(tuple, known.filter(part).distinct().collect()), key=str)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, windows, edits): which benchmark texts each document holds.

    Case, punctuation and white space don't count. ``windows`` is how many of the item's windows
    (100 characters, half overlapping; a shorter item is one) occur with at most 5 % edits, and
    ``edits`` the fewest of any. Null texts hold nothing; benchmark texts under 16 characters can't
    be told from chance and are skipped. Rows that share a doc_id count as one document, null ids
    too; no rows or no items give no rows; other columns are ignored. A large benchmark is searched
    for in several passes over ``docs``.
    """
    spark = docs.sparkSession
    ship(spark)
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    found = None
    for items in blocks(benchmark, block_bytes):
        part = _search(docs.select("doc_id", "text"), spark.sparkContext.broadcast(windows_of(items)), *kinds)
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(F.sum("windows").alias("windows"), F.min("edits").alias("edits"))


def _search(docs: DataFrame, shared, doc_kind: str, item_kind: str) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                best: dict[tuple, list] = {}
                for index in shared.value:
                    row, window, edits = index.find(batch.column("text"))
                    for r, w, e in zip(row.tolist(), window.tolist(), edits.tolist(), strict=True):
                        seen = best.setdefault((r, index.items[w]), [set(), e])
                        seen[0].add((index.q, w))
                        seen[1] = min(seen[1], e)
                rows = [(r, item, len(ws), e) for (r, item), (ws, e) in best.items()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([r[1] for r in rows], item_type),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.int64()),
                    ],
                    ["doc_id", "item_id", "windows", "edits"],
                )

    schema = f"doc_id {doc_kind}, item_id {item_kind}, windows long, edits long"
    item_type = pa.string() if item_kind == "string" else pa.int32() if item_kind == "int" else pa.int64()
    return docs.mapInArrow(search, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark text, by the rules of ``contaminated``."""
    spark = docs.sparkSession
    ship(spark)
    for items in blocks(benchmark, block_bytes):
        docs = _without(docs, spark.sparkContext.broadcast(windows_of(items)))
    return docs


def _without(docs: DataFrame, shared) -> DataFrame:
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                clean = np.ones(batch.num_rows, bool)
                for index in shared.value:
                    clean[index.find(batch.column("text"))[0]] = False
                yield batch.filter(pa.array(clean))

    return docs.mapInArrow(pick, docs.schema)
