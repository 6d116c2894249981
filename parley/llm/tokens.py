"""Tokenising whole texts by pieces that the tokenizer can't join.

A text is split where the tokenizer always splits, equal pieces of a batch are looked up once, and
only pieces not seen before are encoded, in library calls of even size. Counts and ids are those of
the library for the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parley.llm.shingles import string_bytes

#: Text handled at a time, and text given to the library in one call.
BATCH_BYTES = 4 << 20
CALL_BYTES = 256 << 10
#: Pieces remembered by a worker; beyond that it keeps those that it met again.
PIECES = 500_000

#: A blank or line end next to white space, or the mark used for splitting.
_UNSAFE = "[\\s\\pZ\\x{85}\\x0b\\x1c-\\x1f][ \\n]|[ \\n][\\s\\pZ\\x{85}\\x0b\\x1c-\\x1f]|\\x00"
#: A sign that ends a word: no byte-level pattern joins it to a letter or digit before it.
_ENDED = "([A-Za-z0-9])([.,;:!?])(\\x{00}|$)"
_SAFE = re.compile(r"(?<=[^\s\x00-\x20])(?=[ \n][^\s\x00-\x20])")


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most`` bytes; a longer text goes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def blank_kept(texts: pa.Array) -> pa.ListArray:
    """Pieces that start with their blank or line end, for byte-level patterns.

    Such a pattern joins a blank only to what follows it, so a cut between a visible character and a
    single blank (or line end) before another visible character is a token boundary. So is one before
    the sign that ends a word, and words without it repeat more often.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    marked = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
    marked = pc.replace_substring_regex(marked, _ENDED, "\\1\x00\\2\\3")
    unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
    if not unsafe.any():
        return pc.split_pattern(marked, "\x00")
    where = np.flatnonzero(unsafe)
    slow = pa.array([_SAFE.split(t) for t in texts.take(pa.array(where)).to_pylist()], pa.large_list(pa.large_string()))
    fast = pc.split_pattern(pc.if_else(pa.array(unsafe), "", marked), "\x00").cast(slow.type)
    order = np.arange(len(texts))
    order[where] = len(texts) + np.arange(len(where))
    return pa.concat_arrays([fast, slow]).take(pa.array(order))


def _kinds() -> np.ndarray:
    """What each byte is: 0 blank or line end, 1 letter, 2 digit, 3 another sign, 4 left alone."""
    kinds = np.full(256, 4, np.uint8)
    kinds[0x21:0x7F] = 3
    kinds[[0x20, 0x0A]] = 0
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, *range(0x80, 0xC0)]] = 1
    kinds[0x30:0x3A] = 2
    kinds[0x27] = 4
    return kinds


_KIND = _kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def letter_runs(texts: pa.Array) -> pa.LargeListArray:
    """Pieces that a vocabulary of lower-case letter runs never joins, in lower case.

    Such a pattern drops white space and takes runs of letters, single digits and runs of other
    signs; only an apostrophe joins them. So text of ASCII and Latin-1 letters is cut there. What
    lies between blanks and holds anything else (an apostrophe, a special token, other scripts,
    signs that compose) is one piece as it stands, and left to the library.
    """
    data, offsets = string_bytes(texts)
    kind = _KIND[data]
    after = np.concatenate([np.zeros(1, np.uint8), data[:-1]])  # the byte before each
    kind[(after == 0xC3) & ((data == 0x97) | (data == 0xB7))] = 4
    kind[(after == ord("<")) & (data == ord("|"))] = 4
    kept = kind != 0
    first = kept.copy()
    first[1:] &= ~kept[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = kept[edges]
    places = np.concatenate([[0], np.cumsum(kept)])[offsets]
    data, kind, after, first = data[kept], kind[kept], after[kept], first[kept]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = pa.array([], pa.large_string())
        return pa.LargeListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int64)), none)
    alone = np.logical_or.reduceat(kind == 4, starts)
    plain = ~np.repeat(alone, np.diff(np.append(starts, len(data))))
    cut = kind == 2
    cut[1:] |= kind[1:] != kind[:-1]
    cut = first | (cut & plain)
    capital = (after == 0xC3) & (data >= 0x80) & (data < 0x9F)
    data = np.where(plain, np.where(capital, data + np.uint8(32), _LOWER[data]), data)
    cuts = np.flatnonzero(cut)
    ends = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
    pieces = pa.LargeStringArray.from_buffers(len(cuts), ends, pa.py_buffer(np.ascontiguousarray(data)))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(cuts, places)), pieces)


class Pieces:
    """A worker's memory of encoded pieces: token counts, and ids where they are wanted."""

    def __init__(self, path: str, with_ids: bool, most: int = PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.with_ids, self.most = with_ids, most
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.counts, self.starts = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0
        self.again = np.zeros(1 << 12, bool)

    def _drop_rare(self) -> None:
        """Forgets the pieces that were not met again since they were learned or last kept."""
        kept = np.flatnonzero(self.again[: len(self.known)])
        words = list(self.known)  # in the order of their numbers
        counts, starts, ids = self.counts[kept], self.starts[kept] if self.with_ids else None, self.ids
        self._clear()
        self.known = {words[i]: number for number, i in enumerate(kept.tolist())}
        self.counts, self.again = counts, np.zeros(len(kept), bool)
        if self.with_ids:
            ends = np.cumsum(counts)
            self.used = int(counts.sum())
            self.starts = ends - counts
            self.ids = ids[np.repeat(starts - self.starts, counts) + np.arange(self.used)]

    def _learn(self, new: list[str]) -> None:
        new.sort(key=len)
        for call in _calls(new):
            got = self.tokenizer.encode_batch_fast(call, add_special_tokens=False)
            first = len(self.known)
            counts = np.fromiter(map(len, got), np.int64, len(got))
            self.known.update(zip(call, range(first, first + len(call)), strict=True))
            self.counts = _room(self.counts, first + len(call))
            self.counts[first : first + len(call)] = counts
            if self.with_ids:
                total = int(counts.sum())
                self.starts, self.ids = _room(self.starts, first + len(call)), _room(self.ids, self.used + total)
                self.starts[first : first + len(call)] = self.used + np.cumsum(counts) - counts
                self.ids[self.used : self.used + total] = np.fromiter((i for e in got for i in e.ids), np.uint32, total)
                self.used += total

    def look_up(self, pieces: pa.Array) -> np.ndarray:
        """The number of each piece; pieces are learned as needed."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.known) + len(words) > self.most:
            self._drop_rare()
            if len(self.known) + len(words) > self.most or len(self.known) > self.most // 2:
                self._clear()
        before = len(self.known)
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.again = _room(self.again, len(self.known))
        self.again[numbers[numbers < before]] = True
        return numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    wider = np.zeros(max(size, 2 * len(array)), array.dtype)
    wider[: len(array)] = array
    return wider


def _calls(texts: list[str]) -> Iterator[list[str]]:
    call, size = [], 0
    for t in texts:
        call.append(t)
        size += len(t) + 16
        if size >= CALL_BYTES:
            yield call
            call, size = [], 0
    if call:
        yield call


_WORKER: dict[tuple, Pieces] = {}


def forget() -> None:
    """Frees what a worker remembers, for tasks of other kinds that run in it later."""
    _WORKER.clear()
    pa.default_memory_pool().release_unused()


def pieces_of(name: str, with_ids: bool) -> Pieces:
    """The worker's pieces for a vocabulary file: a path, or the name of a public one."""
    key = (name, with_ids)
    if key not in _WORKER:
        import public_tokenizers

        _WORKER[key] = Pieces(name if os.sep in name else public_tokenizers.path(name), with_ids)
    return _WORKER[key]


def sums(values: np.ndarray, lists: pa.ListArray) -> np.ndarray:
    """The sum of each list's values."""
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)
