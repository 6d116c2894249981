"""Word shingles of whole texts as 64-bit hashes, computed over a batch's bytes at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
SEGMENT = 1 << 19
_SEED = np.random.Generator(np.random.PCG64(20240229))
#: A random value for each byte, A-Z as a-z; white space separates words.
_BYTE = _SEED.integers(0, 1 << 64, 256, np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = int(_SEED.integers(0, 1 << 63, dtype=np.uint64)) * 2 + 1
_PLACE = _SEED.integers(0, 1 << 64, 64, np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < size:
        room = 1 << max(16, (size - 1).bit_length())
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(room, base, np.uint64)
            table[0] = 1
            _POWERS.append(np.multiply.accumulate(table))
    return _POWERS[0][:size], _POWERS[1][:size]


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK
) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and where each text's words begin and the last's end.

    ``blank`` says of each byte whether it separates words; A-Z count as a-z.

    Bytes are handled SEGMENT at a time, cut between words, so a very long text takes little more
    than itself and its words.
    """
    word = ~blank[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = word[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    cuts = np.searchsorted(starts, np.arange(SEGMENT, len(data), SEGMENT)) if len(data) > SEGMENT else []
    hashes = [
        _hashes(data, starts[a:b], stops[a:b])
        for a, b in zip([0, *cuts], [*cuts, len(starts)], strict=True)
        if a < b
    ]
    return np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.searchsorted(starts, offsets)


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    begin, end = int(starts[0]), int(stops[-1])
    power, inverse = _powers(end - begin + 1)
    total = np.zeros(end - begin + 1, np.uint64)
    np.cumsum(_BYTE[data[begin:end]] * power[:-1], out=total[1:])
    hashes = (total[stops - begin] - total[starts - begin]) * inverse[starts - begin]
    return mix(hashes ^ (stops - starts).astype(np.uint64))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; a text of fewer words is one shingle."""
    data, offsets = string_bytes(texts)
    hashes, at = word_hashes(data, offsets)
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * _PLACE[k]
    rolled = mix(rolled)
    for start, stop in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = stop - start
        if n >= words:
            found = np.sort(rolled[start : stop - words + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif n:
            terms = np.append(hashes[start:stop] * _PLACE[:n], _PLACE[words + n])
            yield mix(terms.sum(keepdims=True, dtype=np.uint64))
        else:
            yield rolled[:0]
