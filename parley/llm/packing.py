"""Variable-capacity best-fit packing of documents into training sequences.

Documents are cut into pieces of at most the largest permitted length. Pieces are dealt by hash into
groups of even, bounded size, and each group is packed by best fit, longest piece first: a piece
goes to the open bin that it fills best; when none has room, the bin size with the least cost for
what it can be expected to hold is opened. At the end every bin shrinks to the smallest permitted
length that holds its contents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import tokens
from parley.llm.common import ship
from parley.llm.token_counts import VOCABULARY, token_counts
from parley.session import staged

SIZES = (512, 1024, 2048, 4096)
#: What a sequence costs besides its length, in tokens.
OVERHEAD = 32
#: Pieces packed together, on average.
GROUP = 8192


def pack_group(lengths: np.ndarray, sizes: Sequence[int], overhead: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it, bin size) of each piece; ``lengths`` fall from first to last.

    Open bins are found by free room: bit r of ``rooms`` says that ``by_room[r]`` holds a bin.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    capacity: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    rising = -lengths
    left = np.append(np.cumsum(lengths[::-1])[::-1], 0)  # what this piece and all later ones hold
    for i, length in enumerate(lengths.tolist()):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            b, best = len(used), None
            for size in sizes:
                if size >= length:
                    supply = left[max(i + 1, int(np.searchsorted(rising, length - size)))]
                    price = (size + overhead) / (length + min(size - length, int(supply)))
                    if best is None or price < best[0]:
                        best = (price, size)
            used.append(0)
            capacity.append(best[1])
            room = best[1]
        bins[i], offsets[i] = b, used[b]
        used[b] += length
        if room > length:
            by_room.setdefault(room - length, []).append(b)
            rooms |= 1 << (room - length)
    small = np.array(sizes, np.int64)
    final = small[np.searchsorted(small, np.array(used, np.int64))] if used else small[:0]
    return bins, offsets, final[bins]


def pack(lengths: DataFrame, sizes: Sequence[int] = SIZES, overhead: int = OVERHEAD, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_offset, bin_size): where each piece lies.

    ``lengths``: (doc_id, n_tokens), one row a document. A document of more than the largest size is
    cut into pieces of that size and a rest; ``start`` is the piece's first token in its document.
    A document without tokens (null count as 0) has one row of length 0 and no bin. Rows that share
    a doc_id are packed as documents of their own. No rows give no rows. Bins don't depend on row
    order as long as doc_ids are unique.
    """
    sizes = sorted(set(sizes))
    ship(lengths.sparkSession)
    most = F.lit(sizes[-1]).cast("long")
    n = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0).cast("long"))
    last = F.greatest(F.ceil(F.col("n") / most) - 1, F.lit(0))
    pieces = staged(
        lengths.select("doc_id", n.alias("n"), F.monotonically_increasing_id().alias("row_id"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("start", F.col("piece") * most)
        .withColumn("length", F.least(F.col("n") - F.col("start"), most))
        .drop("n"),
        "packing-pieces",
    )
    full = pieces.filter("length > 0")
    groups = max(1, -(-full.count() // group))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(rows: pa.Table) -> pa.Table:
        tokens.forget()  # what counting tokens has left in the worker
        # Arrow and not pandas: there a null among the ids would turn all of them into floats
        order = [(c, "ascending") for c in ("doc_id", "piece", "row_id")]
        rows = rows.sort_by([("length", "descending"), *order])
        bins, offsets, size = pack_group(rows["length"].to_numpy(), sizes, overhead)
        bins += rows["dealt"].to_numpy().astype(np.int64) << 32
        rows = rows.select(["doc_id", "piece", "start", "length"])
        for name, values in (("bin_id", bins), ("bin_offset", offsets), ("bin_size", size)):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows

    packed = (
        full.withColumn("dealt", F.pmod(F.xxhash64("doc_id", "piece", "row_id"), F.lit(groups)))
        .groupBy("dealt")
        .applyInArrow(
            run, f"doc_id {kind}, piece long, start long, length long, bin_id long, bin_offset long, bin_size long"
        )
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_offset", "bin_size")]
    return packed.union(pieces.filter("length = 0").select("doc_id", "piece", "start", "length", *none))


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, **options) -> DataFrame:
    """``pack`` over the token counts of whole texts."""
    return pack(token_counts(docs, vocabulary).select("doc_id", "n_tokens"), **options)
