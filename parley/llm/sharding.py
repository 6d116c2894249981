"""Sharding: a histogram sort on the text's hash, equal texts together, shards even in bytes.

Splitters between shards are found by counting exact bytes below candidate keys: a histogram over
the leading bits of the key, then over the next bits of those buckets in which a splitter falls,
until every splitter is within the tolerance. Then rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm.common import whole_text
from parley.session import staged

#: Leading bits of the key counted in a round: a round sends at most 2**BITS rows to the driver.
BITS = 12
#: A text with more than 1 / HEAVY of a shard's bytes is placed by itself: at most shards * HEAVY.
HEAVY = 64
#: Rows of such a text are numbered in so many parts.
PARTS = 64


def fill_level(loads: list[int], free: int) -> list[int]:
    """What each shard takes of ``free`` bytes so that the loads end up as even as they can."""
    level = 0
    for count in range(1, len(loads) + 1):
        low = sorted(loads)[:count]
        level = -(-(sum(low) + free) // count)
        if count == len(loads) or level <= sorted(loads)[count]:
            break
    takes = [max(0, level - x) for x in loads]
    takes[-1 if takes[-1] else takes.index(max(takes))] += free - sum(takes)
    return takes


def splitters(light: DataFrame, wanted: list[int], tolerance: float, bits: int = BITS) -> list[int]:
    """Keys below which ``wanted`` bytes of ``light`` (key, size) lie, each to within ``tolerance``."""
    found: dict[int, int] = {}
    open_: dict[int, list[tuple[int, int]]] = {None: [(i, w) for i, w in enumerate(wanted)]}  # prefix -> targets
    below = {None: 0}
    shift = 64
    while open_:
        step = min(bits, shift)
        shift -= step
        rows = light
        if None not in open_:
            rows = rows.filter(F.shiftright("key", shift + step).isin(list(open_)))
        counted: dict[int, int] = {
            r["bucket"]: r["bytes"]
            for r in rows.groupBy(F.shiftright("key", shift).alias("bucket"))
            .agg(F.sum("size").alias("bytes"))
            .collect()
        }
        next_open, next_below = {}, {}
        for prefix, targets in open_.items():
            total = below[prefix]
            buckets = sorted(b for b in counted if prefix is None or b >> step == prefix)
            left = sorted(targets, key=lambda t: t[1])
            for b in buckets:
                high = total + counted[b]
                while left and left[0][1] <= high:
                    i, want = left.pop(0)
                    if want - total <= tolerance or (shift == 0 and want - total <= high - want):
                        found[i] = b << shift
                    elif high - want <= tolerance or shift == 0:
                        found[i] = (b + 1) << shift
                    else:
                        next_open.setdefault(b, []).append((i, want))
                        next_below[b] = total
                total = high
            for i, _ in left:  # beyond the last key
                found[i] = 1 << 63
        open_, below = next_open, next_below
    return [found[i] for i in range(len(wanted))]


def shard(docs: DataFrame, shards: int = 16, tolerance: float = 1e-3) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1). The law is ``bytes``: shards hold nearly
    the same sum of sizes, and rows of one text (null and empty are one) share a shard, even where
    that text alone outweighs an even shard. ``slot`` counts from 0 in a shard without gaps, by key
    and doc_id (nulls first; rows that agree in both follow in any order). ``tolerance`` is the
    share of an even shard by which a splitter may miss. No rows give no rows; other columns of
    ``docs`` are ignored.
    """
    text = whole_text()
    rows = staged(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
        ),
        "shard-keys",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = {
        r["key"]: r["bytes"]
        for r in rows.groupBy("key")
        .agg(F.sum("size").alias("bytes"))
        .filter(F.col("bytes") > total / (shards * HEAVY))
        .collect()
    }
    loads, home = [0] * shards, {}
    for key, size in sorted(heavy.items(), key=lambda x: (-x[1], x[0])):
        home[key] = loads.index(min(loads))
        loads[home[key]] += size
    takes = fill_level(loads, total - sum(loads))
    wanted = [sum(takes[: i + 1]) for i in range(shards - 1)]
    is_heavy = F.col("key").isin(list(home)) if home else F.lit(False)
    light = rows.filter(~is_heavy).select("key", "size")
    cuts = splitters(light, wanted, tolerance * total / shards) if total else []
    placed = rows.withColumns(
        {
            "shard": _place(cuts, home, is_heavy),
            "bucket": F.shiftright("key", 64 - BITS),
            "part": F.when(is_heavy, F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) + 1).otherwise(0),
        }
    ).withColumn("text", F.when(is_heavy, F.col("key")).otherwise(0))
    cell = ["shard", "bucket", "text", "part"]
    before = Window.partitionBy("shard").orderBy("bucket", "text", "part")
    starts = (
        placed.groupBy(*cell)
        .agg(F.count("*").alias("n"))
        .withColumn("start", F.sum("n").over(before) - F.col("n"))
        .drop("n")
    )
    inside = Window.partitionBy(*cell).orderBy("key", "doc_id")
    return placed.join(starts, cell).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.row_number().over(inside) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _place(cuts: list[int], home: dict[int, int], is_heavy: Column) -> Column:
    at = F.lit(0)
    for cut in cuts:
        at = at + (F.col("key") >= F.lit(cut)).cast("int") if cut < 1 << 63 else at
    if not home:
        return at
    homes = F.create_map(*[F.lit(x) for pair in home.items() for x in pair])
    return F.when(is_heavy, F.try_element_at(homes, F.col("key"))).otherwise(at)


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes ``docs`` under ``path``, a folder for each shard. Needs unique doc_ids."""
    where = placed.select("doc_id", "shard")
    docs.drop("shard").join(where, "doc_id").write.partitionBy("shard").parquet(path)
