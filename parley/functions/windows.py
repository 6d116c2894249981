"""Sliding windows counted through panes.

A pane is the widest interval that lies wholly inside or outside every window. Aggregating per
pane first means each row is hashed once; only the pane totals are copied into the size/slide
windows that cover them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.session import staged

UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """Seconds in a duration such as ``"60 seconds"`` or ``"6 hours"``."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not found or found.group(2) not in UNIT_SECONDS or int(found.group(1)) == 0:
        raise ValueError(f"not a window duration: {text!r}")
    return int(found.group(1)) * UNIT_SECONDS[found.group(2)]


def pane_width(size: str, slide: str) -> str:
    return f"{math.gcd(duration_seconds(size), duration_seconds(slide))} seconds"


def pane(ts: Column | str, size: str, slide: str) -> Column:
    """Start of the pane that holds ``ts``."""
    return F.window(ts, pane_width(size, slide))["start"]


def window_starts(ts: Column | str, size: str, slide: str) -> Column:
    """Start of each window over ``ts``, one row per window; also right for a pane start, which
    stands for its whole pane. A start is all that grouping needs; ``bounds`` adds the end."""
    return F.window(ts, size, slide)["start"]


def bounds(size: str, start: str = "window_start") -> list[Column]:
    """(window_start, window_end) columns."""
    end = F.col(start) + F.expr(f"INTERVAL {duration_seconds(size)} seconds")
    return [F.col(start).alias("window_start"), end.alias("window_end")]


def block(ts: Column | str, size: str) -> Column:
    """Start of the window-sized stretch of time that holds ``ts``."""
    return F.window(ts, f"{duration_seconds(size)} seconds")["start"]


def with_blocks(df: DataFrame, size: str, slide: str) -> DataFrame:
    """Adds ``block``: one row for each of the one or two blocks that a row's window reaches into."""
    first = F.col("window_start")
    last_pane = F.expr(
        f"INTERVAL {duration_seconds(size)} seconds - INTERVAL {pane_width(size, slide)}"
    )
    ends = F.array_distinct(F.array(first, first + last_pane))
    edges = df.withColumn("_edge", F.explode(ends))
    blocks = edges.withColumn("block", block("_edge", size))
    return blocks.filter((F.col("_edge") == first) | (F.col("block") > first)).drop("_edge")


def _in_windows(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Adds ``window_start``: a row for each window over ``pane`` that starts in ``block``.

    As ``window_starts``, which makes Spark forget how rows were dealt; an explode doesn't.
    """
    width, step = (F.expr(f"INTERVAL {duration_seconds(d)} seconds") for d in (size, slide))
    back = (-(-duration_seconds(size) // duration_seconds(slide)) - 1) * duration_seconds(slide)
    last = F.window("pane", f"{duration_seconds(slide)} seconds")["start"]
    starts = F.sequence(last - F.expr(f"INTERVAL {back} seconds"), last, step)
    start, block_start = F.col("window_start"), F.col("block")
    over = (start + width > F.col("pane")) & (start >= block_start) & (start < block_start + width)
    return panes.withColumn("window_start", F.explode(starts)).filter(over)


def window_totals(
    panes: DataFrame, keys: Sequence[str], totals: Sequence[Column], size: str, slide: str
) -> DataFrame:
    """(window_start, keys.., totals..) of every window, from rows of panes (pane, keys.., ..).

    A window starts in the block of each of its panes or in the block before. So two copies of a
    row are exchanged and not one for every window over it; windows are told apart where they meet.
    """
    width = F.expr(f"INTERVAL {duration_seconds(size)} seconds")
    own = panes.withColumn("block", block("pane", size))
    both = own.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") - width)))
    dealt = _in_windows(both.repartition("block", *keys), size, slide)
    return dealt.groupBy("block", *keys, "window_start").agg(*totals).drop("block")


def dealt_stretches(
    panes: DataFrame, key: str, size: str, blocks: int, most_rows: int
) -> DataFrame:
    """``panes`` (pane, key, ..) with ``stretch`` and ``part``, dealt by both.

    A stretch is ``blocks`` window sizes of time. It holds the panes of all windows that start in it, so
    rows of its first window size go to the stretch before as well. A stretch of more than
    ``most_rows`` rows is cut in parts by the hash of ``key``, and rows of an empty key go to each of
    them; others have the part -1. ``panes`` is read twice.
    """
    seconds = duration_seconds(size)
    length = F.expr(f"INTERVAL {blocks * seconds} seconds")
    own = panes.withColumn("stretch", block("pane", f"{blocks * seconds} seconds"))
    first, last = F.col("stretch"), F.col("pane") - F.expr(f"INTERVAL {seconds} seconds")
    before = F.when(last < first, F.array(first, first - length)).otherwise(F.array(first))
    both = own.withColumn("stretch", F.explode(before))
    sizes = both.groupBy("stretch").agg(F.count("*").alias("rows"))
    parts = F.ceil(F.col("rows") / most_rows).cast("int").alias("parts")
    large = staged(sizes.filter(F.col("rows") > most_rows).select("stretch", parts), "large-stretches")
    sized = both.join(F.broadcast(large), "stretch", "left")
    hashed = F.array(F.pmod(F.xxhash64(key), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    part = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).when(F.col(key) == "", every).otherwise(hashed)
    tasks = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sized.withColumn("part", F.explode(part)).drop("parts").repartition(tasks, "stretch", "part")
