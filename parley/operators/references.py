"""User, community and link references in texts, and how often each occurs per window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import windows as win
from parley.functions.rows import each

# What counts as a reference.
PATTERNS = {
    "user": r"/u/(\w+)",
    "community": r"/r/(\w+)",
    "url": r"(http\S+)",
}


def _found(text: Column | str, kind: str, mode: str) -> Column:
    """array<struct<kind, reference>> of one kind: the first match, or every match."""
    if mode == "first":
        matches = F.array(F.regexp_extract(text, PATTERNS[kind], 0))
    elif mode == "all":
        matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    else:
        raise ValueError(f"mode is 'first' or 'all', not {mode!r}")
    return F.transform(matches, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("reference")))


def all_refs(
    df: DataFrame,
    text: str = "text",
    ts: str = "timestamp",
    mode: str = "first",
    kinds: tuple[str, ...] = tuple(PATTERNS),
) -> DataFrame:
    """(ts, kind, reference), one row per hit; the text is read once for all kinds.

    By default only the first match of each kind counts, as a text that names a user twice is one
    mention. A link that contains ``/r/x`` yields both a link and a community.
    """
    hits = F.concat(*[_found(text, kind, mode) for kind in kinds])
    return (
        each(df, "hit", hits, ts)
        .select(ts, "hit.kind", "hit.reference")
        .filter(F.col("reference") != "")
    )


def user_refs(df: DataFrame, text: str = "text", mode: str = "first") -> DataFrame:
    return _one_kind(df, text, "user", mode)


def community_refs(df: DataFrame, text: str = "text", mode: str = "first") -> DataFrame:
    return _one_kind(df, text, "community", mode)


def url_refs(df: DataFrame, text: str = "text", mode: str = "first") -> DataFrame:
    return _one_kind(df, text, "url", mode)


def _one_kind(df: DataFrame, text: str, kind: str, mode: str) -> DataFrame:
    """All input columns plus ``reference``, for the texts that have one."""
    return (
        each(df, "hit", _found(text, kind, mode), *df.columns)
        .withColumn("reference", F.col("hit.reference"))
        .drop("hit")
        .filter(F.col("reference") != "")
    )


def windowed_ref_counts(
    df: DataFrame,
    size: str = "60 seconds",
    slide: str = "5 seconds",
    ts: str = "timestamp",
    text: str = "text",
    mode: str = "first",
    nested: bool = False,
) -> DataFrame:
    """(window_start, window_end, reference, count) over sliding windows.

    ``nested`` keeps the window as one struct column.
    """
    refs = all_refs(df, text, ts, mode)
    per_pane = refs.groupBy(win.pane(ts, size, slide).alias("pane"), "reference").agg(
        F.count("*").alias("n")
    )
    totals = win.window_totals(per_pane, ["reference"], [F.sum("n").alias("count")], size, slide)
    counts = totals.select(*win.bounds(size), "reference", "count")
    if not nested:
        return counts
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    return counts.select(window.alias("window"), "reference", "count")
