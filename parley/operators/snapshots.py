"""Repeated polls of the same records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.rows import best


def dedup_records(df: DataFrame, key: str = "id", order: str = "timestamp") -> DataFrame:
    """The earliest row per key."""
    return _best(df, key, F.col(order).asc_nulls_last(), ascending=True)


def latest_snapshot(df: DataFrame, key: str = "id", ingested: str = "ingest_ts") -> DataFrame:
    """The newest row per key."""
    return _best(df, key, F.col(ingested).desc_nulls_last(), ascending=False)


def _best(df: DataFrame, key: str, order, ascending: bool) -> DataFrame:
    """One row per key; ties settled by the other columns so that a re-run picks the same row."""
    rest = [F.col(c) for c in df.columns if c != key]
    ties = [c.asc() if ascending else c.desc() for c in rest]
    return best(df, [key], [order, *ties], 1, "_place", key).drop("_place")
