"""Arrays to rows, columns that are computed once, and the best rows of each group.

Spark pushes a filter on a computed column below the computation, which repeats it, and derives
such a filter from every explode. That is free for cheap columns and doubles the work for parsed
JSON, regular expressions or token arrays. An outer explode has no such filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, computed once per row whatever is filtered on it later."""
    return df.withColumn(name, F.explode_outer(F.array(value)))


def each(df: DataFrame, name: str, array: Column, *keep: Column | str) -> DataFrame:
    """The ``keep`` columns and ``name``, one row per element that is not null."""
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


SALTS = 16


def best(
    df: DataFrame, group: Sequence[str], order: Sequence, k: int, place: str, spread_by: str
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered in ``place``.

    The groups are first cut in ``SALTS`` parts by the hash of ``spread_by``, so that no task sorts
    more than a part of a group. Up to a certain k Spark also cuts every map task's rows to k per
    part before it shuffles them.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    df = _first_rows(salted, [*group, "_salt"], order, k, "_place").drop("_salt", "_place")
    return _first_rows(df, group, order, k, place)


def _first_rows(df: DataFrame, group: Sequence[str], order: Sequence, k: int, place: str):
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(place, rank).filter(F.col(place) <= k)
