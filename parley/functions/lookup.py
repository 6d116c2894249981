"""Word dictionaries applied to token arrays.

A mapping becomes one literal in the plan, so no shuffle and no row key are needed and the same
expression runs on streams. A DataFrame is joined with the words that occur, whatever its size; a
stream does that batch by batch (``live.score_batches``). ``small`` turns a table of known size into a mapping.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.rows import each
from parley.session import shuffles_freed, staged

SMALL = 50_000
#: Parts that a word's occurrences are dealt into before they meet the dictionary.
SALTS = 8

Dictionary = Mapping[str, object] | DataFrame


def small(table: DataFrame, most: int = SMALL) -> dict:
    """A dictionary table as a mapping; an error when it has more than ``most`` words.

    The word is in the first column and the value in the second; a word listed twice keeps its
    smallest value. At most ``most + 1`` rows reach the driver.
    """
    rows = _unique_words(table).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words: pass the table itself, which is joined")
    return {r["word"]: r["value"] for r in rows}


def _unique_words(table: DataFrame) -> DataFrame:
    word, value = table.columns[:2]
    return (
        table.filter(F.col(word).isNotNull())
        .groupBy(F.col(word).alias("word"))
        .agg(F.min(value).alias("value"))
    )


def inline_lookup(entries: Mapping[str, object], value_type: str) -> Callable[[Column], Column]:
    """Token -> value (null when absent), from a literal array of small maps.

    Spark scans a map from end to end, so the entries are spread over as many maps as there are
    words and the checksum of the word picks the map.
    """
    count = max(1, len(entries))
    spread: list[dict] = [{} for _ in range(count)]
    for word, value in entries.items():
        spread[zlib.crc32(word.encode("utf-8")) % count][word] = value
    maps = F.from_json(F.lit(json.dumps(spread)), f"array<map<string,{value_type}>>")

    def find(token: Column) -> Column:
        slot = (F.crc32(token) % F.lit(count)).cast("int")
        return F.try_element_at(F.get(maps, slot), token)

    return find


def join_lookup(
    df: DataFrame, tokens: str, dictionary: DataFrame, out: str, value_type: str
) -> DataFrame:
    """Adds ``out``, the array of dictionary values (null when absent) aligned with ``tokens``.

    The distinct words of all rows meet the dictionary first. Up to ``SMALL`` that both hold are looked
    up inside the row: neither the rows nor their tokens are exchanged or written. Otherwise the
    occurrences of words are joined.
    """
    words = each(df, "word", F.col(tokens)).distinct()
    known = words.join(_unique_words(dictionary), "word").select("word", F.col("value").cast(value_type))
    with shuffles_freed(df.sparkSession):
        rows = known.limit(SMALL + 1).collect()
    if len(rows) > SMALL:
        return _joined(df, tokens, dictionary, out, value_type)
    find = inline_lookup({r["word"]: r["value"] for r in rows}, value_type)
    return df.withColumn(out, F.transform(tokens, find))


def _joined(df: DataFrame, tokens: str, dictionary: DataFrame, out: str, value_type: str) -> DataFrame:
    """``join_lookup`` by a join of all occurrences.

    Rows are written once with a number of their own, so copies of one text don't meet in one task.
    Each task's tokens are cut down to distinct words before they meet the dictionary, and only
    words that it holds come back: a copy for each part of their occurrences, so that a word that
    every text holds doesn't fill one task.
    """
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "lookup-rows")
    salt = F.pmod("_row", F.lit(SALTS)).cast("int").alias("salt")
    exploded = rows.select("_row", salt, F.posexplode(tokens).alias("pos", "word"))
    known = exploded.select("word").distinct().join(_unique_words(dictionary), "word")
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = (
        exploded.join(known, ["word", "salt"])
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", "value"))).alias("_found"))
    )
    places = F.sequence(F.lit(0), F.size(tokens) - 1)
    values = F.transform(places, lambda i: F.try_element_at("_found", i).cast(value_type))
    nothing = F.transform(tokens, lambda t: F.lit(None).cast(value_type))
    value = F.when((F.size(tokens) > 0) & F.col("_found").isNotNull(), values).otherwise(nothing)
    return rows.join(found, "_row", "left").withColumn(out, value).drop("_row", "_found")


def map_tokens(
    df: DataFrame,
    tokens: str,
    dictionary: Dictionary,
    out: str,
    value_type: str,
    body: Callable[[Column, Column], Column],
) -> DataFrame:
    """Adds ``out``: ``body(token, value)`` of each token, the value null where absent."""
    if isinstance(dictionary, Mapping):
        find = inline_lookup(dictionary, value_type)
        return df.withColumn(out, F.transform(tokens, lambda t: body(t, find(t))))
    found = join_lookup(df, tokens, dictionary, "_value", value_type)
    return found.withColumn(out, F.zip_with(tokens, "_value", body)).drop("_value")
