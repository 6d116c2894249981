"""What several corpus operators share."""

from __future__ import annotations

import io
import tempfile
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import parley
from parley.session import staged

_SHIPPED: set[str] = set()
#: Rows and bytes that Spark hands to Python at a time, so that whole texts fit beside the heap.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once a session, for functions that run in Python there.

    Arrow batches are kept small: at the default of 10,000 rows whole texts take hundreds of MB.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if (app := spark.sparkContext.applicationId) not in _SHIPPED:
        root = Path(parley.__file__).parent
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        path = Path(tempfile.mkdtemp(prefix="parley-code-")) / "parley-code.zip"
        path.write_bytes(data.getvalue())
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED.add(app)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


#: 64-bit words of a key filter, whatever the number of keys, and how many of them are one row: a
#: broadcast row costs as much again as a few words.
FILTER_WORDS = 1 << 18
LANES = 8


def _spot(key: str, size: int, marks: int) -> tuple[Column, Column, Column]:
    """(row, lane, bits) of a hashed key: it sets up to ``marks`` bits of its word."""
    slot = F.pmod(F.col(key), F.lit(64 * size))
    lane = F.pmod(F.shiftright(slot, 6), F.lit(LANES)).cast("int")
    places = [slot, *[F.pmod(F.shiftright(key, 34 + 6 * k), F.lit(64)) for k in range(marks - 1)]]
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, (place % 64).cast("int")) for place in places]
    return F.shiftright(slot, 6 + LANES.bit_length() - 1), lane, reduce(Column.bitwiseOR, bits)


def key_filter(keys: DataFrame, key: str, size: int = FILTER_WORDS, marks: int = 1) -> DataFrame:
    """A Bloom filter over hashed ``key`` (long): at most ``size`` / LANES rows (word, bits of each lane)."""
    word, lane, bits = _spot(key, size, marks)
    lanes = [F.expr(f"bit_or(if(lane = {i}, bits, 0L))").alias(f"bits{i}") for i in range(LANES)]
    spots = keys.select(word.alias("word"), lane.alias("lane"), bits.alias("bits"))
    return spots.groupBy("word").agg(*lanes)


def maybe_in(df: DataFrame, key: str, words: DataFrame, size: int = FILTER_WORDS, marks: int = 1) -> DataFrame:
    """``df`` with ``maybe``: false for rows whose hashed ``key`` is surely not in the filter.

    Saves the shuffle of most rows that a later join on the key would find nothing for. ``size`` and
    ``marks`` are those of the filter.
    """
    word, lane, bits = _spot(key, size, marks)
    own = F.coalesce(*[F.when(lane == i, F.col(f"_bits{i}")) for i in range(LANES)])
    hit = own.bitwiseAND(bits) == bits
    lanes = [f"_bits{i}" for i in range(LANES)]
    small = F.broadcast(words.toDF("_word", *lanes))
    return (
        df.join(small, word == F.col("_word"), "left")
        .withColumn("maybe", F.coalesce(hit, F.lit(False)))
        .drop("_word", *lanes)
    )


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), itself included.

    Large-star and small-star steps in turn: every node points at the smallest node it knows, until
    a round changes nothing, in about log(n) rounds. Each round is a written table, so the plan
    stays short and a lost executor costs one round. Self links and repeats are ignored; a null on
    either side is no link.
    """
    links = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = staged(links.distinct(), name)
    seen = _digest(links)
    while True:
        both = links.union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        hub = staged(low.select("u", F.least("u", "low").alias("m")), name)
        large = both.filter("v > u").join(hub, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = staged(large.distinct(), name)
        hub = staged(large.groupBy("a").agg(F.min("b").alias("m")), name)
        pair = F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))
        small = large.join(hub, "a").select(F.inline(pair)).filter("a <> m")
        links = staged(small.toDF("a", "b").distinct(), name)
        before, seen = seen, _digest(links)
        if seen == before:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b", "b").distinct())


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
