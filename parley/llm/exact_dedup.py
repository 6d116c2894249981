"""Exact dedup: a tree merge of sorted digest runs.

Every partition writes one sorted run of text digests. Runs then meet in rounds, ``FAN`` at a time
and split by digest, and each merge keeps the best row and the row count of a digest. The answer
goes down the same tree, so no join ever sees more of one text than one run or ``FAN`` runs hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import whole_text
from parley.session import staged

RUNS = 4096
FAN = 64
TEXT = ["digest", "n_bytes", "check"]


def digest_runs(docs: DataFrame, runs: int = RUNS) -> DataFrame:
    """(row_id, doc_id, run, digest, n_bytes, check), sorted by digest within a partition.

    Length and a second hash are part of the key, so a digest alone never joins two texts.
    """
    text = whole_text()
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    ).sortWithinPartitions("digest")


def merge_round(runs: DataFrame, fan: int, best) -> DataFrame:
    """One round: each ``fan`` neighbouring runs become one, holding one row for a text."""
    return (
        runs.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
        .groupBy("run", *TEXT)
        .agg(best("best").alias("best"), F.sum("group_size").alias("group_size"))
    )


def exact_dedup(docs: DataFrame, keep: str = "largest", runs: int = RUNS, fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest
    (or ``keep="smallest"``) doc_id stays; a null doc_id stays only when its text has no other id.
    Of rows that repeat both id and text exactly one has ``kept``. No rows give no rows; other
    columns of ``docs`` are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    best = F.max if keep == "largest" else F.min
    known = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    rows = staged(digest_runs(docs, runs), "digest-runs")
    level = (
        rows.withColumn("best", F.struct(known.alias("known"), "doc_id", "row_id"))
        .groupBy("run", *TEXT)
        .agg(best("best").alias("best"), F.count("*").alias("group_size"))
    )
    levels, width = [staged(level, "digest-level")], runs
    while width > 1:
        levels.append(staged(merge_round(levels[-1], fan, best), "digest-level"))
        width = -(-width // fan)

    answer = levels.pop()
    while levels:
        below = levels.pop().select("run", *TEXT)
        up = F.floor(F.col("run") / fan).cast("int")
        answer = below.withColumn("up", up).join(answer.withColumnRenamed("run", "up"), ["up", *TEXT])
        answer = answer.drop("up")
    return rows.join(answer, ["run", *TEXT]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
