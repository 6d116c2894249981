"""The given tables as discussion data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text) of every document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text")


def _moments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """(moment, ts, user_id, value), and how many moments there are.

    Event numbers wrap around the documents (or, where events are fewer, the other way round), so
    every event belongs to one moment: its first time and user, the sum of its values.
    """
    events = table(spark, sf_dir, "events")
    count = min(events.count(), table(spark, sf_dir, "documents").count()) or 1
    first = F.min(F.struct("ts", "user_id"))
    moments = (
        events.groupBy((F.col("event_id") % count).alias("moment"))
        .agg(first.alias("first"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value"))
        .select("moment", "first.*", "value")
    )
    return moments, count


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comment per document: (id, author, ts, score, subreddit, text).

    The document's events give author, time and score; the text ends in a user, a community and a
    page link.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return compose_comments(docs, spark, sf_dir)


def compose_comments(docs: DataFrame, spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """The comments of ``docs``, which may be a stream of rows of the documents table.

    What a number stands for is put together on rows without texts, so texts are exchanged once; for
    a stream it is stored, so that its batches don't put it together again.
    """
    moments, count = _moments(spark, sf_dir)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    page_count = pages.count() or 1
    numbers = table(spark, sf_dir, "documents").select("doc_id").distinct()
    facts = (
        numbers.withColumns({"moment": F.col("doc_id") % count, "page_id": F.col("doc_id") % page_count})
        .join(moments, "moment")
        .join(pages, "page_id", "left")
        .select("doc_id", "user_id", "ts", "value", "url")
    )
    return (
        docs.join(staged(facts, "facts") if docs.isStreaming else facts, "doc_id")
        .select(
            F.col("doc_id").cast("string").alias("id"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
            "ts",
            F.floor("value").cast("int").alias("score"),
            F.col("source").alias("subreddit"),
            F.concat(
                "text",
                F.lit(" see /u/user"),
                F.col("user_id").cast("string"),
                F.lit(" in /r/"),
                "source",
                F.lit(" via "),
                "url",
            ).alias("text"),
            *also,
        )
    )


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, ts, text) of every document with the time of its first event: what keywords need."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compose_timeline(docs, spark, sf_dir)


def compose_timeline(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    moments, count = _moments(spark, sf_dir)
    times = moments.select("moment", "ts")
    return (
        docs.withColumn("moment", F.col("doc_id") % count)
        .join(staged(times, "times") if docs.isStreaming else times, "moment")
        .select(F.col("doc_id").cast("string").alias("id"), "ts", "text")
    )


def comment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments in the outgoing record layout, answering the conversation of their number."""
    c = comments(spark, sf_dir)
    return c.select(
        "id",
        "author",
        (
            F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), "ts") / F.lit(1e6)
        ).alias("created_utc"),
        "score",
        F.concat(F.lit("t3_"), "subreddit").alias("parent_id"),
        "subreddit",
        F.concat(F.lit("/r/"), "subreddit", F.lit("/"), "id").alias("permalink"),
        "text",
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comments polled twice: again five minutes later with the score one higher."""
    first = comments(spark, sf_dir).withColumn("ingest_ts", F.col("ts"))
    polls = F.explode(F.array(F.lit(0), F.lit(1))).alias("poll")
    both = first.select("*", polls)
    return both.select(
        "id",
        "author",
        "ts",
        (F.col("score") + F.col("poll")).alias("score"),
        "subreddit",
        "text",
        (F.col("ingest_ts") + F.expr("make_dt_interval(0, 0, 5 * poll, 0)")).alias("ingest_ts"),
    )
