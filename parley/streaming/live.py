"""Operators on unbounded input.

Sentiment and ingest give what their batch twins give. Counts cover the windows that the watermark
has closed. De-duplication keeps the first copy to arrive, where the batch form keeps the earliest by
time. Results that are kept up to date in stored tables are in ``kept``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.functions import windows as win
from parley.operators.references import all_refs
from parley.operators.sentiment import sentiment_table
from parley.sources.files import write_batch, write_raw_stream
from parley.sources.ledger import start_landing


def live_ref_counts(
    df: DataFrame,
    delay: str = "10 minutes",
    size: str = "60 seconds",
    slide: str = "5 seconds",
    ts: str = "timestamp",
    text: str = "text",
    mode: str = "first",
) -> DataFrame:
    """Windowed reference counts; a window is emitted once, when the watermark passes its end.

    Hits are counted per pane first, so that the rows still open under the delay are one per pane
    and reference and not one for every window over it; closed panes go on to their windows.
    """
    refs = all_refs(df.withWatermark(ts, delay), text, ts, mode)
    panes = refs.groupBy(F.window(ts, win.pane_width(size, slide)).alias("pane"), "reference").agg(
        F.count("*").alias("n")
    )
    return (
        panes.groupBy(F.window(F.window_time("pane"), size, slide).alias("window"), "reference")
        .agg(F.sum("n").alias("count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "reference",
            "count",
        )
    )


def live_dedup(
    df: DataFrame, delay: str = "10 minutes", key: str = "id", ts: str = "timestamp"
) -> DataFrame:
    """The first row of each key to arrive; a key is forgotten once the watermark passes it."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def score_batches(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds", **options
) -> StreamingQuery:
    """Score a stream batch by batch, which allows dictionaries given as tables of any size."""

    def score(batch: DataFrame, run: str, number: int) -> None:
        write_batch(sentiment_table(batch, **options), path, f"{run}-{number}")

    return start_landing(stream, score, checkpoint, every)


def drain(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that is there, then read back what it wrote."""
    write_raw_stream(stream, path, checkpoint, every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
