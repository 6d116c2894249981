"""End-to-end jobs: land records, derive the three result tables, feed the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.operators import insights, keywords
from parley.operators.references import windowed_ref_counts
from parley.operators.sentiment import sentiment_table
from parley.session import staged
from parley.sources import files, records
from parley.sources.ledger import start_landing


def ingest(
    spark: SparkSession,
    lines_path: str,
    raw_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    every: str | None = "5 seconds",
    max_files: int | None = None,
) -> StreamingQuery:
    """JSON lines to the raw Parquet table; lines that parse to nothing go to the quarantine.

    Each batch is read and parsed once. Both outputs lie in folders by day, stream and batch number,
    so a batch that runs again replaces what it wrote, a fresh checkpoint replaces nothing, and
    readers of some days open no others.
    """

    def land(batch: DataFrame, run: str, number: int) -> None:
        name = f"{run}-{number}"
        parsed = records.parsed_lines(batch).persist()
        rows = records.parsed_rows(parsed).transform(records.with_kind)
        files.write_batch(rows, raw_path, name, F.to_date("timestamp"))
        if quarantine_path:
            files.write_batch(records.unparsed(parsed), quarantine_path, name)
        parsed.unpersist()

    lines = files.read_lines_stream(spark, lines_path, max_files)
    return start_landing(lines, land, checkpoint, every)


def reference_job(
    spark: SparkSession, raw_path: str, out_path: str, append: bool = False, **options
) -> None:
    """Windowed reference counts of the raw table, one output partition per day."""
    counts = windowed_ref_counts(files.read_raw(spark, raw_path), **options)
    _save(counts, out_path, append)


def keyword_job(
    spark: SparkSession, raw_path: str, out_path: str, append: bool = False, **options
) -> None:
    """Top keywords of every window of the raw table, all windows in one job."""
    top = keywords.windowed_top_keywords(files.read_raw(spark, raw_path), **options)
    _save(top, out_path, append)


def sentiment_job(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    ts: str = "timestamp",
    append: bool = False,
    **options,
) -> None:
    """Annotated and scored rows of the raw table, one output partition per day.

    Rows meet their day before they are annotated, when they are a fifth of what is written. Tables as
    dictionaries are joined, which deals the rows anew, so those results meet their day at the end.
    """
    raw = files.read_raw(spark, raw_path)
    joined = any(isinstance(option, DataFrame) for option in options.values())
    if append or joined:
        _save(sentiment_table(raw, **options), out_path, append, ts)
        return
    dealt = raw.withColumn("day", F.to_date(ts)).hint("rebalance", F.col("day"))
    files.write_dealt(sentiment_table(dealt, **options), out_path, ["day"])


def _save(df: DataFrame, path: str, append: bool, time: str = "window_start") -> None:
    """Replace the days the result covers; ``append`` adds a further copy instead."""
    if append:
        files.write_append(df, path)
    else:
        files.write_partitioned(df.withColumn("day", F.to_date(time)), path, ["day"])


def dashboard(
    spark: SparkSession, sentiment_path: str, reference_path: str, latest: int | None = None
) -> dict[str, DataFrame]:
    """The table behind each chart. ``latest`` looks at the newest rows only, picked once."""
    scored = files.read_results(spark, sentiment_path)
    if latest:
        scored = staged(insights.latest_rows(scored, latest), "latest-rows")
    return {
        "mean_sentiment": insights.mean_sentiment(scored),
        "compound_over_time": insights.compound_over_time(scored),
        "word_frequencies": insights.word_frequencies(scored),
        "compound_histogram": insights.compound_histogram(scored),
        "compound_density": insights.compound_density(scored),
        "references": insights.reference_view(spark, reference_path),
    }
