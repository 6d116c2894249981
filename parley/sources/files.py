"""Readers and writers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parley.session import shuffles_freed


def read_lines_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded text lines (``value string``) from files landing in ``path``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def read_raw_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Unbounded rows from Parquet files landing in ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_raw(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet files under a folder or glob."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_dir_concat(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file of a folder, columns matched by name."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_raw_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Append a stream to Parquet. ``every=None`` takes all that is there and stops."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.trigger(**_trigger(every)).start()


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def write_batches(
    stream: DataFrame,
    land: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "5 seconds",
) -> StreamingQuery:
    """Hand each batch of a stream to ``land``; a batch may come again after a failure."""
    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start()


def write_batch(df: DataFrame, path: str, name: str, day: Column | None = None) -> None:
    """One batch's rows in a folder of their own (by day, if given), replaced when written again.

    The name must tell the stream and the batch: batch numbers start anew with a fresh checkpoint.
    Without a day all rows lie in one folder as they are, so none are exchanged.
    """
    if day is None:
        write_dealt(df.withColumn("batch", F.lit(name)), path, ["batch"])
    else:
        write_partitioned(df.withColumns({"day": day, "batch": F.lit(name)}), path, ["day", "batch"])


def write_append(df: DataFrame, path: str) -> None:
    """Append; running it twice keeps both copies."""
    df.write.mode("append").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = ("window_start", "window_end"),
) -> None:
    """Replace just the partitions that ``df`` holds, so a re-run leaves one copy.

    The rebalance gathers each partition value in few files and splits one that is too large.
    """
    write_dealt(df.hint("rebalance", *[F.col(c) for c in columns]), path, columns)


def write_dealt(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """``write_partitioned`` of rows that lie by their partition values already."""
    with shuffles_freed(df.sparkSession):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(path)
        )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """One text column, one line per row."""
    lines.write.mode("append").text(path)


def rows_to_df(spark: SparkSession, rows: Iterable, columns: Sequence[str] | str) -> DataFrame:
    """Literal rows; for tests and small word tables."""
    return spark.createDataFrame(list(rows), columns)


def peek(df: DataFrame, n: int = 20) -> list[Row]:
    """The first ``n`` rows; never the whole table."""
    return df.limit(n).collect()


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """What a job wrote, partition columns included."""
    return spark.read.parquet(path)
