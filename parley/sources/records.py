"""Discussion records: parse JSON lines, shape posts and comments, write lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.functions.rows import once
from parley.schemas import COMMENT_FIELDS, COMMENT_SCHEMA, POST_FIELDS, RECORD_SCHEMA

DELETED = "deleted"


def flatten(df: DataFrame, struct: str) -> DataFrame:
    """A struct column's fields as top-level columns."""
    return df.select(f"{struct}.*")


def lift_fields(df: DataFrame, struct: str) -> DataFrame:
    """A struct column's fields beside the other columns, the struct dropped."""
    fields = df.schema[struct].dataType.fieldNames()
    return df.select("*", *[F.col(f"{struct}.{f}").alias(f) for f in fields]).drop(struct)


def epoch_timestamp(epoch: Column | str) -> Column:
    """Epoch seconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.floor(epoch))


def author_or_deleted(author: Column | str = "author") -> Column:
    return F.coalesce(author, F.lit(DELETED))


def parsed_lines(lines: DataFrame, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    """Adds ``data``, the fields of each JSON line (``value``), and ``is_record``."""
    parsed = once(lines, "data", F.from_json("value", schema))
    return parsed.withColumn("is_record", ~_nothing_parsed("data", schema))


def parsed_rows(parsed: DataFrame, keep_malformed: bool = False) -> DataFrame:
    """The typed columns of parsed lines plus ``timestamp``."""
    rows = parsed if keep_malformed else parsed.filter("is_record")
    typed = flatten(rows.select("data"), "data")
    return typed.withColumn("timestamp", epoch_timestamp("created_utc"))


def unparsed(parsed: DataFrame) -> DataFrame:
    """The lines that yield no field at all."""
    return parsed.filter("not is_record").select("value")


def parse_records(
    lines: DataFrame, schema: StructType = RECORD_SCHEMA, keep_malformed: bool = False
) -> DataFrame:
    """JSON lines (``value``) to typed columns plus ``timestamp``.

    A bad field is null; a line that yields nothing is left out unless ``keep_malformed``
    (``malformed_lines`` returns exactly those).
    """
    return parsed_rows(parsed_lines(lines, schema), keep_malformed)


def malformed_lines(lines: DataFrame, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    """The lines that yield no field at all, for a quarantine output."""
    return unparsed(parsed_lines(lines, schema))


def _nothing_parsed(struct: str, schema: StructType) -> Column:
    fields = [F.col(f"{struct}.{f}") for f in schema.fieldNames()]
    return F.coalesce(*[f.cast("string") for f in fields]).isNull()


def with_kind(df: DataFrame) -> DataFrame:
    """Marks each record: a comment answers something, a post does not."""
    kind = F.when(F.col("parent_id").isNull(), "post").otherwise("comment")
    return df.withColumn("kind", kind)


def comment_columns(df: DataFrame) -> DataFrame:
    """The eight comment fields and the timestamp, for either kind of record."""
    return df.select(*COMMENT_FIELDS, "timestamp")


def shape_post(df: DataFrame) -> DataFrame:
    """Project to the post layout; a missing author becomes 'deleted'."""
    return df.withColumn("author", author_or_deleted()).select(*POST_FIELDS)


def shape_comment(df: DataFrame) -> DataFrame:
    """Project to the comment layout; a missing author becomes 'deleted'."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in COMMENT_SCHEMA.fields]
    return df.withColumn("author", author_or_deleted()).select(*typed)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON object (``value``)."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
