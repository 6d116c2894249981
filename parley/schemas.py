"""Record layouts."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The eight fields kept from a comment record, in output order.
COMMENT_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("author", StringType()),
        StructField("created_utc", DoubleType()),
        StructField("score", IntegerType()),
        StructField("parent_id", StringType()),
        StructField("subreddit", StringType()),
        StructField("permalink", StringType()),
        StructField("text", StringType()),
    ]
)

# What a post record has besides.
POST_ONLY_FIELDS = [
    StructField("title", StringType()),
    StructField("url", StringType()),
    StructField("num_comments", IntegerType()),
]

# Posts and comments arrive on one feed, so one wide layout reads both.
RECORD_SCHEMA = StructType([*COMMENT_SCHEMA.fields, *POST_ONLY_FIELDS])

COMMENT_FIELDS = COMMENT_SCHEMA.fieldNames()

# Field order of an outgoing post record.
POST_FIELDS = [
    "id",
    "title",
    "author",
    "subreddit",
    "score",
    "created_utc",
    "url",
    "num_comments",
    "text",
]
