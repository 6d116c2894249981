"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import tokens
from parley.llm.common import ship

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``, in no fixed order.

    ``n_tokens`` is what the tokenizers library gives for the whole text with a byte-level
    vocabulary (a path, or the name of a public file), without added special tokens, truncation or
    padding; a special string inside a text counts as the library's default has it. A null or empty
    text has 0 bytes and tokens. No rows give no rows; a null doc_id and repeated rows stay as they
    are; other columns of ``docs`` are ignored.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.pieces_of(vocabulary, with_ids=False)
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                lists = tokens.blank_kept(batch.column("text"))
                numbers = known.look_up(lists.flatten())
                n = tokens.sums(known.counts[numbers], lists)
                size = pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), size, pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )
                pa.default_memory_pool().release_unused()  # Arrow keeps more than a worker remembers

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
