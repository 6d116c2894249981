"""A training-corpus pipeline over the documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import read
from parley.llm.decontamination import decontaminate
from parley.llm.jaccard_join import jaccard_join
from parley.llm.language_id import keep_identified
from parley.llm.line_dedup import NEAR, line_dedup
from parley.llm.packing import pack_documents
from parley.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifiers know; texts without letters and nulls go.

    Rows that repeat an id or a text are judged alike. Without labels all texts with letters stay.
    """
    return keep_identified(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; those of which no line is left go.

    Lines five edits apart and more are left to the stage for near copies. Of equal rows all keep the
    same lines; a document without any line stays as it is.
    """
    own = {c: f"_own_{c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    out = line_dedup(docs.withColumnsRenamed(own), **NEAR | {"edits": 4})
    out = out.filter("n_dropped = 0 or n_dropped < n_lines")
    return out.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every group of near copies.

    Rows that share a doc_id are one document: they all stay or all go. Rows without one stay.
    """
    groups = jaccard_join(docs).filter("component_id <> doc_id")
    return docs.join(groups.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text; null and empty texts hold none, nor do empty benchmarks."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences; every row has one piece at least."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: Language ID, decontamination and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, each stage written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
