import datetime as dt

import pytest

from parley.operators import references as ref

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = "timestamp timestamp, text string"


def refs(spark, text, **options):
    df = spark.createDataFrame([(T0, text)], SCHEMA)
    return sorted((r["kind"], r["reference"]) for r in ref.all_refs(df, **options).collect())


def test_only_the_first_match_of_a_kind_counts(spark):
    assert refs(spark, "/u/ann and /u/bob") == [("user", "/u/ann")]
    assert refs(spark, "/u/ann and /u/bob", mode="all") == [("user", "/u/ann"), ("user", "/u/bob")]


def test_a_name_ends_at_the_first_other_character(spark):
    assert refs(spark, "hi /u/bob-x") == [("user", "/u/bob")]


def test_a_link_into_a_community_counts_twice(spark):
    assert refs(spark, "see http://a.b/r/foo, ok") == [
        ("community", "/r/foo"),
        ("url", "http://a.b/r/foo,"),
    ]


@pytest.mark.parametrize("text", [None, "", "nothing here"])
def test_texts_without_references(spark, text):
    assert refs(spark, text) == []
    assert refs(spark, text, mode="all") == []


def test_one_kind_keeps_the_row(spark):
    df = spark.createDataFrame([(T0, "/r/x /r/y"), (T0, "none"), (None, "/r/z")], SCHEMA)
    found = ref.community_refs(df)
    assert found.columns == ["timestamp", "text", "reference"]
    assert sorted(r["reference"] for r in found.collect()) == ["/r/x", "/r/z"]
    assert ref.community_refs(df, mode="all").count() == 3


def test_each_row_is_in_twelve_windows_and_a_null_time_in_none(spark):
    rows = [(T0, "/u/a"), (T0 + dt.timedelta(seconds=4, microseconds=999999), "/u/a"), (None, "/u/a")]
    counts = ref.windowed_ref_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(counts) == 12
    assert sum(r["count"] for r in counts) == 24
    assert min(r["window_start"] for r in counts) == T0 - dt.timedelta(seconds=55)
    assert max(r["window_start"] for r in counts) == T0
    assert all(r["window_end"] - r["window_start"] == dt.timedelta(seconds=60) for r in counts)


@pytest.mark.parametrize("size, slide", [("60 seconds", "5 seconds"), ("50 seconds", "20 seconds"), ("1 minute", "1 minute"), ("1 hour", "25 minutes")])
def test_panes_count_like_windows(spark, size, slide):
    from pyspark.sql import functions as F

    df = spark.range(500).select(
        F.timestamp_seconds(F.col("id") * 7 % 3001 + 1_700_000_000).alias("timestamp"),
        F.concat(F.lit("/u/x"), F.col("id") % 3).alias("text"),
    )
    direct = (
        ref.all_refs(df)
        .groupBy(F.window("timestamp", size, slide).alias("w"), "reference")
        .count()
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "reference", "count")
    )
    panes = ref.windowed_ref_counts(df, size, slide)
    assert sorted(panes.collect()) == sorted(direct.collect())


def test_nested_window_column(spark):
    df = spark.createDataFrame([(T0, "/u/a")], SCHEMA)
    nested = ref.windowed_ref_counts(df, nested=True)
    assert nested.columns == ["window", "reference", "count"]
    assert nested.filter("window.start = timestamp'2024-01-01 00:00:00'").count() == 1


def test_the_text_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([(T0, "/u/a")], SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    plan = ref.windowed_ref_counts(df)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        ref.all_refs(spark.createDataFrame([(T0, "x")], SCHEMA), mode="last")
