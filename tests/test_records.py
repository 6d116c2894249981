import datetime as dt
import json

from pyspark.sql import functions as F

from parley.operators import insights, snapshots
from parley.schemas import COMMENT_FIELDS
from parley.sources import files, records

GOOD = {
    "id": "c1", "author": "ann", "created_utc": 1704067200.9, "score": 3, "parent_id": "t3_p",
    "subreddit": "s", "permalink": "/r/s/c1", "text": "hi",
}


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_comment_and_post(spark):
    post = {"id": "p", "title": "T", "url": "u", "num_comments": 2, "text": "x", "created_utc": 1.5}
    df = records.parse_records(lines(spark, json.dumps(GOOD), json.dumps(post)))
    rows = {r["id"]: r for r in df.transform(records.with_kind).collect()}
    assert rows["c1"]["kind"] == "comment" and rows["p"]["kind"] == "post"
    assert rows["p"]["title"] == "T" and rows["p"]["num_comments"] == 2
    assert rows["p"]["parent_id"] is None and rows["p"]["permalink"] is None
    assert records.comment_columns(df).columns == [*COMMENT_FIELDS, "timestamp"]


def test_the_fraction_of_a_second_is_cut(spark):
    row = records.parse_records(lines(spark, json.dumps(GOOD))).first()
    assert row["timestamp"] == dt.datetime(2024, 1, 1)
    assert row["created_utc"] == 1704067200.9


def test_bad_fields_and_bad_lines(spark):
    text_score = json.dumps({**GOOD, "score": "many"})
    half_score = json.dumps({**GOOD, "score": 2.5})
    feed = lines(spark, text_score, half_score, "not json", '{"id": "cut', None)
    parsed = records.parse_records(feed).collect()
    assert [(r["id"], r["score"]) for r in parsed] == [("c1", None), ("c1", None)]
    bad = [r["value"] for r in records.malformed_lines(feed).collect()]
    assert sorted(bad, key=str) == sorted(["not json", '{"id": "cut', None], key=str)
    assert records.parse_records(feed, keep_malformed=True).count() == 5


def test_json_is_parsed_once(spark):
    plan = records.parse_records(lines(spark, json.dumps(GOOD)))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_shapes_and_missing_author(spark):
    df = spark.createDataFrame(
        [("a", None, "t", "s", 1, 1.0, "u", 2, "x")],
        "id string, author string, title string, subreddit string, score int, created_utc double,"
        " url string, num_comments int, text string",
    )
    post = records.shape_post(df)
    assert post.columns[:3] == ["id", "title", "author"]
    assert post.first()["author"] == "deleted"
    comment = df.withColumn("parent_id", F.lit("p")).withColumn("permalink", F.lit("l"))
    assert records.shape_comment(comment).columns == COMMENT_FIELDS


def test_lines_round_trip_through_files(spark, tmp_path):
    parsed = records.parse_records(lines(spark, json.dumps(GOOD))).select(*COMMENT_FIELDS)
    files.write_lines(records.to_json_lines(parsed), str(tmp_path / "lines"))
    again = records.parse_records(spark.read.text(str(tmp_path / "lines"))).select(*COMMENT_FIELDS)
    assert again.collect() == parsed.collect()
    files.write_json(parsed, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["id"] == "c1"


def test_lift_fields(spark):
    df = spark.range(1).select("id", F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")).alias("s"))
    assert records.lift_fields(df, "s").columns == ["id", "a", "b"]
    assert records.flatten(df, "s").columns == ["a", "b"]


def test_append_doubles_and_partitioned_replaces(spark, tmp_path):
    df = spark.range(3).withColumn("day", F.lit("d1"))
    for _ in range(2):
        files.write_append(df, str(tmp_path / "append"))
        files.write_partitioned(df, str(tmp_path / "part"), ["day"])
    files.write_partitioned(spark.range(1).withColumn("day", F.lit("d2")), str(tmp_path / "part"), ["day"])
    assert files.read_raw(spark, str(tmp_path / "append")).count() == 6
    assert files.read_results(spark, str(tmp_path / "part")).count() == 4


def test_concat_by_column_name(spark, tmp_path):
    path = str(tmp_path / "mixed")
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("more", F.lit("x")).write.mode("append").parquet(path)
    both = files.read_dir_concat(spark, path)
    assert sorted(both.columns) == ["id", "more"] and both.count() == 4
    assert len(files.peek(both, 3)) == 3


def test_accumulate_fills_missing_columns(spark):
    both = insights.accumulate(
        files.rows_to_df(spark, [(1, "a")], ["id", "x"]), files.rows_to_df(spark, [(2, "b")], ["id", "y"])
    )
    assert sorted((r["id"], r["x"], r["y"]) for r in both.collect()) == [(1, "a", None), (2, None, "b")]


def test_snapshots(spark):
    t = [dt.datetime(2024, 1, 1, 0, m) for m in range(3)]
    df = spark.createDataFrame(
        [("a", 1, t[0]), ("a", 2, t[1]), ("a", 3, t[2]), ("b", 7, t[1]), ("b", 8, t[1]), ("c", 1, None)],
        "id string, score int, ingest_ts timestamp",
    )
    newest = {r["id"]: r["score"] for r in snapshots.latest_snapshot(df).collect()}
    assert newest == {"a": 3, "b": 8, "c": 1}
    oldest = {r["id"]: r["score"] for r in snapshots.dedup_records(df, order="ingest_ts").collect()}
    assert oldest == {"a": 1, "b": 7, "c": 1}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(999).select(key.alias("id"), F.col("id").alias("ingest_ts"))
    newest = snapshots.latest_snapshot(df)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # salted parts, then groups, each before and after a shuffle
    assert newest.filter("id = 'hot'").first()["ingest_ts"] == 997
    assert newest.count() == 334
