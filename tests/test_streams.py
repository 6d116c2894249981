"""Streams give what their batch twins give, whatever the file layout, and survive a restart."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from parley.operators import keywords
from parley.operators.references import windowed_ref_counts
from parley.operators.sentiment import sentiment_table
from parley.plans import jobs
from parley.sources import files, records
from parley.streaming import live

EPOCH = 1704067200


def feed(spark, path, ids, start=0):
    """One file per call: a comment every ten seconds."""
    rows = [
        (json.dumps({
            "id": f"c{i}", "author": None, "created_utc": EPOCH + 10.0 * i + start, "score": i,
            "parent_id": "p", "subreddit": "s", "permalink": "l",
            "text": f"good /u/user{i % 3} likes word{i % 7} and word{i % 4} at http://x.y/r/z{i % 2}",
        }),)
        for i in ids
    ]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def land(spark, folder, **options):
    jobs.ingest(
        spark, folder("lines"), folder("raw"), folder("ckpt"), folder("bad"), None, 1, **options
    ).awaitTermination()


def test_ingest_restarts_without_repeats_and_quarantines(spark, folder):
    feed(spark, folder("lines"), range(0, 40))
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(folder("lines"))
    land(spark, folder)
    feed(spark, folder("lines"), range(40, 60))
    land(spark, folder)
    raw = files.read_raw(spark, folder("raw"))
    assert raw.count() == 60 and raw.select("id").distinct().count() == 60
    assert raw.filter("kind = 'comment'").count() == 60
    bad = spark.read.schema("value string").parquet(folder("bad"))
    assert [r["value"] for r in bad.collect()] == ["{broken"]


def test_live_ref_counts_equal_batch_up_to_the_watermark(spark, folder):
    for part in (range(0, 50), range(50, 100), range(100, 160)):
        feed(spark, folder("lines"), part)
        land(spark, folder)
    raw = files.read_raw(spark, folder("raw"))
    stream = files.read_raw_stream(spark, folder("raw"), raw.schema, max_files=1)
    counts = live.live_ref_counts(stream, "1 minute")
    got = live.drain(spark, counts, folder("out"), folder("state"))
    limit = raw.agg(F.max("timestamp") - F.expr("INTERVAL 1 MINUTE")).first()[0]
    want = windowed_ref_counts(raw).filter(F.col("window_end") <= F.lit(limit))
    assert got.count() > 1000
    assert sorted(got.collect()) == sorted(want.collect())


def test_rows_later_than_the_watermark_are_left_out(spark, folder):
    feed(spark, folder("lines"), range(0, 5))
    land(spark, folder)
    feed(spark, folder("lines"), range(5, 10), start=100_000)
    land(spark, folder)
    schema = files.read_raw(spark, folder("raw")).schema
    state = (folder("out"), folder("state"))
    counts = lambda: live.live_ref_counts(files.read_raw_stream(spark, folder("raw"), schema), "1 minute")
    before = live.drain(spark, counts(), *state).count()
    feed(spark, folder("lines"), [11])
    land(spark, folder)
    assert live.drain(spark, counts(), *state).count() == before


def test_live_dedup(spark, folder):
    for _ in range(3):
        feed(spark, folder("lines"), range(0, 30))
        land(spark, folder)
    schema = files.read_raw(spark, folder("raw")).schema
    stream = files.read_raw_stream(spark, folder("raw"), schema, max_files=1)
    once = live.drain(spark, live.live_dedup(stream, "1 day"), folder("out"), folder("state"))
    assert once.count() == 30


def test_live_sentiment_equals_batch(spark, folder):
    feed(spark, folder("lines"), range(0, 30))
    land(spark, folder)
    raw = files.read_raw(spark, folder("raw"))
    stream = sentiment_table(files.read_raw_stream(spark, folder("raw"), raw.schema))
    got = live.drain(spark, stream, folder("out"), folder("state"))
    assert sorted(got.collect(), key=str) == sorted(sentiment_table(raw).collect(), key=str)


def test_scored_batches_leave_no_stages(spark, folder, monkeypatch):
    """Also where many words are found and rows are joined; what the query has written is all that stays."""
    from parley.functions import lookup

    staged = []
    stage = lookup.staged

    def noted(df, name):
        staged.append(stage(df, name))
        return staged[-1]

    monkeypatch.setattr(lookup, "staged", noted)
    monkeypatch.setattr(lookup, "SMALL", 0)
    rows = [("a", "good bad word"), ("b", "good"), ("c", None)]
    for k in range(2):
        spark.createDataFrame(rows, "id string, text string").coalesce(1).write.mode("append").parquet(folder("in"))
    stream = files.read_raw_stream(spark, folder("in"), spark.read.parquet(folder("in")).schema, max_files=1)
    words = spark.createDataFrame([("good", 1.5), ("bad", -1.0)], "word string, value double")
    live.score_batches(stream, folder("out"), folder("ckpt"), None, lexicon=words).awaitTermination()
    got = files.read_results(spark, folder("out")).drop("batch")
    want = sentiment_table(spark.read.parquet(folder("in")), lexicon={"good": 1.5, "bad": -1.0})
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    paths = [spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]) for df in staged]
    assert len(paths) == 2
    assert not any(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) for p in paths)


def test_jobs_write_once_and_feed_the_dashboard(spark, folder):
    feed(spark, folder("lines"), range(0, 60))
    land(spark, folder)
    for _ in range(2):
        jobs.reference_job(spark, folder("raw"), folder("reference"))
        jobs.sentiment_job(spark, folder("raw"), folder("sentiment"))
        jobs.keyword_job(spark, folder("raw"), folder("keywords"), size="10 minutes", slide="5 minutes")
    raw = files.read_raw(spark, folder("raw"))
    counts = files.read_results(spark, folder("reference"))
    assert counts.agg(F.sum("count")).first()[0] == 60 * 3 * 12
    assert files.read_results(spark, folder("sentiment")).count() == raw.count()
    top = files.read_results(spark, folder("keywords"))
    assert top.count() == keywords.windowed_top_keywords(raw, "10 minutes", "5 minutes").count()
    jobs.reference_job(spark, folder("raw"), folder("appended"), append=True)
    jobs.reference_job(spark, folder("raw"), folder("appended"), append=True)
    assert files.read_results(spark, folder("appended")).count() == 2 * counts.count()

    board = jobs.dashboard(spark, folder("sentiment"), folder("reference"), latest=40)
    assert {name: df.count() for name, df in board.items()} == {
        "mean_sentiment": 3,
        "compound_over_time": 40,
        "word_frequencies": board["word_frequencies"].count(),
        "compound_histogram": 30,
        "compound_density": board["compound_density"].count(),
        "references": counts.count(),
    }
    assert board["compound_histogram"].agg(F.sum("count")).first()[0] == 40


def test_written_lines_come_back_through_the_stream(spark, folder):
    df = spark.createDataFrame([("a", 1.0, "x\ny \"q\" é")], "id string, created_utc double, text string")
    files.write_lines(records.to_json_lines(df), folder("lines"))
    land(spark, folder)
    row = files.read_raw(spark, folder("raw")).first()
    assert row["text"] == "x\ny \"q\" é" and row["timestamp"] == dt.datetime(1970, 1, 1, 0, 0, 1)


def test_a_feed_holds_every_row(spark, tmp_path, monkeypatch):
    from parley.plans import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 5)
    ids = [None, -7, 0, 3, 3, 1000, *range(50, 90), 10**12]
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    queries._feed(docs, f"{tmp_path}/feed")
    assert sorted(spark.read.parquet(f"{tmp_path}/feed").collect(), key=str) == sorted(docs.collect(), key=str)
    files = sorted((tmp_path / "feed").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    assert len(files) >= 9
    last = -8
    for f in files:
        part = [r.doc_id for r in spark.read.parquet(str(f)).collect() if r.doc_id is not None]
        if part:
            assert min(part) > last
            last = max(part)


def test_a_batch_takes_several_files_in_order(spark, tmp_path, monkeypatch):
    from parley.plans import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 5)
    monkeypatch.setattr(queries, "BATCH_ROWS", 20)
    assert queries._layout(0) == (4, 1)
    assert queries._layout(100) == (20, 4)
    assert queries._layout(10, least=2) == (2, 1)
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    each = queries._feed(docs, f"{tmp_path}/feed")
    stream = files.read_raw_stream(spark, f"{tmp_path}/feed", docs.schema, max_files=each)
    seen = []
    note = lambda batch, n: seen.append((batch.count(), *batch.agg(F.min("doc_id"), F.max("doc_id")).first()))
    files.write_batches(stream, note, f"{tmp_path}/ckpt", None).awaitTermination()
    assert len(seen) <= 5 and sum(n for n, *_ in seen) == 100
    assert all(before[2] < after[1] for before, after in zip(seen, seen[1:]))


def test_comments_exchange_their_texts_once(spark, sf_dir):
    from parley.sources import tables

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = tables.comments(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    above_texts = plan.split("FileScan")[0]
    assert above_texts.count("SortMergeJoin") == 1 and above_texts.count("Exchange hashpartitioning") == 1


def test_sentiment_job_deals_rows_before_they_grow(spark, folder, monkeypatch):
    feed(spark, folder("lines"), range(0, 20))
    land(spark, folder)
    plans, write = [], files.write_dealt

    def noted(df, path, columns):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        write(df, path, columns)

    monkeypatch.setattr(files, "write_dealt", noted)
    jobs.sentiment_job(spark, folder("raw"), folder("out"))
    assert plans[0].index("processed_text") < plans[0].index("Rebalance")
    assert plans[0].index("compound") < plans[0].index("Rebalance")
    assert files.read_results(spark, folder("out")).count() == 20
