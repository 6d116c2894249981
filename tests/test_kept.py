"""Tables that streams keep current equal their batch twins after every step, and read no more than they must."""

import datetime as dt
import json
import re
import time

import pytest
from pyspark.sql import functions as F

from parley.operators import insights, keywords, snapshots
from parley.operators.sentiment import sentiment_table
from parley.sources import files
from parley.sources.ledger import Ledger, run_of
from parley.streaming import kept

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


class Feed:
    """A folder of Parquet files, one more with each call, and a stream over it."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.count = spark, path, schema, 0

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.parquet(f"{self.path}/{self.count:04d}")
        self.count += 1
        self.schema = df.schema
        return self.all()

    def all(self):
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/*")

    def stream(self):
        return files.read_raw_stream(self.spark, f"{self.path}/*", self.schema, max_files=1)


def run(feed, table, checkpoint):
    kept.start(feed.stream(), table, checkpoint, None).awaitTermination()


def plain(spark, path, rows, batch, run="r"):
    ledger = Ledger(spark, path, "n int, day string", "day")
    return ledger, ledger.add(spark.createDataFrame(rows, "n int, day string"), run, batch)


def test_a_batch_is_added_once(spark, folder):
    ledger, new = plain(spark, folder("t"), [(1, "a"), (2, "b"), (3, None)], 0)
    assert new and rows_of(ledger.read()) == [(1, "a"), (2, "b"), (3, None)]
    assert not plain(spark, folder("t"), [(1, "a")], 0)[1]
    assert plain(spark, folder("t"), [], 1)[1] and ledger.read().count() == 3
    # a fresh checkpoint starts at batch 0 again and replaces nothing
    assert plain(spark, folder("t"), [(9, "b")], 0, run="other")[1]
    assert rows_of(ledger.read(["b", "none such"])) == [(2, "b"), (9, "b")]
    assert ledger.read([]).count() == 0 and ledger.read([]).columns == ["n", "day"]


def test_rows_of_a_lost_attempt_do_not_count(spark, folder):
    ledger, _ = plain(spark, folder("t"), [(1, "a")], 0)
    ledger._write(spark.createDataFrame([(7, "a"), (7, "z")], "n int, day string"), "r-1")
    assert rows_of(ledger.read()) == [(1, "a")]
    assert plain(spark, folder("t"), [(2, "a")], 1)[1]
    assert rows_of(ledger.read()) == [(1, "a"), (2, "a")]


def test_a_manifest_cut_short_is_passed_over(spark, folder, tmp_path):
    ledger, _ = plain(spark, folder("t"), [(1, "a")], 0)
    (tmp_path / "t/manifest/000000000002.json").write_text('{"version": 2, "slo')
    assert rows_of(ledger.read()) == [(1, "a")]
    assert plain(spark, folder("t"), [(2, "a")], 1)[1]
    assert rows_of(ledger.read()) == [(1, "a"), (2, "a")]


def test_readers_see_each_row_once_during_a_fold(spark, folder):
    for batch in range(4):
        ledger, _ = plain(spark, folder("t"), [(batch, "a"), (batch, "b")], batch)
    before = ledger.read()
    want = rows_of(before)
    seen = []

    def rewrite(rows):
        seen.append(rows_of(ledger.read()))
        plain(spark, folder("t"), [(99, "a")], 4)  # a batch that comes meanwhile
        return rows

    assert ledger.fold(["a"], rewrite) == ["a"]
    assert seen == [want] and rows_of(before) == want
    assert rows_of(ledger.read()) == sorted([*want, (99, "a")], key=str)
    slots = ledger.manifest()["slots"]
    assert len(slots["a"]) == 2 and slots["a"][1] == "r-4" and len(slots["b"]) == 4
    assert ledger.fold(["a"], lambda df: df.groupBy("day").agg(F.sum("n").cast("int").alias("n"))) == ["a"]
    assert rows_of(ledger.read(["a"])) == [(105, "a")]
    assert ledger.fold(["a"]) == []


def test_two_writers_at_a_time(spark, folder):
    ledger, _ = plain(spark, folder("t"), [(1, "a")], 0)
    turns = []

    def change(content):
        if not turns:  # someone else commits first
            turns.append(1)
            plain(spark, folder("t"), [(2, "a")], 1)
        content["slots"].setdefault("x", [])

    ledger._commit(change)
    now = ledger.manifest()
    assert now["version"] == 3 and now["landed"] == {"r": 1} and now["slots"] == {"a": ["r-0", "r-1"], "x": []}


def test_vacuum_keeps_what_the_newest_versions_name(spark, folder, tmp_path):
    for batch in range(3):
        ledger, _ = plain(spark, folder("t"), [(batch, "a"), (batch, "b")], batch)
    pinned = ledger.read()
    ledger.fold(["a"])
    assert ledger.vacuum(keep=2) == 0 and pinned.count() == 6
    assert ledger.vacuum(keep=1) == 3
    assert rows_of(ledger.read()) == [(n, s) for n in range(3) for s in "ab"]
    assert len(list((tmp_path / "t/manifest").glob("*.json"))) == 1


def test_runs_are_told_apart(spark, folder):
    feed = Feed(spark, folder("in"), "timestamp timestamp, id string")
    feed.add([(START, "1")])
    table = kept.RawTable(spark, folder("t"), feed.schema)
    run(feed, table, folder("ckpt"))
    assert run_of(spark, folder("ckpt")) == run_of(spark, folder("ckpt"))
    run(feed, table, folder("fresh"))
    assert len(table.ledger.manifest()["landed"]) == 2 and table.read().count() == 2


def test_raw_days_are_folded(spark, folder):
    feed = Feed(spark, folder("in"), "timestamp timestamp, id string")
    for batch in range(5):
        rows = [(START + dt.timedelta(hours=6 * k), f"{batch}-{k}") for k in range(10)]
        feed.add([*rows, (None, f"{batch}-none")])
    table = kept.RawTable(spark, folder("t"), feed.schema)
    run(feed, table, folder("ckpt"))
    assert rows_of(table.read()) == rows_of(feed.all())
    many = len(table.ledger.read(["2024-01-01"]).inputFiles())
    assert table.fold("2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert many == 5 and len(table.ledger.read(["2024-01-01"]).inputFiles()) == 1
    assert rows_of(table.read()) == rows_of(feed.all())
    assert table.read(["2024-01-02"]).count() == 20 and table.read().columns == ["timestamp", "id"]


def test_latest_equals_the_snapshot_after_every_batch_and_a_restart(spark, folder):
    feed = Feed(spark, folder("in"), "id string, score int, ingest_ts timestamp")
    schema = spark.createDataFrame([], feed.schema).schema
    table = kept.LatestTable(spark, folder("t"), schema, buckets=3, fold_at=3)
    for batch in range(7):
        polls = [(f"c{k}", batch * k % 5, START + dt.timedelta(minutes=batch * (k % 3))) for k in range(20 + batch)]
        everything = feed.add([*polls, polls[0], (None, batch, START), ("x", 1, None)])
        run(feed, table, folder("ckpt"))  # each run restarts from the checkpoint
        assert rows_of(table.read()) == rows_of(snapshots.latest_snapshot(everything))
    assert all(len(sources) < 4 for sources in table.ledger.manifest()["slots"].values())


def test_latest_leaves_no_folded_rows_and_no_shuffles_on_disk(spark, folder, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: set(re.findall(r"shuffle_\d+_", disk.getAllFiles().mkString(" ")))
    feed = Feed(spark, folder("in"), "id string, score int, ingest_ts timestamp")
    schema = spark.createDataFrame([], feed.schema).schema
    table = kept.LatestTable(spark, folder("t"), schema, buckets=2, fold_at=2, keep=1)
    before = shuffles()
    for batch in range(4):
        everything = feed.add([(f"c{k}", batch, START + dt.timedelta(minutes=batch)) for k in range(20)])
        run(feed, table, folder("ckpt"))
        held = {f"src={s}/bucket={slot}" for slot, sources in table.ledger.manifest()["slots"].items() for s in sources}
        assert {str(p.relative_to(tmp_path / "t/data")) for p in (tmp_path / "t/data").glob("src=*/bucket=*")} == held
        deadline = time.monotonic() + 20
        while shuffles() - before and time.monotonic() < deadline:
            time.sleep(0.2)
        assert not shuffles() - before
        assert rows_of(table.read()) == rows_of(snapshots.latest_snapshot(everything))
        before = shuffles()


def test_first_seen_however_late(spark, folder):
    feed = Feed(spark, folder("in"), "id string, score int, timestamp timestamp")
    schema = spark.createDataFrame([], feed.schema).schema
    for words in (1, 1 << 14):  # a filter that knows nothing for sure, and one that does
        feed = Feed(spark, folder(f"in{words}"), "id string, score int, timestamp timestamp")
        table = kept.FirstTable(spark, folder(f"t{words}"), schema, buckets=4, words=words, fold_at=2)
        first, sizes = {}, []
        for batch in range(5):
            day = START + dt.timedelta(days=40 * batch)
            ids = [*(f"c{k}" for k in range(batch * 10, batch * 10 + 30)), None]
            rows = [(i, batch, day) for i in ids] + [("c0", 100 + batch, day), ("c0", 200 + batch, day)]
            feed.add(rows)
            run(feed, table, folder(f"ckpt{words}"))
            for i, score, ts in sorted(rows, key=lambda r: (r[2], r[1])):
                first.setdefault(i, (i, score, ts))
            assert rows_of(table.read()) == sorted(first.values(), key=str)
            sizes.append(table._merged(table.filters.read()).count())
        # what is held per bucket is bounded by the filter, and no state store grows
        assert max(sizes) <= 4 * min(words, 80)


TEXTS = ["alpha beta alpha", "beta gamma the delta", "delta delta alpha Epsilon", None, "the of and", "zeta"]


def keyword_feed(feed, minutes, tag):
    rows = [(f"{tag}{m}", START + dt.timedelta(minutes=m), TEXTS[m % len(TEXTS)]) for m in minutes]
    return feed.add(rows)


def test_keywords_from_stored_counts(spark, folder, monkeypatch):
    """Equal to the batch form after every step; what a batch reads does not grow with the table."""
    feed = Feed(spark, folder("in"), "id string, timestamp timestamp, text string")
    schema = spark.createDataFrame([], feed.schema).schema
    window = {"size": "10 minutes", "slide": "5 minutes"}
    table = kept.KeywordTable(spark, folder("t"), schema, **window, fold_at=4)
    opened = []
    read = Ledger.read

    def counted(ledger, slots=None):
        df = read(ledger, slots)
        if ledger is table.panes:
            opened.append((len(df.inputFiles()), df.count(), len(slots)))
        return df

    monkeypatch.setattr(Ledger, "read", counted)
    late = [range(3, 9)]
    for batch, minutes in enumerate([*(range(60 * h, 60 * h + 60, 2) for h in range(6)), *late]):
        everything = keyword_feed(feed, minutes, "abcdefgh"[batch])
        run(feed, table, folder("ckpt"))
        want = keywords.windowed_top_keywords(everything, **window)
        assert rows_of(table.read().select(want.columns)) == rows_of(want)
    # the hours of the touched windows alone: its own, and the one before or after
    assert len(opened) == 7 and all(slots <= 3 for *_, slots in opened)
    assert max(n for _, n, _ in opened[3:6]) == opened[3][1] and max(f for f, *_ in opened) <= 3 * 4
    # the late batch read its own two hours and not the four in between
    assert opened[-1][1] < opened[3][1] * 1.5
    total = read(table.panes).count()
    assert total > 2 * opened[-1][1]


def test_a_long_window_is_ranked_in_parts_by_word(spark, folder, monkeypatch):
    parts = []
    deal = keywords.win.dealt_stretches

    def noted(*args):
        dealt = deal(*args)
        parts.append(dealt.agg(F.max("part")).first()[0])
        return dealt

    monkeypatch.setattr(keywords.win, "dealt_stretches", noted)
    monkeypatch.setattr(keywords, "MOST_ROWS", 5)
    feed = Feed(spark, folder("in"), "id string, timestamp timestamp, text string")
    schema = spark.createDataFrame([], feed.schema).schema
    window = {"size": "6 hours", "slide": "1 hour", "vocab_size": 4}
    table = kept.KeywordTable(spark, folder("t"), schema, unit="day", **window)
    for batch in range(2):
        everything = keyword_feed(feed, range(batch, 120, 7), "ab"[batch])
        run(feed, table, folder("ckpt"))
    got = rows_of(table.read())
    assert len(parts) == 2 and min(parts) > 0
    monkeypatch.setattr(keywords, "MOST_ROWS", 500_000)
    want = keywords.windowed_top_keywords(everything, **window)
    assert got == rows_of(want.select(table.read().columns)) and parts[-1] == -1


def test_no_text_is_tokenised_twice(spark, folder):
    feed = Feed(spark, folder("in"), "id string, timestamp timestamp, text string")
    schema = spark.createDataFrame([], feed.schema).schema
    table = kept.KeywordTable(spark, folder("t"), schema, size="10 minutes", slide="5 minutes")
    for batch in range(3):
        everything = keyword_feed(feed, [7] * 5, "abc"[batch])
        run(feed, table, folder("ckpt"))
    texts = everything.filter("text is not null").count()
    assert table.panes.read().filter("word = ''").count() == texts
    with pytest.raises(Exception, match="another checkpoint"):
        run(feed, table, folder("fresh"))


def test_the_board_equals_batch_after_every_file(spark, folder):
    feed = Feed(spark, folder("in"), "id string, timestamp timestamp, text string")
    schema = spark.createDataFrame([], feed.schema).schema
    scored = sentiment_table(spark.createDataFrame([], schema))
    columns = ["id", "timestamp", "compound", *insights.SENTIMENTS, "finished_no_stop_lemmatized"]
    table = kept.BoardTable(spark, folder("t"), scored.select(columns).schema, latest=7, buckets=2, fold_at=2)
    texts = ["good great bad", "terrible awful", "nothing here", "", None, "love good"]
    for batch in range(3):
        rows = [(f"{batch}-{k}", START + dt.timedelta(hours=(batch * 7 + k) % 40), texts[(batch + k) % 6]) for k in range(9)]
        everything = sentiment_table(feed.add([*rows, (f"{batch}-x", None, "bad")])).select(columns)
        stream = sentiment_table(feed.stream()).select(columns)
        kept.start(stream, table, folder("ckpt"), None).awaitTermination()
        board = table.read()
        near = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows_of(df)]
        assert near(board["mean_sentiment"]) == near(insights.mean_sentiment(everything))
        assert near(board["compound_over_time"]) == near(insights.compound_over_time(everything))
        assert near(board["word_frequencies"]) == near(insights.word_frequencies(everything))
        assert near(board["compound_histogram"]) == near(insights.compound_histogram(everything))
        assert near(board["compound_density"]) == near(insights.compound_density(everything))
        assert rows_of(board["latest_rows"]) == rows_of(insights.latest_rows(everything, 7))


def test_counts_by_pane_hold_fewer_state_rows(spark, folder):
    from parley.operators.references import all_refs, windowed_ref_counts
    from parley.streaming import live

    feed = Feed(spark, folder("in"), "timestamp timestamp, text string")
    for part in range(4):
        feed.add([(START + dt.timedelta(seconds=5 * (part * 40 + k)), f"see /u/u{k % 4} now") for k in range(40)])

    def most_rows(stream, name):
        query = files.write_raw_stream(stream, folder(name), folder(f"{name}-state"), None)
        query.awaitTermination()
        return max(sum(op["numRowsTotal"] for op in json.loads(p.json)["stateOperators"]) for p in query.recentProgress)

    chained = most_rows(live.live_ref_counts(feed.stream(), "10 minutes"), "chained")
    refs = all_refs(feed.stream().withWatermark("timestamp", "10 minutes"))
    direct = refs.groupBy(F.window("timestamp", "60 seconds", "5 seconds"), "reference").agg(F.count("*").alias("n"))
    assert chained < most_rows(direct, "direct") / 4
    limit = feed.all().agg(F.max("timestamp") - F.expr("INTERVAL 10 MINUTE")).first()[0]
    want = windowed_ref_counts(feed.all()).filter(F.col("window_end") <= F.lit(limit))
    got = spark.read.parquet(folder("chained"))
    assert rows_of(got.select(want.columns)) == rows_of(want) and got.count() > 0
