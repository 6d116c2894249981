"""Results that a stream keeps up to date, batch by batch, in ledgers.

What a batch adds is stored in a form that merges (counts, latest rows, filters), so no result is
computed again from the whole table, a batch that runs again changes nothing, and readers see each
batch as a whole or not at all. ``start`` runs any of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parley.functions import windows as win
from parley.operators import insights, keywords
from parley.operators.snapshots import dedup_records, latest_snapshot
from parley.session import staged
from parley.sources.ledger import Ledger, start_landing

#: Key buckets of tables without a time.
BUCKETS = 16
#: 64-bit words of a bucket's filter on known keys.
FILTER_WORDS = 1 << 14
#: Sources of a slot that are folded into one.
FOLD_AT = 8
#: Manifests that are kept for readers, with the folders they name, where a table cleans up by itself.
KEEP = 10
_FORMS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def start(stream: DataFrame, table, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Keep ``table`` (one of the classes below) current with a stream."""
    return start_landing(stream, table.land, checkpoint, every)


def time_slot(ts: Column | str, unit: str = "day") -> Column:
    """The name of the day or hour that holds ``ts``, by the session's clock; they sort by time."""
    return F.date_format(ts, _FORMS[unit])


def key_bucket(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


def _only_run(ledger: Ledger, run: str) -> None:
    """Counts add up, so the same rows under a fresh checkpoint would count twice."""
    if others := set(ledger.manifest()["landed"]) - {run}:
        raise ValueError(f"{ledger.root} was filled under another checkpoint ({min(others)}); use a new folder")


class RawTable:
    """Every row that arrives, by day. ``fold`` makes few files of a closed day's many."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, ts: str = "timestamp") -> None:
        self.ts = ts
        self.ledger = Ledger(spark, root, schema, "day")

    def land(self, batch: DataFrame, run: str, number: int) -> None:
        self.ledger.add(batch.withColumn("day", time_slot(self.ts)), run, number)

    def read(self, days: Iterable[str] | None = None) -> DataFrame:
        return self.ledger.read(days).drop("day")

    def fold(self, before: str) -> list[str]:
        """Folds the days before one, such as ``"2024-01-31"``; rows without a time stay apart."""
        return self.ledger.fold([d for d in self.ledger.manifest()["slots"] if d < before and d[0].isdigit()])


class LatestTable:
    """The newest version of each key: ``latest_snapshot`` of all that has arrived.

    A batch adds its own newest versions to their key buckets; reading merges a bucket's few sources,
    and a bucket of ``fold_at`` sources is folded to one row per key. What was folded is deleted, once
    ``keep`` newer versions of the table are there.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str = "id",
        ingested: str = "ingest_ts",
        buckets: int = BUCKETS,
        fold_at: int = FOLD_AT,
        keep: int = KEEP,
    ) -> None:
        self.key, self.ingested, self.buckets, self.fold_at, self.keep = key, ingested, buckets, fold_at, keep
        self.ledger = Ledger(spark, root, schema, "bucket")

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_snapshot(rows, self.key, self.ingested)

    def land(self, batch: DataFrame, run: str, number: int) -> None:
        newest = self._newest(batch).withColumn("bucket", key_bucket(self.key, self.buckets))
        self.ledger.add(newest, run, number)
        self.ledger.fold(rewrite=self._newest, least=self.fold_at)
        self.ledger.vacuum(self.keep)

    def read(self) -> DataFrame:
        return self._newest(self.ledger.read().drop("bucket"))


class FirstTable:
    """The first row of each key to arrive, however long ago; null is a key like any other.

    No state is held in memory: each key bucket has a stored filter, which is at most FILTER_WORDS
    rows however many keys there are. Keys that it surely lacks are new; the others are looked up in
    the bucket's rows, of which only the key column is read. Of copies in one batch the earliest by
    ``order`` counts. A fuller filter costs look-ups, never rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        key: str = "id",
        order: str = "timestamp",
        buckets: int = BUCKETS,
        words: int = FILTER_WORDS,
        fold_at: int = FOLD_AT,
    ) -> None:
        self.key, self.order, self.buckets, self.words, self.fold_at = key, order, buckets, words, fold_at
        self.rows = Ledger(spark, f"{root}/rows", schema, "bucket")
        self.filters = Ledger(spark, f"{root}/filters", "word long, bits long", "bucket")

    def _marked(self, rows: DataFrame) -> DataFrame:
        """Rows with their bucket and their place in its filter."""
        place = F.pmod(F.shiftright(F.xxhash64(F.lit(1), self.key), 6), F.lit(64 * self.words))
        return rows.withColumns(
            {
                "bucket": key_bucket(self.key, self.buckets),
                "_word": F.shiftright(place, 6),
                "_bit": (place % 64).cast("int"),
            }
        )

    @staticmethod
    def _merged(filters: DataFrame) -> DataFrame:
        return filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))

    def land(self, batch: DataFrame, run: str, number: int) -> None:
        fresh = staged(self._marked(dedup_records(batch, self.key, self.order)), "arrived-keys")
        filters = self._merged(self.filters.read(self.filters.slots_of(fresh, "bucket")))
        filters = filters.withColumnRenamed("word", "_word")
        seen = F.expr("shiftrightunsigned(bits, _bit) & 1L") == 1
        keys = fresh.join(filters, ["bucket", "_word"]).filter(seen).select("bucket", self.key)
        keys = staged(keys, "maybe-known-keys")
        slots = self.rows.slots_of(keys, "bucket")
        new = fresh
        if slots:
            held = self.rows.read(slots).select(F.col(self.key).alias("_key"), "bucket").alias("held")
            same = F.col("_key").eqNullSafe(F.col(self.key)) & (F.col("held.bucket") == F.col("k.bucket"))
            known = keys.alias("k").join(held, same, "left_semi").select(F.col(self.key).alias("_known"))
            new = fresh.join(known, F.col("_known").eqNullSafe(F.col(self.key)), "left_anti")
        new = staged(new, "new-rows")
        bits = new.groupBy("bucket", F.col("_word").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, _bit))").alias("bits")
        )
        # the filter first: one that knows more than the rows is harmless, one that knows less is not
        self.filters.add(bits, run, number)
        self.rows.add(new, run, number)
        self.filters.fold(rewrite=self._merged, least=self.fold_at)
        self.rows.fold(least=self.fold_at)

    def read(self) -> DataFrame:
        return self.rows.read().drop("bucket")


class KeywordTable:
    """Top keywords of every window, from stored counts: no text is read or tokenised twice.

    A batch adds (pane, id, word, tf) rows to their hours (or days), then the windows that it touches
    are ranked again from the counts of their panes alone. Which slots those are is settled first, so
    that nothing else is listed or opened. A window's newest ranking counts.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        size: str = keywords.SIZE,
        slide: str = keywords.SLIDE,
        ts: str = "timestamp",
        text: str = "text",
        id: str = "id",
        unit: str = "hour",
        k: int = keywords.TOP_K,
        vocab_size: int = keywords.VOCAB_SIZE,
        min_df: int = 1,
        fold_at: int = FOLD_AT,
        **options,
    ) -> None:
        self.size, self.slide, self.ts, self.text, self.id, self.unit = size, slide, ts, text, id, unit
        self.k, self.vocab_size, self.min_df, self.options, self.fold_at = k, vocab_size, min_df, options, fold_at
        time, key = schema[ts].dataType.simpleString(), schema[id].dataType.simpleString()
        self.panes = Ledger(spark, f"{root}/panes", f"pane {time}, id {key}, word string, tf long", "slot")
        ranked = f"word string, tfidf double, rank int, window_start {time}, window_end {time}, version long"
        self.windows = Ledger(spark, f"{root}/windows", ranked, "slot")

    def _windows_of(self, batch: DataFrame) -> DataFrame:
        """The windows that hold a row of the batch."""
        panes = batch.select(win.pane(self.ts, self.size, self.slide).alias("pane")).distinct()
        starts = panes.select(win.window_starts("pane", self.size, self.slide).alias("window_start"))
        return starts.distinct().select(*win.bounds(self.size))

    def _panes_of(self, windows: DataFrame) -> DataFrame:
        """(pane, slot) of all panes in the windows."""
        step = F.expr(f"INTERVAL {win.pane_width(self.size, self.slide)}")
        panes = F.explode(F.sequence(F.col("window_start"), F.col("window_end") - step, step))
        return windows.select(panes.alias("pane")).distinct().withColumn("slot", time_slot("pane", self.unit))

    def land(self, batch: DataFrame, run: str, number: int) -> None:
        _only_run(self.panes, run)
        batch = batch.withColumnRenamed(self.id, "id")
        terms = keywords.pane_terms(batch, self.size, self.slide, self.ts, self.text, ["id"], **self.options)
        self.panes.add(terms.withColumn("slot", time_slot("pane", self.unit)), run, number)
        touched = staged(self._windows_of(batch), "touched-windows")
        panes = staged(self._panes_of(touched), "touched-panes")
        near = self.panes.read(self.panes.slots_of(panes)).drop("slot").join(panes, "pane", "left_semi")
        top = keywords.top_of_terms(
            near, self.size, self.slide, self.k, "id", vocab_size=self.vocab_size, min_df=self.min_df
        )
        top = top.join(touched, keywords.WINDOW, "left_semi").withColumns(
            {
                "version": F.lit(self.windows.manifest()["version"]).cast("long"),
                "slot": time_slot("window_start", self.unit),
            }
        )
        self.windows.add(top, run, number)
        self.panes.fold(least=self.fold_at)
        self.windows.fold(rewrite=self._newest, least=self.fold_at)

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        newest = F.max("version").over(Window.partitionBy("window_start"))
        return rows.withColumn("_newest", newest).filter("version = _newest").drop("_newest")

    def read(self, slots: Iterable[str] | None = None) -> DataFrame:
        """(word, tfidf, rank, window_start, window_end), as ``windowed_top_keywords`` gives them."""
        return self._newest(self.windows.read(slots)).drop("version", "slot")


class BoardTable:
    """The dashboard's tables over all rows that have arrived, and over the newest ones.

    A batch of scored rows adds sums, counts of values, of words and of times, and its own newest
    rows. Values are counted as they are (scores have four decimals), so bins may be chosen on
    reading. Nothing grows with the rows but the counts by exact time.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        ts: str = "timestamp",
        id: str = "id",
        tokens: str = "finished_no_stop_lemmatized",
        latest: int = insights.LATEST_ROWS,
        buckets: int = BUCKETS,
        fold_at: int = FOLD_AT,
    ) -> None:
        self.ts, self.id, self.tokens, self.latest = ts, id, tokens, latest
        self.buckets, self.fold_at = buckets, fold_at
        time = schema[ts].dataType.simpleString()
        self.sums = Ledger(spark, f"{root}/sums", "sentiment string, total double, n long", "part")
        self.values = Ledger(spark, f"{root}/values", "x double, n long", "part")
        self.times = Ledger(spark, f"{root}/times", f"at {time}, total double, n long", "day")
        self.words = Ledger(spark, f"{root}/words", "word string, n long", "bucket")
        self.newest = Ledger(spark, f"{root}/newest", schema, "part")
        # each ledger with what a batch adds to it and how its sources merge
        self.parts = (
            (self.sums, self._sums_of, lambda rows: _added(rows, "part", "sentiment")),
            (self.values, self._values_of, lambda rows: _added(rows, "part", "x")),
            (self.times, self._times_of, lambda rows: _added(rows, "day", "at")),
            (self.words, self._words_of, lambda rows: _added(rows, "bucket", "word")),
            (self.newest, self._newest_of, self._newest_of),
        )

    def _sums_of(self, rows: DataFrame) -> DataFrame:
        scores = rows.select(insights.SENTIMENTS).unpivot([], insights.SENTIMENTS, "sentiment", "score")
        sums = scores.groupBy("sentiment").agg(F.sum("score").alias("total"), F.count("score").alias("n"))
        return sums.withColumn("part", F.lit("all"))

    def _values_of(self, rows: DataFrame) -> DataFrame:
        return insights.value_counts(rows, "compound").withColumn("part", F.lit("all"))

    def _times_of(self, rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(F.col(self.ts).alias("at")).agg(
            F.sum("compound").alias("total"), F.count("compound").alias("n")
        )
        return sums.withColumn("day", time_slot("at"))

    def _words_of(self, rows: DataFrame) -> DataFrame:
        counts = insights.word_counts(rows, self.tokens)
        return counts.withColumn("bucket", key_bucket("word", self.buckets))

    def _newest_of(self, rows: DataFrame) -> DataFrame:
        return insights.latest_rows(rows, self.latest, self.ts, self.id).withColumn("part", F.lit("all"))

    def land(self, batch: DataFrame, run: str, number: int) -> None:
        _only_run(self.sums, run)
        rows = staged(batch, "scored-batch")
        for ledger, of, merge in self.parts:
            ledger.add(of(rows), run, number)
            ledger.fold(rewrite=merge, least=self.fold_at)

    def read(self) -> dict[str, DataFrame]:
        """The table behind each chart, as ``insights`` gives them for the whole table."""
        means = _added(self.sums.read(), "sentiment")
        over_time = _added(self.times.read(), "at")
        mean = F.col("total") / F.when(F.col("n") > 0, F.col("n"))
        values = staged(_added(self.values.read(), "x"), "score-counts")
        return {
            "mean_sentiment": means.select("sentiment", mean.alias("mean")),
            "compound_over_time": over_time.select(F.col("at").alias(self.ts), mean.alias("compound")),
            "word_frequencies": insights.cloud_of(_added(self.words.read(), "word")),
            "compound_histogram": insights.histogram_of(values),
            "compound_density": insights.density_of(values),
            "latest_rows": self._newest_of(self.newest.read()).drop("part"),
        }


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys as one, their totals and counts added up."""
    numbers = [c for c in ("total", "n") if c in rows.columns]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])
