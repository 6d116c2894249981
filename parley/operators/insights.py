"""The aggregates behind a live dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.functions.rows import each
from parley.sources.files import read_dir_concat

SENTIMENTS = ["neutral", "positive", "negative"]
LATEST_ROWS = 1000
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
CLOUD_WORDS = 200


def mean_sentiment(df: DataFrame) -> DataFrame:
    """(sentiment, mean): one row per score."""
    means = df.agg(*[F.avg(c).alias(c) for c in SENTIMENTS])
    return means.unpivot([], SENTIMENTS, "sentiment", "mean")


def compound_over_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """(ts, compound): mean compound score of each exact time."""
    return df.groupBy(ts).agg(F.avg("compound").alias("compound"))


def simulated_sentiment(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Stand-in scores derived from a record's vote score."""
    # The divisors.
    divisors = {"compound": 100.0, "neutral": 200.0, "positive": 300.0, "negative": 400.0}
    return df.select(
        "id",
        *[(F.col("score") / F.lit(d)).alias(name) for name, d in divisors.items()],
        tx.words("text").alias("finished_no_stop_lemmatized"),
        ts,
    )


def word_frequencies(
    df: DataFrame, tokens: str = "finished_no_stop_lemmatized", k: int | None = CLOUD_WORDS
) -> DataFrame:
    """(word, n, weight): the k most frequent tokens; the weight is relative to the first.

    ``k=None`` keeps every token.
    """
    return cloud_of(word_counts(df, tokens), k)


def word_counts(df: DataFrame, tokens: str = "finished_no_stop_lemmatized") -> DataFrame:
    """(word, n): how often each token occurs."""
    return each(df, "word", F.col(tokens)).groupBy("word").agg(F.count("*").alias("n"))


def cloud_of(counts: DataFrame, k: int | None = CLOUD_WORDS) -> DataFrame:
    """``word_frequencies`` of counted words (word, n)."""
    if k is None:
        top = counts.agg(F.max("n").alias("n")).scalar()
        return counts.withColumn("weight", F.col("n") / top)
    shown = counts.orderBy(F.col("n").desc(), "word").limit(k)
    return shown.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def compound_histogram(
    df: DataFrame, value: str = "compound", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """(bin, bin_start, bin_end, count): equal widths over [min, max], the last bin closed.

    Bins with no value are listed with count 0. Equal values are counted together first. The input
    is read twice, for the range and for the bins: store computed scores beforehand.
    """
    return histogram_of(value_counts(df, value), bins)


def histogram_of(counts: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``compound_histogram`` of counted values (x, n)."""
    stats = _stats(counts).alias("stats")
    low, high = F.col("stats.low"), F.col("stats.high")
    width = (high - low) / F.lit(float(bins))
    place = F.when(high > low, F.floor((F.col("x") - low) / width))
    filled = (
        counts.select("*", stats)
        .groupBy(
            F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("bigint").alias("bin")
        )
        .agg(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))).alias("count"))
    )
    return (
        counts.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(filled, "bin", "left")
        .select("*", stats)
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
    )


def _stats(counts: DataFrame) -> Column:
    """struct<low, high, total, mean> of all values, as one scalar subquery."""
    total = F.sum(F.when(F.col("x").isNotNull(), F.col("n")))
    return counts.agg(
        F.struct(
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            total.alias("total"),
            (F.sum(F.col("x") * F.col("n")) / total).alias("mean"),
        ).alias("stats")
    ).scalar()


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """How often each value occurs, null included."""
    return df.groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))


def compound_density(
    df: DataFrame, value: str = "compound", points: int = DENSITY_POINTS, cells: int | None = None
) -> DataFrame:
    """(point, x, density): Gaussian kernel density on an even grid over [min, max].

    The bandwidth is Scott's rule, std * n^(-1/5). Scores are rounded to four decimals, so the
    values are few; they are counted first and the kernel is summed over distinct values, each task
    adding up its own grid before anything is shuffled. Store computed scores beforehand, as the
    input is read for the range, the variance and the curve.

    With ``cells`` the values may be any number of different ones: each is shared out over the two
    nearest of ``cells`` + 1 even points, and the kernel is summed over those, so that the cost no
    longer depends on the values. With a step of d between them that moves the curve by at most
    (d / h)^2 / (8 h sqrt(2 pi)), h the bandwidth.
    """
    if cells:
        return _binned_density(df, value, points, cells)
    return density_of(value_counts(df, value), points)


def density_of(counts: DataFrame, points: int = DENSITY_POINTS) -> DataFrame:
    """``compound_density`` of counted values (x, n)."""
    measured = counts.select("*", _stats(counts).alias("stats"))
    low, high = F.col("stats.low"), F.col("stats.high")
    total = F.col("stats.total").cast("double")
    off_mean = F.col("x") - F.col("stats.mean")
    squares = measured.agg(F.sum(F.pow(off_mean, F.lit(2)) * F.col("n")).alias("v")).scalar()
    grid_x = low + F.col("point") * (high - low) / F.lit(float(points - 1))
    z = (grid_x - F.col("x")) / F.col("h")
    norm = total * F.col("h") * F.sqrt(2 * F.pi())
    return (
        measured.withColumn("squares", squares)
        .filter((total > 1) & (F.col("squares") > 0))
        .withColumn("h", F.sqrt(F.col("squares") / (total - 1)) * F.pow(total, F.lit(-0.2)))
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point", grid_x.alias("x"))
        .agg(F.sum(F.col("n") * F.exp(-z * z / 2) / norm).alias("density"))
    )


def _binned_density(df: DataFrame, value: str, points: int, cells: int) -> DataFrame:
    values = df.select(F.col(value).cast("double").alias("x")).filter("x is not null and not isnan(x)")
    stats = values.agg(
        F.struct(
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            F.count("x").cast("double").alias("total"),
            F.stddev_samp("x").alias("deviation"),
        ).alias("stats")
    ).scalar()
    low, high, total = F.col("stats.low"), F.col("stats.high"), F.col("stats.total")
    measured = values.select("x", stats.alias("stats")).filter((total > 1) & (high > low))
    place = (F.col("x") - low) / (high - low) * cells
    left = F.least(F.floor(place), F.lit(cells - 1)).cast("int")
    shares = F.array(
        F.struct(F.col("left").alias("cell"), (1 - (F.col("place") - F.col("left"))).alias("weight")),
        F.struct((F.col("left") + 1).alias("cell"), (F.col("place") - F.col("left")).alias("weight")),
    )
    grid = (
        measured.select(place.alias("place"), left.alias("left"))
        .select(F.inline(shares))
        .groupBy("cell")
        .agg(F.sum("weight").alias("weight"))
        .select("*", stats.alias("stats"))
    )
    h = F.col("stats.deviation") * F.pow(total, F.lit(-0.2))
    x = low + F.col("point") * (high - low) / F.lit(float(points - 1))
    z = (x - (low + F.col("cell") * (high - low) / F.lit(float(cells)))) / F.col("h")
    return (
        grid.withColumn("h", h)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("point", x.alias("x"))
        .agg((F.sum(F.col("weight") * F.exp(-z * z / 2) / (F.col("h") * total)) / F.sqrt(2 * F.pi())).alias("density"))
    )


def latest_rows(
    df: DataFrame, n: int = LATEST_ROWS, ts: str = "timestamp", id: str = "id"
) -> DataFrame:
    """The n most recent rows."""
    return df.orderBy(F.col(ts).desc(), F.col(id).desc()).limit(n)


def reference_view(spark, path: str) -> DataFrame:
    """The whole table of reference counts."""
    return read_dir_concat(spark, path)


def accumulate(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Append rows whose columns may differ; what a side lacks is null."""
    return rows.unionByName(more, allowMissingColumns=True)
