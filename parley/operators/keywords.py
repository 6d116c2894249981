"""Term counts, inverse document frequency and top keywords, per sliding window or globally."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, Tokenizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.functions import windows as win
from parley.functions.rows import best, each
from parley.session import staged
from parley.sources.wordlists import STOP_WORDS

VOCAB_SIZE = 1000
TOP_K = 10
TIE_DECIMALS = 10  # scores equal to this many decimals are a tie
SALTS = 16
#: Window-sized blocks whose windows are ranked together, and the rows of their panes up to which they are
#: ranked in one piece.
STRETCH, MOST_ROWS = 4, 500_000
SIZE, SLIDE = "60 seconds", "5 seconds"
WINDOW = ["window_start", "window_end"]


def filtered_text(
    df: DataFrame,
    text: str = "text",
    stop_words: Collection[str] = STOP_WORDS,
    case_sensitive: bool = True,
) -> DataFrame:
    """Adds ``filtered_text``: the text without stop words, single-spaced. Null texts are left out.

    Stop words go before lower-casing, so "The" stays unless ``case_sensitive`` is False.
    """
    kept = tx.without_words(tx.words(text), stop_words, case_sensitive)
    return df.filter(F.col(text).isNotNull()).withColumn(
        "filtered_text", F.array_join(kept, " ")
    )


def _terms(text: str, remove_stopwords: bool, stop_words: Collection[str], case_sensitive: bool):
    kept = tx.words(text)
    if remove_stopwords:
        kept = tx.without_words(kept, stop_words, case_sensitive)
    return tx.lowered(kept)


def tokenize(
    df: DataFrame,
    text: str = "text",
    remove_stopwords: bool = True,
    stop_words: Collection[str] = STOP_WORDS,
    case_sensitive: bool = True,
) -> DataFrame:
    """Adds ``words``: lower-cased terms. Null texts are left out."""
    return df.filter(F.col(text).isNotNull()).withColumn(
        "words", _terms(text, remove_stopwords, stop_words, case_sensitive)
    )


def term_counts(df: DataFrame, id: str = "id", text: str = "text", **options) -> DataFrame:
    """(id, word, tf): how often each term occurs in each text. Counted inside the row."""
    terms = tokenize(df, text, **options)
    return each(terms, "t", tx.term_runs("words"), id).select(id, "t.word", "t.tf")


def window_texts(
    df: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    ts: str = "timestamp",
    columns: Collection[str] = ("id", "text"),
) -> DataFrame:
    """The texts of each window, one row per (window, text).

    The bag stays rows: a busy window held as one array would have to fit in one task.
    """
    return df.select(
        win.window_starts(ts, size, slide).alias("window_start"), *columns
    ).select(*win.bounds(size), *columns)


def pane_terms(df: DataFrame, size: str, slide: str, ts: str, text: str, extra: list, **options):
    """(pane, extra..., word, tf). Every text also gives ('', 0), so df of '' counts texts."""
    text_marker = F.array(F.struct(F.lit("").alias("word"), F.lit(0).cast("bigint").alias("tf")))
    terms = tokenize(df, text, **options).select(
        win.pane(ts, size, slide).alias("pane"), *extra, "words"
    )
    runs = F.concat(text_marker, tx.term_runs("words"))
    return each(terms, "t", runs, "pane", *extra).select("pane", *extra, "t.word", "t.tf")


def windowed_vocabulary(
    df: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    ts: str = "timestamp",
    text: str = "text",
    vocab_size: int = VOCAB_SIZE,
    min_df: int = 1,
    **options,
) -> DataFrame:
    """(window, word, total_tf, df, n_docs, idf): the most frequent terms of each window.

    Document and term frequencies add up from panes to windows, so texts are counted once and not
    once per overlapping window. The marker is ranked apart from the words and brings the number of
    texts along, which saves a join.
    """
    terms = pane_terms(df, size, slide, ts, text, [], **options)
    return _vocabulary(terms, size, slide, vocab_size, min_df).drop("stretch", "top")


def _vocabulary(
    terms: DataFrame, size: str, slide: str, vocab_size: int, min_df: int, k: int | None = None
) -> DataFrame:
    """``windowed_vocabulary`` of ``pane_terms``, with each word's highest tf in one text (``top``).

    Windows are summed and ranked in arrays, stretch by stretch of time, so a pane is not copied to each
    window over it. A stretch of many rows is cut by word: its parts give their own first
    ``vocab_size`` words, among which the window's are. With ``k``, a caller wants the k best scores
    alone, and of stretches in one part no other words come back.
    """
    sums = terms.groupBy("pane", "word").agg(
        F.count("*").alias("df"), F.sum("tf").alias("tf"), F.max("tf").alias("top")
    )
    dealt = win.dealt_stretches(staged(sums, "pane-sums"), "word", size, STRETCH, MOST_ROWS)
    time = sums.schema["pane"].dataType.simpleString()
    schema = f"window_start {time}, word string, total_tf long, df long, n_docs long, top long, stretch {time}"
    ranked = dealt.groupBy("stretch", "part").applyInArrow(_ranker(size, slide, vocab_size, min_df, k), schema)
    by_tf = Window.partitionBy("stretch", "window_start").orderBy(F.col("total_tf").desc(), "word")
    kept = ranked.withColumn("place", F.row_number().over(by_tf)).filter(F.col("place") <= vocab_size)
    columns = ["word", "total_tf", "df", "n_docs", "top", "stretch"]
    return kept.select(*win.bounds(size), *columns).transform(inverse_doc_freq)


def _ranker(size: str, slide: str, vocab_size: int, min_df: int, k: int | None):
    """Arrow function: the first words of each window that starts in a stretch, or in a part of one.

    It takes nothing from this module along, so executors need not hold it.
    """
    width, step = (1_000_000 * win.duration_seconds(d) for d in (size, slide))
    length, decimals = STRETCH * width, TIE_DECIMALS

    def rank(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        table = table.combine_chunks()
        time = table.schema.field("pane").type
        stretch, part = table["stretch"][0].value, table["part"][0].as_py()
        panes = table["pane"].cast(pa.int64()).to_numpy()
        by_time = np.argsort(panes, kind="stable")
        panes = panes[by_time]
        words = table["word"].combine_chunks().dictionary_encode()
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
        codes, names = words.indices.to_numpy()[by_time], words.dictionary
        df_of, tf_of, top_of = (table[c].to_numpy()[by_time] for c in ("df", "tf", "top"))
        place = np.empty(len(names), np.int64)
        place[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        marker = pc.index(names, "").as_py()
        found = []
        for start in range(-(-stretch // step) * step, stretch + length, step):
            rows = slice(*np.searchsorted(panes, [start, start + width]))
            at = codes[rows]
            if not len(at):
                continue
            df, tf, top = (np.zeros(len(names), np.int64) for _ in range(3))
            np.add.at(df, at, df_of[rows])
            np.add.at(tf, at, tf_of[rows])
            np.maximum.at(top, at, top_of[rows])
            n_docs, df[marker] = df[marker], 0
            kept = np.flatnonzero(df >= max(min_df, 1))
            if len(kept) > vocab_size:
                least = np.partition(tf[kept], len(kept) - vocab_size)[len(kept) - vocab_size]
                kept = kept[tf[kept] >= least]
                kept = kept[np.lexsort((place[kept], -tf[kept]))[:vocab_size]]
            if k is not None and part < 0 and len(kept) > k:
                score = np.round(top[kept] * np.log((n_docs + 1) / (df[kept] + 1)), decimals)
                kept = kept[np.lexsort((place[kept], -score))[:k]]
            found.append((start, kept, tf[kept], df[kept], np.full(len(kept), n_docs), top[kept]))
        starts = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
        columns = [np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(1, 6)]
        return pa.table(
            {
                "window_start": pa.array(starts).cast(time),
                "word": names.take(pa.array(columns[0])),
                **{n: pa.array(c) for n, c in zip(("total_tf", "df", "n_docs", "top"), columns[1:], strict=True)},
                "stretch": pa.array(np.full(len(starts), stretch)).cast(time),
            }
        )

    return rank


def inverse_doc_freq(vocabulary: DataFrame) -> DataFrame:
    """Adds ``idf`` = ln((n_docs + 1) / (df + 1))."""
    ratio = (F.col("n_docs") + 1).cast("double") / (F.col("df") + 1).cast("double")
    return vocabulary.withColumn("idf", F.log(ratio))


def windowed_top_keywords(
    df: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    k: int = TOP_K,
    ts: str = "timestamp",
    text: str = "text",
    id: str = "id",
    grain: str = "doc_word",
    vocab_size: int = VOCAB_SIZE,
    min_df: int = 1,
    **options,
) -> DataFrame:
    """(word, tfidf, rank, window_start, window_end): the k highest scores of every window.

    ``grain="doc_word"`` ranks (text, word) pairs, so a word may come more than once; ``"word"``
    ranks each word by its best text. Ties go to the smaller word, then the higher tf, then the
    smaller id.

    Within a window all pairs of one word share the idf, so a word's best pair has its highest tf, and
    a word places only if fewer than k words have a better best pair. So the sums that rank a window's
    vocabulary also pick its k words, in the same task, and pairs are looked up for those alone.
    Texts are tokenised once; for pairs both sides come from what that wrote.
    """
    if grain == "word":
        terms = pane_terms(df, size, slide, ts, text, [], **options)
    else:
        terms = staged(pane_terms(df, size, slide, ts, text, [id], **options), "pane-terms")
    return top_of_terms(terms, size, slide, k, id, grain, vocab_size, min_df)


def top_of_terms(
    terms: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    k: int = TOP_K,
    id: str = "id",
    grain: str = "doc_word",
    vocab_size: int = VOCAB_SIZE,
    min_df: int = 1,
) -> DataFrame:
    """``windowed_top_keywords`` from stored ``pane_terms``, which are read twice (for words: once)."""
    if grain not in ("doc_word", "word"):
        raise ValueError(f"grain is 'doc_word' or 'word', not {grain!r}")
    by_score = Window.partitionBy("stretch", "window_start").orderBy(_best_first(), "word")
    words = (
        _vocabulary(terms, size, slide, vocab_size, min_df, k)
        .withColumn("tfidf", F.col("top") * F.col("idf"))
        .withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
    )
    if grain == "word":
        return words.select("word", "tfidf", "rank", *WINDOW)
    words = staged(words.select(*WINDOW, "word", "idf"), "placing-words")
    blocks = win.with_blocks(words, size, slide).select("block", "word").distinct()
    pairs = terms.filter(F.col("word") != "").withColumn("block", win.block("pane", size))
    pairs = pairs.join(blocks, ["block", "word"], "left_semi").drop("block")
    per_pane = best(pairs, ["pane", "word"], [F.col("tf").desc(), id], k, "place", id)
    scored = _score(per_pane, words, size, slide)
    ranked = best(scored, ["window_start"], [_best_first(), "word", F.col("tf").desc(), id], k, "rank", "word")
    return ranked.select("word", "tfidf", "rank", *WINDOW)


def _score(
    pairs: DataFrame, vocabulary: DataFrame, size: str, slide: str, also: Sequence[str] = ()
) -> DataFrame:
    """(pane, word, tf, ..) pairs with the idf of each window that covers the pane and holds the word.

    Both sides meet in window-sized blocks of time: a pair lies in one block, a window reaches into
    two at most. So neither the pairs nor the vocabulary are copied once per overlapping window
    before the shuffle, and words outside every vocabulary drop out in the join.
    """
    by_block = win.with_blocks(vocabulary.select(*WINDOW, "word", "idf", *also), size, slide)
    pairs = pairs.withColumn("block", win.block("pane", size))
    if also:  # copies that Spark's estimate leaves out, so it would broadcast them all
        by_block = by_block.hint("merge")
    covered = (F.col("pane") >= F.col("window_start")) & (F.col("pane") < F.col("window_end"))
    return (
        pairs.join(by_block, ["block", "word", *also])
        .filter(covered)
        .withColumn("tfidf", F.col("tf") * F.col("idf"))
    )


def _best_first() -> Column:
    return F.round("tfidf", TIE_DECIMALS).desc()


def doc_top_keywords(
    df: DataFrame,
    size: str = SIZE,
    slide: str = SLIDE,
    k: int = TOP_K,
    ts: str = "timestamp",
    text: str = "text",
    id: str = "id",
    vocab_size: int = VOCAB_SIZE,
    min_df: int = 1,
    **options,
) -> DataFrame:
    """(window_start, window_end, id, word, tfidf, rank): each text's k best words in each window.

    Ids must be unique; run ``dedup_records`` or ``latest_snapshot`` first where polls repeat.
    Pairs are salted by id and the vocabulary, ``vocab_size`` words a window, is copied for each
    salt, so a word that most texts share doesn't fill one task. Of a text's words only those that
    can place in some window are copied to its windows.
    """
    terms = staged(pane_terms(df, size, slide, ts, text, [id], **options), "pane-terms")
    vocabulary = _vocabulary(terms, size, slide, vocab_size, min_df).drop("stretch", "top")
    vocabulary = staged(vocabulary, "vocabulary")
    salt = F.pmod(F.xxhash64(id), F.lit(SALTS)).cast("int")
    pairs = terms.filter(F.col("word") != "").withColumn("salt", salt)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = vocabulary.withColumn("salt", salts)
    scored = _score(_able_to_place(pairs, vocabulary, salts, size, slide, k, id), salted, size, slide, ["salt"])
    ranked = best(scored, ["window_start", id], [_best_first(), "word"], k, "rank", "word")
    return ranked.select(*WINDOW, id, "word", "tfidf", "rank")


def _able_to_place(
    pairs: DataFrame, vocabulary: DataFrame, salts: Column, size: str, slide: str, k: int, id: str
) -> DataFrame:
    """The pairs (pane, id, word, tf, salt) that may be among a text's k best in some window.

    A word's idf differs from window to window. If k words of a text score at least x in every
    window over it, a word that scores less than x in each of them can't place.
    """
    step = F.expr(f"INTERVAL {win.pane_width(size, slide)}")
    panes = F.explode(F.sequence(F.col("window_start"), F.col("window_end") - step, step))
    ranges = (
        vocabulary.select("word", "idf", panes.alias("pane"))
        .groupBy("pane", "word")
        .agg(F.min("idf").alias("low"), F.max("idf").alias("high"), F.count("*").alias("held"))
        .withColumn("salt", salts)
    )
    windows = -(-win.duration_seconds(size) // win.duration_seconds(slide))
    sure = F.when(F.col("held") >= windows, F.col("tf") * F.col("low"))
    own = Window.partitionBy(id).orderBy(F.col("sure").desc_nulls_last())
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slack = 2 * 10.0**-TIE_DECIMALS
    return (
        pairs.join(ranges.hint("merge"), ["pane", "word", "salt"])
        .withColumn("sure", sure)
        .withColumn("bar", F.nth_value("sure", k).over(whole))
        .filter(F.col("bar").isNull() | (F.col("tf") * F.col("high") + slack >= F.col("bar")))
        .select(*pairs.columns)
    )


def tfidf_global(
    df: DataFrame,
    id: str = "id",
    text: str = "text",
    vocab_size: int | None = VOCAB_SIZE,
    min_df: int = 1,
    **options,
) -> DataFrame:
    """(id, word, tfidf) over the whole table with one vocabulary, for the words a text has.

    The vocabulary holds the ``vocab_size`` most frequent words (ties: the smaller word), or all of
    them where that is None. Texts are tokenised once; counts and weights come from what that wrote.
    """
    counts = staged(term_counts(df.select(id, text), id, text, **options), "term-counts")
    n_docs = df.filter(F.col(text).isNotNull()).count()
    vocabulary = (
        counts.groupBy("word")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))
        .filter(F.col("df") >= min_df)
    )
    if vocab_size is not None:
        vocabulary = vocabulary.orderBy(F.col("total_tf").desc(), "word").limit(vocab_size)
    weights = vocabulary.withColumn("n_docs", F.lit(n_docs)).transform(inverse_doc_freq)
    weights = staged(weights.select("word", "idf"), "term-weights")
    return counts.join(weights, "word").select(id, "word", (F.col("tf") * F.col("idf")).alias("tfidf"))


def tfidf_pipeline(vocab_size: int = VOCAB_SIZE, min_df: float = 1.0) -> Pipeline:
    """The same as a pipeline of estimators: ``filtered_text`` to ``features`` vectors."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol="filtered_text", outputCol="words"),
            CountVectorizer(
                inputCol="words", outputCol="counts", vocabSize=vocab_size, minDF=min_df
            ),
            IDF(inputCol="counts", outputCol="features"),
        ]
    )


def tfidf_vectors(
    df: DataFrame,
    id: str = "id",
    text: str = "text",
    vocab_size: int = VOCAB_SIZE,
    min_df: float = 1.0,
    **options,
) -> DataFrame:
    """(id, word, tfidf) by way of the pipeline; of equally frequent words it picks any."""
    texts = filtered_text(df.select(id, text), text, **options).select(id, "filtered_text")
    texts = staged(texts, "filtered-texts")
    model = tfidf_pipeline(vocab_size, min_df).fit(texts)
    return vector_terms(model.transform(texts).select(id, "features"), model.stages[1].vocabulary)


def vector_terms(vectors: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Term vectors as rows: one (.., word, tfidf) per stored entry, of a dense vector per non-zero.

    The vocabulary is at most the fitted model's own size, which its ``vocabSize`` bounds.
    """
    spark = vectors.sparkSession
    names = spark.createDataFrame(list(enumerate(vocabulary)), "term int, word string")
    others = [c for c in vectors.columns if c != "features"]
    raw = vectors.select(*others, F.unwrap_udt("features").alias("v"))
    places = F.sequence(F.lit(0), F.size("v.values") - 1)
    indices = F.when(F.col("v.type") == 0, F.col("v.indices")).when(F.size("v.values") > 0, places)
    entries = (
        raw.select(*others, F.arrays_zip(indices.alias("term"), F.col("v.values").alias("tfidf")).alias("e"), "v.type")
        .select(*others, "type", F.inline("e"))
        .toDF(*others, "type", "term", "tfidf")
        .filter((F.col("type") == 0) | (F.col("tfidf") != 0))
    )
    return entries.join(names, "term").select(*others, "word", "tfidf")
