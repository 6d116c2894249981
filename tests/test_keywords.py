import collections
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.functions.rows import best
from parley.operators import keywords as kw

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id string, timestamp timestamp, text string"
ONE = {"size": "1 hour", "slide": "1 hour"}


def docs(spark, *texts, minutes=0):
    rows = [(str(i), T0 + dt.timedelta(minutes=minutes * i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stop_words_go_before_lower_casing(spark):
    df = docs(spark, "The  cat and the\tdog ", "the", "", None, "a b c")
    kept = {r["id"]: r["filtered_text"] for r in kw.filtered_text(df).collect()}
    assert kept == {"0": "The cat dog", "1": "", "2": "", "4": "b c"}
    fixed = kw.filtered_text(df, case_sensitive=False).filter("id = '0'").first()
    assert fixed["filtered_text"] == "cat dog"


def test_tokenize_with_and_without_stop_words(spark):
    df = docs(spark, "The Cat the")
    assert kw.tokenize(df).first()["words"] == ["the", "cat"]
    assert kw.tokenize(df, remove_stopwords=False).first()["words"] == ["the", "cat", "the"]


@pytest.mark.parametrize("text", ["b a b c a b", "x", "", "É é ß"])
def test_term_runs_count_like_a_counter(spark, text):
    row = spark.createDataFrame([(text,)], "text string").select(
        tx.term_runs(tx.words("text")).alias("t")
    )
    assert {r["word"]: r["tf"] for r in row.first()["t"]} == collections.Counter(text.split())


def test_repeated_ids_stay_separate_texts(spark):
    rows = [("a", T0, "cat dog"), ("a", T0, "cat"), ("b", T0, "fish")]
    df = spark.createDataFrame(rows, SCHEMA)
    voc = {r["word"]: r for r in kw.windowed_vocabulary(df, **ONE).collect()}
    assert voc["cat"]["df"] == 2 and voc["cat"]["n_docs"] == 3


def test_idf_counts_texts_without_terms(spark):
    df = docs(spark, "cat", "cat dog", "the", None)
    voc = {r["word"]: r for r in kw.windowed_vocabulary(df, **ONE).collect()}
    assert set(voc) == {"cat", "dog"}
    assert voc["cat"]["n_docs"] == 3
    assert voc["dog"]["idf"] == pytest.approx(math.log(4 / 2))


def test_one_text_in_a_window_scores_zero(spark):
    top = kw.windowed_top_keywords(docs(spark, "cat dog cat"), **ONE).collect()
    assert [(r["word"], r["tfidf"], r["rank"]) for r in sorted(top, key=lambda r: r["rank"])] == [
        ("cat", 0.0, 1),
        ("dog", 0.0, 2),
    ]


def test_vocabulary_cap_and_min_df(spark):
    df = docs(spark, "a1 a1 a1 b1 b1 c1", "b1 d1")
    words = lambda **o: sorted(r["word"] for r in kw.windowed_vocabulary(df, **ONE, **o).collect())
    assert words(vocab_size=2) == ["a1", "b1"]
    assert words(min_df=2) == ["b1"]


def test_large_vocabulary_cap_is_salted_and_exact(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), F.col("id"), (F.col("id") * 7 % 5000).alias("v"))
    top = best(df, ["g"], [F.col("v").desc()], 2000, "place", "id")
    assert sorted(r["v"] for r in top.collect()) == list(range(3000, 5000))
    assert sorted(r["place"] for r in top.collect()) == list(range(1, 2001))


def brute_force(rows, size, slide, k, grain, vocab_size=1000):
    """Top keywords by spelling out every window."""
    windows = collections.defaultdict(list)
    for id_, ts, text in rows:
        terms = [w.lower() for w in text.split() if w not in kw.STOP_WORDS]
        at = int((ts - dt.datetime(1970, 1, 1)).total_seconds())
        start = at - at % slide
        while start > at - size:
            windows[start].append((id_, terms))
            start -= slide
    out = []
    for start, texts in windows.items():
        total = collections.Counter(w for _, terms in texts for w in terms)
        vocab = sorted(total, key=lambda w: (-total[w], w))[:vocab_size]
        df = {w: sum(w in terms for _, terms in texts) for w in vocab}
        scored = [
            (round(-tf * math.log((len(texts) + 1) / (df[w] + 1)), 10), w, -tf, id_)
            for id_, terms in texts
            for w, tf in collections.Counter(terms).items()
            if w in df
        ]
        if grain == "word":
            best_of = {}
            for s, w, *_ in sorted(scored):
                best_of.setdefault(w, s)
            scored = [(s, w) for w, s in best_of.items()]
        for rank, (s, w, *_) in enumerate(sorted(scored)[:k], 1):
            out.append((start, rank, w, round(-s, 6)))
    return sorted(out)


@pytest.mark.parametrize("grain", ["doc_word", "word"])
@pytest.mark.parametrize("size, slide", [(3600, 600), (3000, 1200)])
def test_top_keywords_match_brute_force(spark, grain, size, slide):
    words = ["ant", "bee", "cow", "dog", "eel", "fox", "gnu", "hen", "the", "The"]
    rows = [
        (f"d{i:03d}", T0 + dt.timedelta(seconds=i * 97 % 9000),
         " ".join(words[(i * i + j * (i % 5 + 1)) % 10] for j in range(i % 17 + 1)))
        for i in range(150)
    ]
    top = kw.windowed_top_keywords(
        spark.createDataFrame(rows, SCHEMA), f"{size} seconds", f"{slide} seconds", k=5, grain=grain, vocab_size=6
    ).withColumn("s", F.unix_timestamp("window_start"))
    mine = sorted((r["s"], r["rank"], r["word"], round(r["tfidf"], 6) + 0.0) for r in top.collect())
    assert mine == [(s, r, w, t + 0.0) for s, r, w, t in brute_force(rows, size, slide, 5, grain, 6)]


@pytest.mark.parametrize("most_rows", [40, 500_000])
def test_windows_are_summed_without_a_copy_of_each_pane(spark, monkeypatch, most_rows):
    """In one piece or in parts by word; a row goes to one stretch of windows, or two, not to each window over it."""
    dealt = []

    def noted(*args):
        dealt.append(deal(*args))
        return dealt[-1]

    deal = kw.win.dealt_stretches
    monkeypatch.setattr(kw.win, "dealt_stretches", noted)
    monkeypatch.setattr(kw, "MOST_ROWS", most_rows)
    rows = [
        (f"d{i:03d}", T0 + dt.timedelta(seconds=i * 5), " ".join(f"w{(i * j + j) % (7 + i % 30)}" for j in range(i % 9)))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    top = kw.windowed_top_keywords(df, k=4, vocab_size=12).withColumn("s", F.unix_timestamp("window_start"))
    mine = sorted((r["s"], r["rank"], r["word"], round(r["tfidf"], 6) + 0.0) for r in top.collect())
    assert mine == [(s, r, w, t + 0.0) for s, r, w, t in brute_force(rows, 60, 5, 4, "doc_word", 12)]
    words = dealt[0].filter("word <> ''")
    assert words.count() < 1.4 * words.select("pane", "word").distinct().count()
    assert (words.agg(F.max("part")).first()[0] > 0) == (most_rows == 40)


def test_per_document_keywords(spark):
    df = docs(spark, "cat cat dog", "dog fish", "dog")
    top = kw.doc_top_keywords(df, **ONE, k=1)
    assert {r["id"]: r["word"] for r in top.collect()} == {"0": "cat", "1": "fish", "2": "dog"}
    assert all(r["rank"] == 1 for r in top.collect())


def test_relational_and_ml_scores_agree(spark):
    df = docs(spark, "cat cat dog bird", "dog fish fish", "The dog", "owl")
    ml = {(r["id"], r["word"]): r["tfidf"] for r in kw.tfidf_vectors(df).collect()}
    for rows in (kw.doc_top_keywords(df, **ONE, k=100), kw.tfidf_global(df), kw.tfidf_global(df, vocab_size=None)):
        rel = {(r["id"], r["word"]): r["tfidf"] for r in rows.collect()}
        assert ml.keys() == rel.keys()
        for key, value in ml.items():
            assert value == pytest.approx(rel[key])


def test_global_vocabulary_cap(spark):
    df = docs(spark, "q q p", "r r", "p x")
    assert {r["word"] for r in kw.tfidf_global(df, vocab_size=2).collect()} == {"p", "q"}


def test_dense_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors

    rows = [("1", Vectors.dense([0.0, 2.0, 3.0])), ("2", Vectors.sparse(3, [0], [1.5])), ("3", Vectors.sparse(3, [], []))]
    got = kw.vector_terms(spark.createDataFrame(rows, ["id", "features"]), ["x", "y", "z"]).collect()
    assert sorted(map(tuple, got)) == [("1", "y", 2.0), ("1", "z", 3.0), ("2", "x", 1.5)]


def test_window_texts_keep_every_row(spark):
    df = docs(spark, "x", "y", minutes=10)
    bag = kw.window_texts(df, "1 hour", "10 minutes")
    assert bag.columns == ["window_start", "window_end", "id", "text"]
    assert bag.count() == 12


def test_bad_grain(spark):
    with pytest.raises(ValueError):
        kw.windowed_top_keywords(docs(spark, "x"), grain="page")


@pytest.mark.parametrize("size, slide", [("60 seconds", "5 seconds"), ("50 minutes", "20 minutes"), ("1 hour", "1 hour")])
def test_windows_are_counted_and_ranked_in_one_task(spark, size, slide):
    df = docs(spark, "cat dog", "cat", "eel")
    for found in (
        kw.windowed_vocabulary(df, size, slide),
        kw.windowed_top_keywords(df, size, slide, grain="word"),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, plan


def test_only_placing_words_meet_the_pairs(spark, monkeypatch):
    stored = {}

    def noted(df, name):
        stored[name] = df.persist()
        return stored[name]

    monkeypatch.setattr(kw, "staged", noted)
    df = docs(spark, "a1 a1 a1 b1 c1", "a1 b1 d1 d1", "e1", minutes=1)
    top = kw.windowed_top_keywords(df, **ONE, k=2).collect()
    assert [(r["word"], r["rank"]) for r in sorted(top, key=lambda r: r["rank"])] == [("d1", 1), ("a1", 2)]
    assert sorted(r["word"] for r in stored["placing-words"].collect()) == ["a1", "d1"]
