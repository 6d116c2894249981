import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.functions import lookup
from parley.operators import annotate as an
from parley.operators import insights
from parley.operators.sentiment import sentiment, sentiment_table
from parley.sources.wordlists import BOOSTERS, LEXICON, NEGATORS, STOP_WORDS


def one(spark, text, **options):
    df = spark.createDataFrame([("1", text)], "id string, text string")
    return an.annotate(df, **options).first()


def test_tokens_normal_forms_and_lemmas(spark):
    row = one(spark, "The Children's, feet (really) were -- \"tired\"!!! a1b l'été")
    assert row["finished_tokenized"] == [
        "The", "Children's", ",", "feet", "(", "really", ")", "were", "--", '"', "tired", "\"!!!",
        "a1b", "l'été",
    ]
    assert row["finished_normalized"] == ["the", "childrens", "feet", "really", "were", "tired", "ab", "lété"]
    assert row["finished_no_stop_lemmatized"] == ["childrens", "foot", "really", "tired", "ab", "lété"]
    assert row["processed_text"] == "childrens foot really tired ab lété"


def test_ascii_letters(spark):
    assert one(spark, "été Ünder", letters="ascii")["finished_normalized"] == ["t", "nder"]


@pytest.mark.parametrize("text", [None, "", " ... "])
def test_texts_without_words(spark, text):
    row = one(spark, text)
    assert row["finished_no_stop_lemmatized"] == [] and row["processed_text"] == ""


def test_stop_word_list_is_whole():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 179


def test_chunks(spark):
    tags = {"big": "JJ", "red": "JJ", "runs": "VB", "of": "IN"}
    df = spark.createDataFrame(
        [("1", "big red dog runs house door key of big runs cat"), ("2", "big red"), ("3", "")],
        "id string, text string",
    )
    chunks = an.noun_chunks(df, tags=tags, lemmas={}).collect()
    assert [(r["id"], r["chunk"]) for r in chunks] == [("1", "big red dog"), ("1", "house door key")]


def test_very_long_noun_run(spark):
    df = spark.createDataFrame([("1", "noun " * 20000), ("2", "x" * 200000)], "id string, text string")
    chunks = an.noun_chunks(df).collect()
    assert len(chunks) == 1 and len(chunks[0]["chunk"].split()) == 20000


def test_lookup_inline_and_joined_agree(spark):
    entries = {f"w{i}": f"v{i}" for i in range(0, 200, 3)} | {"é": "e"}
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 50 != 7, F.transform(F.sequence(F.lit(0), (F.col("id") % 9).cast("int")), lambda i: F.concat(F.lit("w"), i * F.col("id") % 200)))
        .alias("tokens"),
    )
    table = spark.createDataFrame(list(entries.items()), "word string, value string")
    body = lambda t, v: F.coalesce(v, F.concat(t, F.lit("?")))
    inline = lookup.map_tokens(df, "tokens", lookup.small(table), "out", "string", body)
    joined = lookup.map_tokens(df, "tokens", table, "out", "string", body)
    key = lambda r: r["id"]
    assert sorted(inline.collect(), key=key) == sorted(joined.collect(), key=key)
    assert sorted(inline.columns) == sorted(joined.columns)


@pytest.mark.parametrize("most", [lookup.SMALL, 1])
def test_a_table_of_words_moves_rows_only_where_many_are_found(spark, monkeypatch, most):
    written = []

    def noted(df, name):
        written.append(name)
        return stage(df, name)

    stage = lookup.staged
    monkeypatch.setattr(lookup, "staged", noted)
    monkeypatch.setattr(lookup, "SMALL", most)
    df = spark.createDataFrame([(1, ["a", None, "b", "a"]), (2, []), (3, None), (4, ["x"])], "id int, tokens array<string>")
    table = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4), (None, 5)], "word string, value int")
    out = lookup.join_lookup(df, "tokens", table, "out", "double")
    assert out.columns == ["id", "tokens", "out"]
    assert {r["id"]: r["out"] for r in out.collect()} == {1: [1.0, None, 3.0, 1.0], 2: [], 3: None, 4: [None]}
    assert written == (["lookup-rows"] if most == 1 else [])
    if most > 1:
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_small_mapping_stops_at_the_limit(spark):
    table = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "word string, value int")
    assert lookup.small(table) == {"a": 1, "b": 3}
    with pytest.raises(ValueError):
        lookup.small(table, most=1)


def test_stop_words_from_a_table(spark):
    df = spark.createDataFrame([("1", "we like the cat")], "id string, text string")
    table = spark.createDataFrame([("We",), ("the",)], "word string")
    for stop_words in (table, ["We", "the"]):
        row = an.annotate(df, stop_words=stop_words).first()
        assert row["processed_text"] == "like cat"


# -- scores -------------------------------------------------------------------------------------


def scores(spark, tokens, **options):
    df = spark.createDataFrame([(tokens,)], "finished_no_stop_lemmatized array<string>")
    return sentiment(df, **options).select("sentiment.*").first()


def expected(tokens, rules=True):
    """The published rules, token by token."""
    values = []
    for i, word in enumerate(tokens):
        v = LEXICON.get(word)
        if v is None or (rules and word in BOOSTERS):
            values.append(0.0)
            continue
        if rules:
            for back, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
                if i < back or tokens[i - back] in LEXICON:
                    continue
                before = tokens[i - back]
                push = BOOSTERS.get(before, 0.0) * damp
                v += -push if v < 0 else push
                spared = before == "without" and "doubt" in tokens[i - back + 1 : i]
                if (before in NEGATORS or "n't" in before) and not spared:
                    v *= -0.74
            if i and tokens[i - 1] == "least" and tokens[max(0, i - 2) : i - 1] not in (["at"], ["very"]):
                v *= -0.74
        values.append(v)
    s = sum(values)
    pos = sum(v + 1 for v in values if v > 0)
    neg = sum(1 - v for v in values if v < 0)
    neu = sum(v == 0 for v in values)
    whole = pos + neg + neu
    if not whole:
        return (0.0, 0.0, 0.0, 0.0)
    return (s / math.sqrt(s * s + 15), pos / whole, neu / whole, neg / whole)


@pytest.mark.parametrize(
    "tokens",
    [
        ["good"],
        ["really", "good"],
        ["really", "bad"],
        ["never", "good"],
        ["never", "really", "good", "day"],
        ["without", "doubt", "good"],
        ["without", "good"],
        ["least", "good"],
        ["barely", "very", "dont", "bad"],
        ["unknown"],
        ["dont", "love", "hate"],
        ["didn't", "like"],
        [],
    ],
)
@pytest.mark.parametrize("rules", [True, False])
def test_scores_follow_the_rules(spark, tokens, rules):
    got = scores(spark, tokens, rules=rules)
    want = expected(tokens, rules)
    assert got["compound"] == pytest.approx(want[0], abs=6e-5)
    for name, value in zip(("positive", "neutral", "negative"), want[1:]):
        assert got[name] == pytest.approx(value, abs=6e-4)


WORDS = ["good", "bad", "really", "barely", "never", "without", "doubt", "least", "table", "dont", "love"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=8), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, finished_no_stop_lemmatized array<string>")
    for r in sentiment(df).collect():
        want = expected(texts[r["id"]])
        got = r["sentiment"]
        assert got["compound"] == pytest.approx(want[0], abs=6e-5)
        parts = got["positive"] + got["neutral"] + got["negative"]
        assert parts == pytest.approx(1.0, abs=0.002) or (parts == 0 and not texts[r["id"]])


def compound(total):
    return pytest.approx(total / math.sqrt(total * total + 15), abs=1e-4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("without doubt truly happy", 2.7),  # 2.7 stands: "without" is three back, "doubt" between
        ("without truly doubt happy", 2.7),
        ("without a doubt happy", 2.7),
        ("without any real happy", 2.7 * -0.74),
        ("never so happy", (2.7 + 0.293) * 1.5),
        ("never felt so happy", (2.7 + 0.293) * 1.25),
        ("at least happy", 2.7),
        ("very least happy", 2.7 + 0.293 * 0.95),  # no flip, and "very" two back still raises
        ("least happy", 2.7 * -0.74),
        ("x y the broken heart", 0.0),  # neither word is in the table below
        ("x y bad ass", -2.5 + 1.5),  # "bad" has but two tokens before it and keeps its own score
        ("x y z yeah right", 0.0),
        ("happy x y but happy", 2.7 * 0.5 + 2.7 * 1.5),
        ("x y z happy", 2.7),
    ],
)
def test_hand_worked_scores(spark, text, total):
    lexicon = {"happy": 2.7, "bad": -2.5, "ass": -2.5}
    got = scores(spark, text.split(), lexicon=lexicon)["compound"]
    assert got == compound(total)


def test_phrases_with_three_tokens_before(spark):
    lexicon = {"heart": 2.0, "right": 1.0, "stop": -1.2}
    for text, total in (("x y broken heart", -2.9), ("x y yeah right", -2.0), ("x y bus stop", 0.0), ("y broken heart", 2.0)):
        assert scores(spark, text.split(), lexicon=lexicon)["compound"] == compound(total), text


def test_sentiment_table_layout(spark):
    df = spark.createDataFrame([("1", "I really love this")], "id string, text string")
    table = sentiment_table(df)
    assert table.columns == [
        "id", "text", "finished_no_stop_lemmatized", "finished_normalized", "finished_tokenized",
        "processed_text", "compound", "positive", "neutral", "negative",
    ]
    assert table.first()["compound"] > 0.5


def test_a_filter_on_a_score_does_not_score_twice(spark):
    df = spark.createDataFrame([("1", "x")], "id string, text string")
    plan = sentiment_table(df).filter("compound > 0")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("regexp_extract_all") == 1


# -- dashboard ----------------------------------------------------------------------------------


def values(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "compound double")


def test_histogram_closes_the_last_bin_and_fills_gaps(spark):
    rows = insights.compound_histogram(values(spark, 0.0, 0.1, 1.0, 1.0, None), bins=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 2]
    assert rows[0]["bin_start"] == 0.0 and rows[-1]["bin_end"] == 1.0


def test_histogram_of_one_value(spark):
    rows = insights.compound_histogram(values(spark, 0.5, 0.5), bins=3).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [2, 0, 0]


def test_density_matches_brute_force(spark):
    xs = [0.1, 0.1, 0.4, 0.75, 0.9]
    rows = insights.compound_density(values(spark, *xs, None), points=11).orderBy("point").collect()
    mean = sum(xs) / 5
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / 4) * 5 ** -0.2
    for r in rows:
        want = sum(math.exp(-(((r["x"] - x) / h) ** 2) / 2) for x in xs) / (5 * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want)
    assert rows[0]["x"] == 0.1 and rows[-1]["x"] == pytest.approx(0.9)


def test_density_of_one_value_is_empty(spark):
    assert insights.compound_density(values(spark, 0.5, 0.5)).count() == 0


def test_word_frequencies(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), (["b", "c"],), ([],)], "finished_no_stop_lemmatized array<string>")
    top = insights.word_frequencies(df, k=2).collect()
    assert sorted((r["word"], r["n"], r["weight"]) for r in top) == [("a", 2, 1.0), ("b", 2, 1.0)]
    every = insights.word_frequencies(df, k=None).collect()
    assert sorted((r["word"], r["weight"]) for r in every) == [("a", 1.0), ("b", 1.0), ("c", 0.5)]


def test_simulated_scores(spark):
    df = spark.createDataFrame([("1", 60, "a  b", 5)], "id string, score int, text string, timestamp int")
    row = insights.simulated_sentiment(df).first()
    assert (row["compound"], row["neutral"], row["positive"], row["negative"]) == (0.6, 0.3, 0.2, 0.15)
    assert row["finished_no_stop_lemmatized"] == ["a", "b"]


def test_mean_sentiment_and_latest(spark):
    df = spark.createDataFrame(
        [("a", 1, 0.2, 0.5, 0.3), ("b", 2, 0.4, 0.5, 0.1)],
        "id string, timestamp int, positive double, neutral double, negative double",
    )
    means = {r["sentiment"]: round(r["mean"], 6) for r in insights.mean_sentiment(df).collect()}
    assert means == {"positive": 0.3, "neutral": 0.5, "negative": 0.2}
    assert insights.latest_rows(df, 1).first()["id"] == "b"
