import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import language_id as module
from parley.llm.language_id import fit, grams, keep_identified, language_id
from prose import prose

SOUNDS = {
    "aa": "in on ther and stion ere oua wh".split(),
    "bb": "ñas ció ent osa que rra llo el".split(),
    "cc": "äch und ein sch ung ieß der tz".split(),
}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(SOUNDS))
        text = prose(1000 + i, rng.choice([3, 20, 80]), SOUNDS[lang])
        rows.append((i, text, lang if i % 9 else None, lang))
    rows += [(900, None, "aa", "und"), (901, "12 3!", "bb", "und"), (902, "", None, "und"), (None, prose(1, 30, SOUNDS["aa"]), "aa", "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, true string")


def test_held_out_accuracy(labelled):
    true = {r.doc_id: r.true for r in labelled.collect()}
    got = language_id(labelled, per_language=40, landmarks=8).collect()
    assert len(got) == 244
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if true[r.doc_id] == "und":
            assert (r.lang_pred, r.score) == ("und", 0)
    words = [r for r in got if true[r.doc_id] != "und"]
    assert sum(r.lang_pred == true[r.doc_id] for r in words) >= 0.97 * len(words)


def test_labels_of_held_out_rows_are_not_learned(spark, labelled):
    spoiled = labelled.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "zz").otherwise(F.col("lang")))
    first, second = (sorted(map(tuple, language_id(d).collect()), key=str) for d in (labelled, spoiled))
    assert first == second


def test_nothing_to_learn_from(spark, no_docs, edge_docs):
    assert language_id(no_docs).count() == 0
    unlabelled = edge_docs.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in language_id(unlabelled).collect()} == {("und", 0.0)}


def test_edge_rows(edge_docs, edge_rows):
    got = language_id(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert sum(r.lang_pred == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for _, t in edge_rows)


def test_rejected_rows_go(labelled):
    kept = keep_identified(labelled)
    assert kept.columns == labelled.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {900, 901, 902} and len(ids) >= 235


def test_grams_of_a_text():
    (found,) = grams(pa.array(["Ab1"]))
    a, b, blank = ord("a") + 1, ord("b") + 1, 1
    ones = {blank, a, b}
    twos = {blank << 21 | a, a << 21 | b, b << 21 | blank}
    threes = {blank << 42 | a << 21 | b, a << 42 | b << 21 | blank}
    assert set(found.tolist()) == ones | twos | threes


def test_a_prediction_depends_on_its_text_alone(labelled):
    model = fit(labelled, 40, 8)
    texts = [r.text for r in labelled.limit(50).collect()]
    together, _ = model.outputs_of(pa.array(texts, pa.string()))
    for text, row in zip(texts, together):
        alone, _ = model.outputs_of(pa.array([text], pa.string()))
        assert np.allclose(alone[0], row, atol=1e-5)


def test_a_long_text_in_parts(labelled, monkeypatch):
    model = fit(labelled, 40, 8)
    texts = pa.array([prose(5, 200), None, prose(6, 3), "x" * 500])
    whole, letter = model.outputs_of(texts)
    monkeypatch.setattr("parley.llm.language_id.PART", 50)
    again, same = model.outputs_of(texts)
    assert np.allclose(whole, again, atol=1e-5) and (letter == same).all()


def test_noise_and_unlearned_languages_are_rejected(spark, labelled):
    rng = random.Random(8)
    strange = [
        " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(60)),
        "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=800)),
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια.",
    ]
    rows = spark.createDataFrame([(5000 + i, t, None, "und") for i, t in enumerate(strange)], labelled.schema)
    kept = {r.doc_id for r in keep_identified(labelled.union(rows)).collect()}
    assert not {i for i in kept if i is not None and i >= 5000}
    assert {i for i in range(240)} <= kept


def test_without_labels_texts_with_letters_stay(labelled):
    unlabelled = labelled.withColumn("lang", F.lit(None).cast("string"))
    ids = {r.doc_id for r in keep_identified(unlabelled).collect()}
    assert ids == {None, *range(240)}


def test_scripts_with_more_letters_than_the_table(spark):
    """Two of them share a script and differ in which of its many characters they use."""
    rng = random.Random(9)
    signs = {
        "one": [chr(0x4E00 + 3 * i) for i in range(900)],
        "two": [chr(0x4E01 + 3 * i) for i in range(900)],
        "greek": [chr(c) for c in range(0x3B1, 0x3C9)],
        "hangul": [chr(0xAC00 + 7 * i) for i in range(600)],
    }
    rows = []
    for i in range(400):
        lang = rng.choice(sorted(signs))
        weights = [1 / (k + 1) for k in range(len(signs[lang]))]
        rows.append((i, "".join(rng.choices([*signs[lang], " "], [*weights, 0.5], k=rng.choice([30, 120]))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    true = {i: lang for i, _, lang in rows}
    got = language_id(docs, per_language=60, landmarks=12).collect()
    assert sum(r.lang_pred == true[r.doc_id] for r in got if r.held_out) >= 0.97 * sum(r.held_out for r in got)
    assert keep_identified(docs).count() >= 390
    foreign = spark.createDataFrame(
        [(1000 + i, "".join(rng.choices([chr(0x0E01 + c) for c in range(40)], k=80)), None) for i in range(20)], docs.schema
    )
    assert keep_identified(docs.union(foreign)).filter("doc_id >= 1000").count() == 0


def test_all_labelled_texts_are_learned_from(spark):
    """A letter pair that texts beyond any 200 bring in is a feature, and so are their known shares."""
    rng = random.Random(10)
    rows = [(i, prose(2000 + i, 8, SOUNDS["aa"]) + (" vwvw" if rng.random() < 0.02 else ""), "aa") for i in range(1500)]
    rows += [(5000 + i, prose(4000 + i, 8, SOUNDS["bb"]), "bb") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {(r.lang, r.gram): r.n for r in module._gram_counts(docs).collect()}
    pair = (ord("v") + 1) << 21 | (ord("w") + 1)
    assert counts["aa", 0] == counts["bb", 0] == 1500
    assert counts["aa", pair] == sum("vw" in t for _, t, _ in rows)
    model = fit(docs)
    seen = model.presence(pa.array(["vw"]))[0]
    assert (seen > 0).sum() >= 4 and model.landmarks.shape[1] == 48
    got = language_id(docs).collect()
    assert sum(r.lang_pred == ("aa" if r.doc_id < 5000 else "bb") for r in got) >= 0.99 * len(got)


def test_levels_count_every_held_out_text(spark):
    rows = [(i, "abab baba", "aa") for i in range(3000)]
    odd = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    few = set(odd[:: len(odd) // 9][:9])  # more than 1 % of fold 0, with half of their 3-grams unknown
    docs = spark.createDataFrame([(i, t + (" zyzy" if i in few else ""), g) for i, t, g in rows], "doc_id long, text string, lang string")
    model = fit(docs)
    (level,) = module.rejection_levels(docs, model)
    known = model.evidence(pa.array(["abab baba zyzy"]))[2][0]
    assert known < 0.8 and abs(level - module.KNOWN_MARGIN * known) < 1e-4


def test_counting_holds_few_n_grams():
    """A task reports its counts after a million n-grams, so it holds some 30 MB; the sums are the same."""
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 30_000))) for _ in range(20)]
    taken = []

    def batches():
        for k, text in enumerate(texts):
            taken.append(k)
            yield pa.RecordBatch.from_pydict({"lang": ["x"], "text": [text]})

    total = 0
    for k, rows in enumerate(module._count_grams(batches())):
        if not k:
            assert len(taken) < len(texts)
        total += sum(n for gram, n in zip(rows["gram"].to_pylist(), rows["n"].to_pylist()) if gram)
    assert total == sum(len(g) for t in texts for g in grams(pa.array([t])))
