import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import insights
from parley.operators import sequence_tags as st

OPTIONS = {"the": "DT", "they": "PRP", "run": "NN|VB", "fast": "JJ|RB", "old": "JJ", "walk": "VB|NN|VB", "often": "RB"}


def tagged(spark, texts, costs=None, options=OPTIONS):
    rows = [(k, t.split() if t is not None else None) for k, t in enumerate(texts)]
    df = st.tag_sets(spark.createDataFrame(rows, "id int, lemmatized array<string>"), options)
    costs = costs or st.learn(df)
    got = {r.id: r.pos for r in st.sequence_tag(df, costs).collect()}
    sets = {r.id: r.tag_sets for r in df.collect()}
    return got, sets, costs


def cheapest(sets, costs):
    """The cheapest of every sequence."""
    ways = []
    for path in itertools.product(*[s.split("|") for s in sets]):
        whole = [st.START, *path, st.END]
        ways.append((sum(costs[a, b] for a, b in itertools.pairwise(whole)), path))
    least = min(w[0] for w in ways)
    return [w[1] for w in ways if w[0] == least]


def test_neighbours_settle_open_words(spark):
    texts = ["the run", "the old run", "they often go"] * 5 + ["the walk", "they run", "they walk fast", "the fast run"]
    texts += ["the cat", "they sing", "the old cat"] * 5
    options = OPTIONS | {"sing": "VB", "go": "VB"}
    got, sets, _ = tagged(spark, texts, options=options)
    by_text = dict(zip(texts, got.values(), strict=False))
    assert by_text["the run"] == ["DT", "NN"] and by_text["they run"] == ["PRP", "VB"]
    assert by_text["the walk"] == ["DT", "NN"] and by_text["the old run"] == ["DT", "JJ", "NN"]
    assert sets[15] == ["DT", "NN|VB"]


def test_against_every_sequence(spark):
    rng = random.Random(3)
    words = [*OPTIONS, "cat", "dog"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(80)]
    got, sets, costs = tagged(spark, texts)
    for k, pos in got.items():
        assert tuple(pos) in cheapest(sets[k], costs)
        assert all(tag in options.split("|") for tag, options in zip(pos, sets[k], strict=True))


def test_short_runs_give_the_same_paths(spark, monkeypatch):
    """Runs from the table, beyond it and of sets that it lacks; with equal costs too."""
    sets = st.open_sets(OPTIONS | {"none": None})
    assert sets == ["JJ|RB", "NN|VB"]
    rng = random.Random(5)
    texts = [" ".join(rng.choices([*OPTIONS, "cat"], k=rng.randint(1, 12))) for _ in range(60)] + ["run " * 40, "", None]
    plain, _, costs = tagged(spark, texts)
    flat = dict.fromkeys(costs, 1)
    rows = [(k, t.split() if t is not None else None) for k, t in enumerate(texts)]
    df = st.tag_sets(spark.createDataFrame(rows, "id int, lemmatized array<string>"), OPTIONS)
    table = st.short_runs(costs, sets)
    assert "^ NN|VB JJ|RB $" in table and 0 < len(table) <= st.MOST_RUNS
    for cost in (costs, flat):
        want = {r.id: r.pos for r in st.sequence_tag(df, cost).collect()}
        for few in (sets, sets[:1]):
            assert {r.id: r.pos for r in st.sequence_tag(df, cost, few).collect()} == want
    assert plain == {r.id: r.pos for r in st.sequence_tag(df, costs, sets).collect()}
    monkeypatch.setattr(st, "MOST_RUNS", len(sets))
    assert st.short_runs(costs, sets) == {} and st.short_runs({}, sets) == {}


def test_equal_paths_take_the_smaller_tag(spark):
    tags = ["JJ", "NN", "RB", "VB", "DT", "PRP", st.START, st.END]
    flat = {(a, b): 1 for a in tags for b in tags}
    got, _, _ = tagged(spark, ["run fast walk", "fast"], flat)
    assert got == {0: ["NN", "JJ", "NN"], 1: ["JJ"]}


def test_edge_rows(spark):
    got, sets, _ = tagged(spark, ["", None, "run", "cat", "run " * 3000, "cat run " * 3000])
    assert got[0] == [] and got[1] in ([], None) and len(got[4]) == 3000 and len(got[5]) == 6000
    assert sets[3] == ["NN"] and got[3] == ["NN"]


def test_learning():
    pairs = [("DT", "NN|VB", 50), ("DT", "NN", 20), ("PRP", "VB", 20), ("PRP", "NN|VB", 1)]
    costs = st.learned_costs(pairs)
    assert costs["DT", "NN"] < costs["DT", "VB"] and costs["PRP", "VB"] < costs["PRP", "NN"]
    for a in ("DT", "PRP"):  # chances of what follows add up to one
        assert abs(sum(math.exp(-costs[a, b] / st.SCALE) for b in ("NN", "VB")) - 1) < 1e-5
    assert st.learned_costs([]) == {}


def test_tables_as_rows_and_too_many_sets(spark, monkeypatch):
    table = spark.createDataFrame(list(OPTIONS.items()), "word string, tags string")
    texts = ["the run", "they walk fast", "cat"]
    assert tagged(spark, texts, options=table)[0] == tagged(spark, texts)[0]
    monkeypatch.setattr(st, "MOST_SETS", 1)
    with pytest.raises(ValueError, match="sets of tags"):
        tagged(spark, texts)


def test_binned_density_is_within_its_bound(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) if rng.random() < 0.6 else rng.uniform(2, 9) for _ in range(3000)] + [None, 2.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "compound double").repartition(5)
    exact = {r.point: r for r in insights.compound_density(df).collect()}
    known = [v for v in values if v is not None]
    mean = sum(known) / len(known)
    h = math.sqrt(sum((v - mean) ** 2 for v in known) / (len(known) - 1)) * len(known) ** -0.2
    for cells in (50, 400, 4000):
        binned = {r.point: r for r in insights.compound_density(df, cells=cells).collect()}
        step = (max(known) - min(known)) / cells
        bound = (step / h) ** 2 / (8 * h * math.sqrt(2 * math.pi))
        assert binned.keys() == exact.keys()
        worst = max(abs(binned[p].density - exact[p].density) for p in exact)
        assert worst <= bound + 1e-12 and all(abs(binned[p].x - exact[p].x) < 1e-9 for p in exact)
    alike = spark.createDataFrame([(1.0,), (1.0,)], "compound double")
    assert insights.compound_density(alike, cells=10).count() == 0
    assert insights.compound_density(df.limit(0), cells=10).select(F.max("density")).first()[0] is None
