import pytest

import corpus_pipeline
from parley.llm.queries import QUERIES
from prose import prose


def test_stages_take_effect(spark, as_docs, tmp_path):
    leak = prose(70, 40)
    near = prose(71, 120)
    rows = [
        (1, "123 456"),
        (2, prose(72, 40) + "\n" + prose(73, 40)),
        (3, prose(73, 40) + "\n" + prose(74, 40)),
        (4, prose(72, 40)),
        (5, near),
        (6, near + " more"),
        (7, prose(75, 30) + " " + leak),
        (8, None),
    ]
    docs = as_docs(rows).selectExpr("*", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars", "'x' extra")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        left[name] = {r.doc_id: r for r in docs.collect()}
        if name != "best_fit_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra"]
    assert set(left["language_id"]) == {2, 3, 4, 5, 6, 7}
    assert set(left["line_dedup"]) == {2, 3, 5, 6, 7}
    assert left["line_dedup"][3].text == prose(74, 40) and left["line_dedup"][3].n_chars == len(prose(74, 40))
    assert set(left["ngram_jaccard_join"]) == {2, 3, 5, 7}
    assert set(left["benchmark_decontamination"]) == {2, 3, 5}
    assert set(left["best_fit_packing"]) == {2, 3, 5}
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in ran.collect()} == {2, 3, 5}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A folder with a benchmark table, for the stages that read one."""
    path = tmp_path_factory.mktemp("pipeline")
    items = spark.createDataFrame([(0, prose(70, 40)), (None, None)], "item_id long, text string")
    items.write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_edge_rows(spark, edge_docs, sf):
    """Nulls, blank and very long texts, repeated rows and clashing columns, each stage on its input."""
    docs, before = edge_docs, None
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == edge_docs.columns and docs.dtypes == edge_docs.dtypes
        rows = sorted(docs.collect(), key=key)
        ids = [r.doc_id for r in rows]
        assert all(any(c.isalpha() for c in r.text) for r in rows)
        assert {(r.kept, r.n_lines, r.maybe) for r in rows} == {("x", "x", "x")}
        if before is not None:
            assert all(ids.count(i) <= before.count(i) for i in ids)
        before = ids
        if name == "language_id":
            assert not {3, 4, 5, 8} & set(ids) and ids.count(2) == 2 and {1, 6, 11} <= set(ids)
        if name == "line_dedup":
            # of the equal lines in 1, 2 and a row without id the first stays; what is left empty goes
            assert ids.count(1) == 1 and 2 not in ids and {6, 11} <= set(ids)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == set(before)
    assert sum(r.length for r in packed if r.doc_id == 6) > 4096


def test_empty_tables(spark, no_docs, edge_docs, sf, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_docs, sf)
        assert out.count() == 0
        if name != "best_fit_packing":
            assert out.columns == no_docs.columns
    none = spark.createDataFrame([], "item_id long, text string")
    none.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.drop_leaks(spark, edge_docs, str(tmp_path)).count() == edge_docs.count()


def test_every_operator_is_registered_once():
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names)
