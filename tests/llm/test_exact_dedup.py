import hashlib
from collections import Counter

import pytest

from parley.llm.exact_dedup import exact_dedup


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_edge_rows(edge_docs, edge_rows, keep):
    got = exact_dedup(edge_docs, keep=keep, runs=16, fan=4).collect()
    assert len(got) == len(edge_rows)
    best = max if keep == "largest" else min
    ids, size = {}, Counter()
    for i, t in edge_rows:
        h = hashlib.sha256((t or "").encode()).hexdigest()
        size[h] += 1
        if i is not None:
            ids[h] = best(ids.get(h, i), i)
    for r in got:
        assert (r.keep_id, r.group_size) == (ids.get(r.text_sha256), size[r.text_sha256])
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == set(size)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_no_rows(no_docs):
    assert exact_dedup(no_docs).count() == 0


def test_a_large_group_over_many_runs(spark):
    docs = spark.range(5000, numPartitions=9).selectExpr("id doc_id", "if(id % 3 = 0, 'same', cast(id as string)) text")
    got = exact_dedup(docs, runs=8, fan=2).filter("kept").toPandas().set_index("keep_id")
    assert len(got) == 5000 - 1666 and got.group_size[4998] == 1667


def test_keep_is_checked(no_docs):
    with pytest.raises(ValueError):
        exact_dedup(no_docs, keep="first")
