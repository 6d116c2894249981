import zlib

import pytest

from parley.llm.sharding import fill_level, shard, splitters, write_shards
from parley.session import work_dir


def checked(rows, shards, slack):
    total = sum(r["size"] for r in rows)
    loads = [0] * shards
    homes = {}
    for r in rows:
        loads[r.shard] += r["size"]
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert max(loads) - min(loads) <= slack * total / shards
    return loads


def test_edge_rows(edge_docs, edge_rows):
    got = shard(edge_docs, shards=2).collect()
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in edge_rows
    )
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    checked(got, 2, 3)


def test_no_rows(no_docs):
    assert shard(no_docs).count() == 0


def test_a_hot_text_and_even_shards(spark):
    docs = spark.range(6000, numPartitions=5).selectExpr(
        "id doc_id", "if(id % 40 = 0, repeat('hot ', 100), repeat(cast(id as string), 1 + id % 50)) text"
    )
    got = shard(docs, shards=8).collect()
    assert len(got) == 6000
    checked(got, 8, 0.05)


def test_a_text_of_more_than_a_shard_stays_whole(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "if(id % 3 = 0, repeat('hot ', 30), cast(id as string)) text")
    loads = checked(shard(docs, shards=16).collect(), 16, 20)
    assert sorted(loads)[0] * 1.05 > sorted(loads)[-2]


@pytest.mark.parametrize("loads, free", [([0, 0, 0], 10), ([9, 0, 0], 3), ([5, 3, 1], 100), ([4], 4), ([7, 7], 0)])
def test_fill_level(loads, free):
    takes = fill_level(loads, free)
    assert sum(takes) == free and min(takes) >= 0
    touched = [x + t for x, t in zip(loads, takes) if t]
    assert not touched or max(touched) - min(touched) <= len(loads)


def test_splitters_meet_the_tolerance(spark):
    rows = [((i * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63), 1 + i % 7) for i in range(4000)]
    light = spark.createDataFrame(rows, "key long, size long")
    total = sum(s for _, s in rows)
    wanted = [total * i // 5 for i in range(1, 5)]
    for cut, want in zip(splitters(light, wanted, 20, bits=4), wanted):
        assert abs(sum(s for k, s in rows if k < cut) - want) <= 20


def test_written_shards(spark, as_docs):
    docs = as_docs([(i, f"text {i}") for i in range(50)])
    path = work_dir(spark, "shards")
    write_shards(docs, shard(docs, shards=4), path)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.select("shard").distinct().count() == 4
