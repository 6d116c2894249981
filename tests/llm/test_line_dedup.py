import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.llm import line_dedup as module
from parley.llm.common import key_filter, maybe_in
from parley.llm.line_dedup import LEAST_CHARS, line_dedup, within


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(rows):
    """(doc_id, text) to kept text, by comparing every line with all earlier ones."""
    seen, out = [], []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept = []
        for line in text.split("\n"):
            if line.strip(" "):
                near = any(
                    line == x or (min(len(line), len(x)) >= LEAST_CHARS and abs(len(line) - len(x)) < 2 and distance(line, x) < 2)
                    for x in seen
                )
                seen.append(line)
                if near:
                    continue
            kept.append(line)
        out.append((i, "\n".join(kept)))
    return out


def edited(rng, line):
    for _ in range(rng.choice([0, 1, 1, 1, 2])):
        k = rng.randrange(len(line))
        line = rng.choice([line[:k] + line[k + 1 :], line[:k] + "q" + line[k:], line[:k] + "z" + line[k + 1 :]])
    return line


def test_against_every_pair(as_docs):
    rng = random.Random(5)
    stock = ["".join(rng.choices("abcde fgh", k=rng.randint(5, 60))) + "." for _ in range(25)]
    rows = [(i, "\n".join(edited(rng, rng.choice(stock)) for _ in range(8)) + "\n") for i in range(40)]
    got = {r.doc_id: r.text for r in line_dedup(as_docs(rows)).collect()}
    assert got == dict(expected(rows))


def test_large_groups_are_refined(as_docs, monkeypatch):
    monkeypatch.setattr(module, "GROUP", 2)
    rng = random.Random(6)
    base = "".join(rng.choices("abcdefgh", k=50))
    rows = [(i, edited(rng, base)) for i in range(120)]
    got = {r.doc_id: r.text for r in line_dedup(as_docs(rows)).collect()}
    assert got == dict(expected(rows))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text("ab😀", max_size=12), st.text("ab😀", max_size=12)), min_size=1, max_size=20))
def test_bit_parallel_distance(spark, pairs):
    near = [(a, a[:3] + b[:1] + a[4:]) for a, b in pairs] + [(a, a[1:] + b[:1]) for a, b in pairs]
    rows = spark.createDataFrame(pairs + near, "a string, b string")
    for limit in (1, 2, 3):
        for r in rows.withColumn("near", within(F.col("a"), F.col("b"), limit)).collect():
            assert r.near == (distance(r.a, r.b) <= limit), (r.a, r.b, limit)


def test_edge_rows(edge_docs, edge_rows):
    out = line_dedup(edge_docs)
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == [c for c in edge_docs.columns if c != "n_lines"]
    got = out.collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].n_dropped == 0 and by_id[2].text == "" and by_id[2].n_chars == 0
    assert (by_id[3].text, by_id[3].n_lines, by_id[3].n_dropped) == (None, 0, 0)
    assert (by_id[4].text, by_id[5].text) == ("", " \n\t ")
    assert by_id[6].n_lines == 400 and by_id[6].n_dropped == 0
    assert by_id[10].n_dropped == 0 and by_id[7].n_dropped == 0


def test_no_rows(no_docs):
    assert line_dedup(no_docs).count() == 0


@pytest.mark.parametrize("group", [16, 2])
@pytest.mark.parametrize("edits, percent", [(3, None), (7, 5)])
def test_thresholds_over_one_edit(as_docs, monkeypatch, edits, percent, group):
    monkeypatch.setattr(module, "GROUP", group)
    rng = random.Random(7)
    stock = ["".join(rng.choices("abcde fgh", k=rng.randint(18, 170))) + "." for _ in range(5)]
    lines = []
    for _ in range(60):
        line = rng.choice(stock)
        for _ in range(rng.randint(0, 6)):
            line = edited(rng, line)
        lines.append(line)

    def near(a, b):
        short = min(len(a), len(b))
        limit = edits if percent is None else max(1, min(edits, short * percent // 100))
        return a == b or (short >= LEAST_CHARS and distance(a, b) <= limit)

    got = {r.doc_id: r.n_dropped for r in line_dedup(as_docs(list(enumerate(lines))), edits, percent).collect()}
    assert got == {i: int(any(near(line, x) for x in lines[:i])) for i, line in enumerate(lines)}
    assert 0 < sum(got.values()) < len(lines)


def test_sketches_bound_the_distance(spark):
    rng = random.Random(8)
    pairs = []
    for k in range(300):
        line = "".join(rng.choices("abcde fhi日é", k=rng.randint(30, 80)))
        other = line
        for _ in range(k % 9):
            other = edited(rng, other)
        pairs.append((line, other))
    pairs += [("a" * 40, "b" * 40), ("", "abc"), ("aa", "aaa")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    rows = rows.select("a", "b", module.sketch("a").alias("sketch_a"), module.sketch("b").alias("sketch"))
    got = rows.withColumn("bits", F.expr(module.sketch_distance())).collect()
    assert all(r.bits <= 2 * distance(r.a, r.b) for r in got)
    assert sum(r.bits > 0 for r in got) > 200


def test_a_line_probes_buckets_and_not_every_length(as_docs):
    rng = random.Random(9)
    lines = as_docs([(n, "".join(rng.choices("abcde fgh", k=n))) for n in range(20, 400)])
    lines = lines.select(F.col("doc_id").alias("k1"), F.col("text").alias("line"))
    probes = module.segment_rows(lines, 7, 5, probes=True).groupBy("k1").count()
    counts = {r.k1: r["count"] for r in probes.collect()}
    assert max(counts.values()) <= 90 and min(counts[n] for n in range(160, 400)) >= 40


def test_filters_of_several_marks_lose_no_key(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("k"))
    others = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("k"))
    passed = {}
    for marks in (1, 3):
        words = key_filter(keys, "k", 1 << 9, marks)
        assert maybe_in(keys, "k", words, 1 << 9, marks).filter("maybe").count() == 3000
        passed[marks] = maybe_in(others, "k", words, 1 << 9, marks).filter("maybe").count()
    assert passed[3] < passed[1] / 2


def test_distance_without_common_ends(spark):
    rng = random.Random(10)
    pairs = [("", ""), ("", "ab"), ("aaaaaaaa", "aaaaaaaaaaaaaaaa"), ("é" * 20, "é" * 19 + "日"), ("ab" * 20, "ab" * 19)]
    for _ in range(200):
        line = other = "".join(rng.choices("ab日", k=rng.randint(5, 60)))
        for _ in range(rng.randint(0, 4)):
            other = edited(rng, other)
        pairs.append((line, other))
    rows = spark.createDataFrame(pairs, "a string, b string")
    for r in rows.withColumn("n", module.apart("a", "b", "greatest(1, char_length(a) div 10)")).collect():
        whole, limit = distance(r.a, r.b), max(1, len(r.a) // 10)
        assert r.n == (whole if whole <= limit else -1), (r.a, r.b)


@pytest.mark.parametrize("edits, percent, asked", [(7, 5, [40]), (3, None, []), (1, None, [None]), (7, 0, [None])])
def test_the_one_edit_join_takes_only_lines_that_no_segments_cut(as_docs, monkeypatch, edits, percent, asked):
    rng = random.Random(11)
    lines = ["".join(rng.choices("abcde fgh", k=n)) for n in (19, 20, 39, 40, 41, 59, 60, 200)]
    lines += [x[:9] + "q" + x[9:] for x in lines] + [x[:12] + "q" + x[13:] for x in lines]
    seen, joined = [], module.near_lines

    def near_lines(docs, unique):
        longest = unique.filter("half_keys is not null").agg(F.max("n_chars")).first()[0]
        seen.append(longest)
        return joined(docs, unique)

    monkeypatch.setattr(module, "near_lines", near_lines)
    got = {r.doc_id: r.n_dropped for r in line_dedup(as_docs(list(enumerate(lines))), edits, percent).collect()}
    assert got == {i: int(i >= 8 and i % 8 > 0) for i in range(24)}
    assert seen == [201 if n is None else n for n in asked]


def test_segments_of_long_lines_reach_beyond_160_characters():
    for edits in (4, 7):
        last = module._segments(edits, 5, probes=False)[-1]
        assert len(last) == edits + 1 and last[-1]["start"] + last[-1]["size"] == 240
