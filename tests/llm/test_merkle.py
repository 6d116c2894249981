import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from parley.llm.merkle import FIELDS, folded, merkle_audit, merkle_manifest, sibling


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest("".join(parts))


def climb(nodes, fan):
    """The root, and each node's siblings on the way up, level by level: (before, after)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            low = place // fan * fan
            run = nodes[low : low + fan]
            steps[k].append(("".join(run[: place - low]), "".join(run[place - low + 1 :])))
        at = [place // fan for place in at]
        nodes = [digest("".join(nodes[i : i + fan])) for i in range(0, len(nodes), fan)]
    return nodes[0], steps


def expected(rows, fan):
    """By whole trees in memory; rows in the order of FIELDS."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in order:
        members = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, *climb([leaf(r) for r in members], fan)))
    root, above = climb([t[1] for t in trees], fan)
    out = []
    for (members, subroot, below), up in zip(trees, above, strict=True):
        for row, steps in zip(members, below, strict=True):
            path = steps + up
            copy = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                copy = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            fold = leaf(copy)
            for before, after in path:
                fold = digest(before + fold + after)
            proof = digest("".join(b + a for b, a in path))
            out.append((row[0], leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def audited(df, fan):
    return sorted((tuple(r) for r in merkle_audit(df, fan).collect()), key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
EDGES = [
    (1, "s", "en", 3, "Abc"),
    (1, "s", "en", 3, "Abc"),
    (1, "s", "en", 4, "Abcd"),
    (None, "s", None, None, None),
    (None, "s", None, None, None),
    (None, None, "x", 1, "UP"),
    (7, None, "x", 1, ""),
    (-3, "", "", 0, "É ÀZ"),
    (2**60, "ß", "de", 5, "ÜÄß"),
    (8, "Z", "de", 5, "LONG " * 5000),
    *((i, "big", "en", i % 3 or None, f"Text {i % 11}") for i in range(10, 300)),
    *((i, f"source {i % 40}", "en", 1, "Mixed Case") for i in range(300, 390)),
]


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_against_whole_trees(spark, fan):
    df = spark.createDataFrame(EDGES, SCHEMA).repartition(5)
    assert audited(df, fan) == expected(EDGES, fan)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_of_one_source(spark, n):
    rows = [(i, "s", "en", 1, f"Doc {i}") for i in range(n)]
    assert audited(spark.createDataFrame(rows, SCHEMA), 16) == expected(rows, 16)


def test_sources_of_one_row(spark):
    rows = [(i, f"{i}", "en", 1, f"Doc {i}") for i in range(20)]
    assert audited(spark.createDataFrame(rows, SCHEMA), 16) == expected(rows, 16)


def test_edge_rows(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select(*FIELDS).collect()]
    assert audited(edge_docs, 16) == expected(rows, 16)
    assert merkle_audit(no_docs).count() == 0


def test_indices_of_siblings(spark):
    for fan in (2, 3, 16):
        offsets = spark.range(64).select("id", F.explode(F.sequence(F.lit(1), F.lit(fan - 1))).alias("o"))
        found = offsets.select("id", sibling(F.col("id"), F.col("o"), fan).alias("s")).collect()
        for i in range(64):
            low = i // fan * fan
            assert sorted(r.s for r in found if r.id == i) == [j for j in range(low, low + fan) if j != i]


def test_any_change_breaks_the_proof(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"doc {i}") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = merkle_manifest(df, fan=4)
    changed = F.unhex(F.sha2(F.hex("leaf"), 256))
    got = found.select(
        (folded("leaf", "path") == F.col("root")).alias("same"),
        (folded(changed, "path") == F.col("root")).alias("other"),
    ).collect()
    assert len(got) == 50 and all(r.same and not r.other for r in got)
    with pytest.raises(ValueError):
        merkle_manifest(df, fan=1)
