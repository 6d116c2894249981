"""Merkle dataset manifest: sibling-shift self-joins over trees of row digests.

The rows of a source are the leaves of one tree, and the sources' roots those of a last one. At each
level the node in slot zero of every run computes the indices of its siblings (XOR of its own where
nodes meet in pairs, slot offsets otherwise) and an equijoin on (tree, index) brings their digests;
then it emits the parent. An index is one row, so no source is too large for a task. Leaf places
come from one range exchange and the row counts of its partitions, not from a window over a source.

Proofs go down the same runs: a node's path is its parent's with the siblings of its own level in
front. Leaves get theirs run by run, so paths are moved once for a run and not once for a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import staged

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGEST = 32


def field(value: Column | str) -> Column:
    """``-`` for null, else the value's bytes in UTF-8, a colon and the value."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def row_digest(values: Sequence[Column | str]) -> Column:
    """SHA-256 of the values' fields in a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def node_digest(run: Column) -> Column:
    """The digest of a run of digests that lie one after the other, taken as lower-case hex text."""
    return F.unhex(F.sha2(as_text(run), 256))


def as_text(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def sibling(index: Column, offset: Column, fan: int) -> Column:
    """The index of the sibling ``offset`` slots on; slots wrap around within a run."""
    if fan == 2:
        return index.bitwiseXOR(offset)
    slot = index % fan
    return index - slot + (slot + offset) % fan


def placed(nodes: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``nodes`` with ``idx``, their place in their ``tree`` by ``order``, and ``n``, its size.

    Rows that ``order`` can't tell apart are dealt apart all the same, so that no run of equal rows
    is one task.
    """
    tree = F.col("tree").asc_nulls_first()
    dealt = nodes.withColumn("_row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(tree, *order, "_row").sortWithinPartitions(tree, *order, "_row")
    at = F.monotonically_increasing_id()
    dealt = staged(dealt.drop("_row").withColumn("_at", at), "merkle-places")
    part = F.shiftright("_at", 33)
    own = dealt.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_count"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("_first") - F.coalesce(F.sum("_count").over(before), F.lit(0))
    size = F.sum("_count").over(Window.partitionBy("tree"))
    spans = staged(own.select("tree", "_part", base.alias("_base"), size.alias("n")), "merkle-spans")
    found = dealt.withColumn("_part", part).join(spans, ["tree", "_part"])
    return found.withColumn("idx", F.col("_at") - F.col("_base")).drop("_at", "_part", "_base")


def runs_of(level: DataFrame, fan: int, also: Sequence[str] = ()) -> DataFrame:
    """(tree, idx, n, run, members): each run of a level, under its parent's index and level size.

    ``run`` holds the digests one after the other, ``members`` (slot, ``also``..) of each node.
    """
    heads = level.filter(F.col("idx") % fan == 0).select("tree", "idx", "n")
    offsets = F.sequence(F.lit(0).cast("long"), F.least(F.lit(fan), F.col("n") - F.col("idx")) - 1)
    wanted = heads.withColumn("slot", F.explode(offsets)).select(
        "tree",
        sibling(F.col("idx"), F.col("slot"), fan).alias("idx"),
        F.floor(F.col("idx") / fan).cast("long").alias("parent"),
        "slot",
    )
    members = level.join(wanted, ["tree", "idx"])
    kept = F.array_sort(F.collect_list(F.struct("slot", "digest", *also)))
    grouped = members.groupBy("tree", "parent", "n").agg(kept.alias("members"))
    digests = F.array_join(F.transform("members", lambda m: F.hex(m["digest"])), "")
    return grouped.select(
        "tree",
        F.col("parent").alias("idx"),
        F.ceil(F.col("n") / fan).cast("long").alias("n"),
        F.unhex(digests).alias("run"),
        F.transform("members", lambda m: F.struct(m["slot"], *[m[c].alias(c) for c in also])).alias("members"),
    )


class Trees(NamedTuple):
    """Trees built: runs by level, leaves first, and (tree, root, height)."""

    runs: list[DataFrame]
    roots: DataFrame


def build(nodes: DataFrame, fan: int = FAN, also: Sequence[str] = ()) -> Trees:
    """All trees over ``nodes`` (tree, idx, n, digest, ``also``..), level by level.

    Each level is a written table a ``fan``-th the size of the one below; their number grows with
    the logarithm of the largest tree, which is all that the driver learns.
    """
    size = nodes.agg(F.max("n")).first()[0] or 0
    level, runs = nodes, []
    roots = nodes.filter("n = 1").select("tree", F.col("digest").alias("root"), F.lit(0).alias("height"))
    while size > 1:
        runs.append(staged(runs_of(level.filter("n > 1"), fan, () if runs else also), "merkle-runs"))
        level = runs[-1].select("tree", "idx", "n", node_digest(F.col("run")).alias("digest"))
        top = level.filter("n = 1")
        roots = roots.union(top.select("tree", F.col("digest").alias("root"), F.lit(len(runs)).alias("height")))
        size = -(-size // fan)
    return Trees(runs, roots)


def paths(trees: Trees, above: DataFrame, fan: int, also: Sequence[str]) -> DataFrame:
    """(tree, idx, digest, ``also``.., path, rest..): the siblings of each leaf on its way up, level by level.

    ``above``: (tree, height, path, rest..), what lies above each root. A path entry is (left,
    right): the siblings before and after, digests one after the other. Leaves that are roots
    themselves are left out.
    """
    rest = [c for c in above.columns if c not in ("tree", "height", "path")]
    parents = None
    for height in range(len(trees.runs), 0, -1):
        top = above.filter(F.col("height") == height)
        tops = top.select("tree", F.lit(0).cast("long").alias("idx"), "path", *rest)
        parents = tops if parents is None else parents.union(tops)
        under = trees.runs[height - 1].join(parents, ["tree", "idx"])
        under = under.withColumn("m", F.explode("members"))
        slot = F.col("m.slot").cast("int")
        own = F.substring("run", slot * _DIGEST + 1, F.lit(_DIGEST))
        entry = F.struct(
            F.substring("run", F.lit(1), slot * _DIGEST).alias("left"),
            F.substring("run", (slot + 1) * _DIGEST + 1, F.lit(fan * _DIGEST)).alias("right"),
        )
        parents = under.select(
            "tree",
            (F.col("idx") * fan + slot).alias("idx"),
            F.concat(F.array(entry), "path").alias("path"),
            *rest,
            *([own.alias("digest"), *(f"m.{c}" for c in also)] if height == 1 else []),
        )
    return parents


def folded(digest: Column | str, path: Column | str) -> Column:
    """The root that a leaf's digest and its siblings give."""
    start = F.col(digest) if isinstance(digest, str) else digest
    return F.aggregate(path, start, lambda acc, p: node_digest(F.concat(p["left"], acc, p["right"])))


def path_text(path: Column | str) -> Column:
    """All siblings of a path as lower-case hex text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(as_text(p["left"]), as_text(p["right"]))), "")


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    key: str = "doc_id",
    fan: int = FAN,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(key, leaf, subroot, root, path, ``also``..), one row per row of ``docs``; digests as bytes.

    A leaf is the digest of the row's ``fields``. Leaves of one ``group`` value ascend by ``key``
    (null first, then by digest; equal rows follow each other), ``fan`` consecutive ones have one
    parent, and so on up to the group's ``subroot``. Subroots, ordered by group (null first, bytes
    of UTF-8), give the ``root`` in the same way. A single leaf is its own subroot. No rows give no
    rows. ``also`` are expressions over a row's columns that are carried along; other columns of
    ``docs`` are ignored. ``path`` is what ``folded`` and ``path_text`` take.
    """
    if fan < 2:
        raise ValueError("fan is 2 or more")
    also = dict(also or {})
    leaves = staged(
        docs.select(
            field(group).alias("tree"),
            F.col(group).cast("string").alias("_group"),
            F.col(key).alias("_key"),
            row_digest(fields).alias("digest"),
            *[c.alias(f"_also_{name}") for name, c in also.items()],
        ),
        "merkle-leaves",
    )
    carried = ["_key", *(f"_also_{name}" for name in also)]
    nodes = placed(leaves, [F.col("_key").asc_nulls_first(), F.col("digest")])
    nodes = staged(nodes, "merkle-nodes")
    trees = build(nodes, fan, carried)
    roots = staged(trees.roots, "merkle-subroots")

    named = roots.join(nodes.filter("idx = 0").select("tree", "_group"), "tree")
    subtrees = named.select(F.lit("").alias("tree"), "_group", "root", "height", F.col("tree").alias("name"))
    top = staged(
        placed(subtrees, [F.col("_group").asc_nulls_first()]).withColumnRenamed("root", "digest"), "merkle-top"
    )
    last = build(top, fan, ["name", "height"])
    root = last.roots.first()
    root = F.lit(bytes(root["root"]) if root else None).cast("binary")
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    if last.runs:
        whole = last.roots.select("tree", "height", empty.alias("path"))
        above = paths(last, whole, fan, ["name", "height"])
    else:
        above = top.withColumn("path", empty)
    above = above.select(F.col("name").alias("tree"), "height", "path", F.col("digest").alias("subroot"))
    above = staged(above, "merkle-above")

    single = nodes.filter("n = 1").join(above.filter("height = 0"), "tree")
    out = ["digest", "subroot", "path", *carried]
    found = single.select(*out)
    if trees.runs:
        found = found.union(paths(trees, above, fan, carried).select(*out))
    return found.select(
        F.col("_key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        *[F.col(f"_also_{name}").alias(name) for name in also],
    )


def tampered_leaf(fields: Sequence[str] = FIELDS, key: str = "doc_id", text: str = "text", every: int = 5) -> Column:
    """The digest of a row whose text's A-Z were lower-cased, for one key in ``every`` by CRC-32.

    Null for the others and for rows without a key.
    """
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text else F.col(c) for c in fields]
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % every == 0
    return F.when(hit, row_digest(changed))


def merkle_audit(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row.

    Proofs of ``merkle_manifest`` against a copy in which one document in five was tampered with
    (``tampered_leaf``): ``folded_root`` comes from the copy's digest and the original siblings, and
    ``verified`` says whether it is the root. Digests are lower-case hex; ``proof_sha256`` is that
    of the siblings' text, empty for a table of one row.
    """
    rows = merkle_manifest(docs, fan=fan, also={"copy": tampered_leaf()})
    again = folded(F.coalesce("copy", "leaf"), "path")
    return rows.select(
        "doc_id",
        *[as_text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(path_text("path"), 256).alias("proof_sha256"),
        as_text(again).alias("folded_root"),
        (again == F.col("root")).alias("verified"),
    )
