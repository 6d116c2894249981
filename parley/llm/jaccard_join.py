"""N-gram Jaccard join: prefix lists with position skipping, answers through similar sets.

1. Equal sets are one class; its smallest doc_id stands for it.
2. Every class lists the first shingles of its set (the prefix that any partner must touch). Order:
   shingles that are frequent in the corpus last, else by hash. Any one order gives exact results;
   this one keeps lists short.
3. In each list every set is compared with the list's smallest doc_id only. Sets found similar form
   clusters, and a cluster's links answer for all of its members.
4. The same lists then give the pairs that lie in different clusters, all of them. Lists are cut into
   blocks by position; two blocks whose best possible overlap is too small are skipped.
5. A bitmap of each set, a bit per hash class that an odd number of its shingles fall into, bounds
   what a pair can share before the pair leaves its list: two sets differ in at least as many
   shingles as their bitmaps do in bits. What two prefixes share is the next bound; only pairs within
   both have their whole sets compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import shingles, tokens
from parley.llm.common import components, ship
from parley.session import staged

PERCENT = 80
#: Shingles that a counting window holds, the count in a window from which one is reported, and how
#: many of the most frequent are put last: they bound memory, never results.
WINDOW = 4_000_000
REPORTED = 4
FREQUENT = 1 << 17
#: Members of a list compared as one block, lists short enough to go without blocks, and pairs of
#: one set checked in one task.
BLOCK = 64
SHORT = 8
CHECKS = 256
#: Bits of a set's bitmap; for sets of many more shingles it bounds little.
BITMAP = 512
#: 64-bit words of the filter that picks the documents whose sets are needed again.
FILTER_WORDS = 1 << 17


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The corpus' most frequent shingles, sorted, and the rank of each (rarest first).

    A lossy count over every text: a window of the stream drops what it saw fewer than REPORTED
    times. At most FREQUENT shingles come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        held, size = [], 0

        def report() -> pa.RecordBatch:
            found, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= REPORTED
            return pa.RecordBatch.from_arrays(
                [pa.array(found[many].view(np.int64)), pa.array(times[many], pa.int64())], ["shingle", "n"]
            )

        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                held.extend(shingles.shingle_sets(batch.column("text"), words))
                size += sum(map(len, held[-batch.num_rows :]))
                if size >= WINDOW:
                    yield report()
                    held, size = [], 0
        if size:
            yield report()

    rows = (
        docs.select("text")
        .mapInArrow(count, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT)
        .toPandas()
    )
    keys = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (len(keys) - np.arange(len(keys)))[order]


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def signatures(docs: DataFrame, words: int, percent: int, frequent: tuple) -> DataFrame:
    """(doc_id, n, digest, bitmap, prefix) of each document: set size and digest, leading shingles."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rank = shared.value
        table = np.zeros(1 << 20, bool)
        table[keys & np.uint64((1 << 20) - 1)] = True

        def prefix(found: np.ndarray) -> np.ndarray:
            length = prefix_length(len(found), percent)
            maybe = np.flatnonzero(table[found & np.uint64((1 << 20) - 1)])
            if len(maybe):
                spot = np.minimum(np.searchsorted(keys, found[maybe]), len(keys) - 1)
                sure = keys[spot] == found[maybe]
                if sure.any():
                    late = maybe[sure][np.argsort(rank[spot[sure]], kind="stable")]
                    found = np.concatenate([np.delete(found, late), found[late]])
            return found[:length].view(np.int64)

        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                sizes, digests, bitmaps, prefixes = [], [], [], []
                for found in shingles.shingle_sets(batch.column("text"), words):
                    sizes.append(len(found))
                    digests.append(hashlib.blake2b(found, digest_size=16).digest() if len(found) else None)
                    bitmaps.append(bitmap(found))
                    prefixes.append(prefix(found) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(sizes, pa.int32()),
                        pa.array(digests, pa.binary()),
                        pa.array(bitmaps, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "digest", "bitmap", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, n int, digest binary, bitmap binary, prefix array<long>"
    )


def bitmap(found: np.ndarray) -> bytes:
    """Which hash classes an odd number of shingles fall into."""
    classes = (found >> np.uint64(64 - BITMAP.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(classes, minlength=BITMAP) & 1).astype(bool)).tobytes()


def _wanted(n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection at which two sizes reach the threshold."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _may_link(n_a, at_a, n_b, at_b, percent):
    """Whether sets that share the shingle at these positions can still reach the threshold."""
    return np.minimum(n_a - at_a, n_b - at_b) >= _wanted(n_a, n_b, percent)


def leader_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(shingle, doc, n, at, leader, leader_n): the members of each list of two or more sets.

    ``postings``: (shingle, doc, n, at). A list is read once, in order of doc; only its first row is
    remembered. ``leader`` is null for the leader and for members too far from it in size.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the list that the next batch may go on with: its first row, and if it was told
        for batch in batches:
            key, doc, n, at = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            if last is not None:
                key, doc, n, at = (np.concatenate([[x], c]) for x, c in zip(last[0], (key, doc, n, at), strict=True))
            told = last is not None and last[1]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(starts, len(key)))
            head = np.repeat(starts, counts)
            keep = np.repeat(counts > 1, counts)
            row = np.arange(len(key))
            open_ = (key[head[-1]], doc[head[-1]], n[head[-1]], at[head[-1]])
            last = (open_, bool(counts[-1] > 1) or (told and len(starts) == 1))
            if told:
                keep[0] = False
            near = (row != head) & (doc != doc[head])
            near &= 100 * np.minimum(n, n[head]) >= percent * np.maximum(n, n[head])
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c[keep]) for c in (key, doc, n, at)),
                    pa.array(doc[head][keep], mask=~near[keep]),
                    pa.array(n[head][keep]),
                ],
                ["shingle", "doc", "n", "at", "leader", "leader_n"],
            )

    ordered = postings.repartition("shingle").sortWithinPartitions("shingle", "doc")
    return ordered.mapInArrow(read, "shingle long, doc long, n long, at long, leader long, leader_n long")


def within_bound(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b, shared) whose prefixes share enough.

    All common shingles up to the end of the prefix that ends first lie in both prefixes; beyond it
    that set has no more than its own rest. A pair for which that is too little can't link.
    """
    larger = F.greatest("n_a", "n_b")
    rest = F.ceil(percent * larger / 100) - 1
    wanted = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    return pairs.filter(F.col("shared") + rest >= wanted).select("a", "b")


def prefix_overlap(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, shared) of ``pairs`` (a, b): set sizes, and what both prefixes hold; a row a pair.

    ``prefixes``: (doc, n, prefix).
    """
    left = prefixes.toDF("a", "n_a", "prefix_a")
    right = prefixes.toDF("b", "n_b", "prefix_b")
    shared = F.size(F.array_intersect("prefix_a", "prefix_b")).alias("shared")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", shared)


def cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: pairs of a list in different clusters that can reach the threshold.

    ``lists``: (shingle, doc, n, at, cluster, bitmap). Lists within one cluster are gone before this.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for columns in _batches_and_end(batches):
            if columns is None:
                done, held = held, None
            else:
                held = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
                cut = int(np.searchsorted(held[0], held[0][-1]))
                done, held = [c[:cut] for c in held], [c[cut:] for c in held]
            if done is None or not len(done[0]):
                continue
            found = [p for p in _list_pairs(done, percent) if len(p)]
            if found:
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    ordered = lists.repartition("shingle").sortWithinPartitions("shingle", "at")
    return ordered.mapInArrow(read, "a long, b long")


def _batches_and_end(batches):
    for batch in batches:
        if batch.num_rows:
            *numbers, bitmaps = batch.columns
            bits = np.frombuffer(b"".join(bitmaps.to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            yield [*(c.to_numpy(zero_copy_only=False).astype(np.int64) for c in numbers), bits]
    yield None


def _list_pairs(columns: list[np.ndarray], percent: int) -> Iterator[np.ndarray]:
    key, doc, n, at, cluster, bits = columns

    def chosen(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        pick = cluster[x] != cluster[y]
        pick &= _may_link(n[x], at[x], n[y], at[y], percent)
        x, y = x[pick], y[pick]
        apart = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
        near = apart <= n[x] + n[y] - 2 * _wanted(n[x], n[y], percent)
        left, right = doc[x][near], doc[y][near]
        return np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1)

    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(starts, len(key)))
    short = np.flatnonzero(np.repeat(counts <= SHORT, counts))
    for step in range(1, SHORT):
        x = short[short + step < len(key)]
        x = x[key[x] == key[x + step]]
        yield chosen(x, x + step)
    for start, count in zip(starts[counts > SHORT], counts[counts > SHORT], strict=True):
        rows = np.arange(start, start + count)
        blocks = [rows[i : i + BLOCK] for i in range(0, count, BLOCK)]
        for i, left in enumerate(blocks):
            least = -(-percent * n[left].min() // 100)
            for right in blocks[i:]:
                # positions rise along a list, so no later block can reach what this one can't
                if n[rows].max() - at[right[0]] < least:
                    break
                x, y = np.meshgrid(left, right, indexing="ij")
                yield chosen(x.ravel(), y.ravel())


def similar_pairs(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold.

    Sets are made again from the texts of the documents in question; a filter of fixed size spares
    most others, and those that slip through find no pair. A set with many pairs is copied for each
    CHECKS of them, so no task holds more than that for one set.
    """
    spark = docs.sparkSession
    pairs = staged(pairs.distinct(), "jaccard-pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHECKS).alias("parts"))
    dealt = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    dealt = staged(dealt.select("a", "b", "part"), "jaccard-dealt")
    needed = dealt.select(F.col("a").alias("doc"), "a", "part", F.lit(0).alias("member")).distinct()
    needed = needed.union(dealt.select(F.col("b").alias("doc"), "a", "part", F.lit(1)))

    slot = F.pmod(F.xxhash64("doc"), F.lit(64 * FILTER_WORDS))
    bits = (
        needed.select(F.floor(slot / 64).cast("int").alias("word"), (slot % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .toPandas()
    )
    filter_ = np.zeros(FILTER_WORDS, np.uint64)
    filter_[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(filter_)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.column("slot").fill_null(0).to_numpy()
            hit = shared.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)
            for batch in tokens.slices(whole.filter(pa.array(hit.astype(bool))), "text"):
                found = [s.tobytes() for s in shingles.shingle_sets(batch.column("text"), words)]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, pa.binary())], ["doc", "found"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, whose = [], None
        for batch in batches:
            left, right = [], []
            a, part, member, doc = (batch.column(c).to_pylist() for c in ("a", "part", "member", "doc"))
            for i, data in enumerate(batch.column("found")):
                found = np.frombuffer(data.as_buffer(), np.uint64)
                if member[i] == 0:
                    if whose != (a[i], part[i]):
                        mine, whose = [], (a[i], part[i])
                    mine.append(found.copy())
                elif any(_similar(x, found, percent) for x in mine if whose == (a[i], part[i])):
                    left.append(a[i])
                    right.append(doc[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    texts = docs.select(F.col("doc_id").alias("doc"), "text").withColumn("slot", slot)
    sets = texts.mapInArrow(sets_of, "doc long, found binary")
    return (
        needed.join(sets, "doc")
        .select("a", "part", "member", "doc", "found")
        .repartition("a", "part")
        .sortWithinPartitions("a", "part", "member")
        .mapInArrow(verify, "a long, b long")
    )


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    spot = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[spot] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def jaccard_join(docs: DataFrame, words: int = shingles.WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lowered. A set holds the distinct runs of
    ``words`` words; a shorter text is one shingle; null, empty and blank texts have an empty set
    and no link. Documents link when their sets' Jaccard similarity is ``percent`` or more.
    ``component_id`` is the smallest doc_id reachable by links, itself included. A doc_id shared by
    several rows is one node with the links of each; a null doc_id has no links and a null
    component. No rows give no rows; other columns of ``docs`` are ignored.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    frequent = frequent_shingles(docs, words)
    signed = staged(signatures(docs, words, percent, frequent), "jaccard-signed")

    # the smallest doc_id of each set, by way of 64 parts so that no join meets all copies at once
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part")
    some = signed.filter("n > 0").groupBy("digest", part).agg(F.min("doc_id").alias("low"))
    some = staged(some, "jaccard-parts")
    low = some.groupBy("digest").agg(F.min("low").alias("stands"))
    stands = some.select("digest", "part").join(low, "digest")
    member = signed.select("doc_id", "n", "digest", part).join(stands, ["digest", "part"], "left")
    member = staged(member.select("doc_id", "n", "stands"), "jaccard-members")

    heads = low.withColumnRenamed("stands", "doc_id")
    postings = (
        signed.join(heads, ["digest", "doc_id"])
        .select(F.posexplode("prefix").alias("at", "shingle"), "doc_id", "n")
        .select("shingle", F.col("doc_id").alias("doc"), "n", "at")
    )
    lists = staged(leader_pairs(postings, percent), "jaccard-lists")
    counted = lists.filter("leader is not null").groupBy(
        F.col("leader").alias("a"), F.col("doc").alias("b"), F.col("leader_n").alias("n_a"), F.col("n").alias("n_b")
    )
    first = staged(within_bound(counted.agg(F.count("*").alias("shared")), percent), "jaccard-first")
    links = staged(similar_pairs(docs, first, words, percent), "jaccard-links")
    clusters = components(links, "jaccard-clusters")

    labelled = lists.join(clusters.toDF("doc", "component"), "doc", "left").select(
        "shingle", "doc", "n", "at", F.coalesce("component", "doc").alias("cluster")
    )
    labelled = staged(labelled, "jaccard-labelled")
    mixed = labelled.groupBy("shingle").agg(F.min("cluster").alias("c0"), F.max("cluster").alias("c1"))
    mixed = mixed.filter("c0 < c1").select("shingle")
    across = labelled.join(mixed, "shingle", "left_semi")
    standing = signed.join(heads, ["digest", "doc_id"]).withColumnRenamed("doc_id", "doc")
    marked = across.join(standing.select("doc", "bitmap"), "doc").select("shingle", "doc", "n", "at", "cluster", "bitmap")
    rest = cross_pairs(marked, percent).distinct().join(first, ["a", "b"], "left_anti")
    rest = within_bound(prefix_overlap(staged(rest, "jaccard-rest"), standing.select("doc", "n", "prefix")), percent)
    more = similar_pairs(docs, rest, words, percent)
    final = components(links.union(more), "jaccard-components").toDF("stands", "component_id")
    return member.join(final, "stands", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "stands", "doc_id")).alias(
            "component_id"
        ),
    )
