"""Part-of-speech tags from their neighbours: a hidden Markov model that a tag table constrains.

The table gives each word its possible tags (``"JJ|NN"``); a word without an entry has one. How tags
follow each other is learned from all texts by expectation maximisation over neighbouring words. Two
words matter only by their sets of tags, so one aggregate counts pairs of sets, and the rounds of
learning run on that table, which the sets bound. A token with one possible tag cuts the sequence, so
the best path is sought run by run between such tokens, within the row. Short runs have few forms, so
their paths are a table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.lookup import Dictionary, inline_lookup, map_tokens
from parley.functions.rows import each
from parley.functions.text import let
from parley.sources.wordlists import DEFAULT_TAG

#: What comes before the first and after the last token.
START, END = "^", "$"
ROUNDS = 4
SMOOTHING = 0.1
#: Sets of tags that a table may use.
MOST_SETS = 500
#: Costs are whole millionths of a natural logarithm, so that ties are ties everywhere.
SCALE = 1_000_000
#: Runs of open tokens whose paths are worked out beforehand, at most.
MOST_RUNS = 2000


def tag_sets(df: DataFrame, options: Dictionary, tokens: str = "lemmatized") -> DataFrame:
    """Adds ``tag_sets``: each token's possible tags, sorted and joined by ``|``."""

    def of(token: Column, tags: Column) -> Column:
        listed = F.array_join(F.array_sort(F.array_distinct(F.split(tags, r"\|"))), "|")
        return F.coalesce(listed, F.lit(DEFAULT_TAG))

    return map_tokens(df, tokens, options, "tag_sets", "string", of)


def set_pairs(df: DataFrame) -> DataFrame:
    """(a, b, n): how often tokens of two tag sets follow each other, the ends of texts included."""
    whole = F.concat(F.array(F.lit(START)), "tag_sets", F.array(F.lit(END)))
    pairs = F.zip_with(
        F.slice(whole, F.lit(1), F.size(whole) - 1),
        F.slice(whole, F.lit(2), F.size(whole) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    rows = each(df.filter(F.size("tag_sets") > 0), "p", pairs)
    return rows.groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def learned_costs(
    pairs: Iterable[tuple[str, str, int]], rounds: int = ROUNDS, smoothing: float = SMOOTHING
) -> dict[tuple[str, str], int]:
    """What it costs that one tag follows another: the scaled negative logarithm of its chance.

    A pair of sets is shared out over its pairs of tags in proportion to their current weight
    (evenly at first), and the sums are the next weights.
    """
    pairs = [(a.split("|"), b.split("|"), n) for a, b, n in sorted(pairs)]
    weight: dict[tuple[str, str], float] = {(a, b): 1.0 for left, right, _ in pairs for a in left for b in right}
    for _ in range(rounds):
        sums = dict.fromkeys(weight, 0.0)
        for left, right, n in pairs:
            total = sum(weight[a, b] for a in left for b in right)
            if total > 0:
                for a in left:
                    for b in right:
                        sums[a, b] += n * weight[a, b] / total
        weight = sums
    lefts, rights = ({t[k] for t in weight} for k in (0, 1))
    out = {}
    for a in lefts:
        row = sum(weight.get((a, b), 0.0) for b in sorted(rights)) + smoothing * len(rights)
        for b in rights:
            out[a, b] = round(-SCALE * math.log((weight.get((a, b), 0.0) + smoothing) / row))
    return out


def learn(df: DataFrame, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> dict[tuple[str, str], int]:
    """``learned_costs`` of rows with ``tag_sets``; at most MOST_SETS squared counts reach the driver."""
    rows = set_pairs(df).limit(MOST_SETS**2 + 1).collect()
    if len(rows) > MOST_SETS**2:
        raise ValueError(f"more than {MOST_SETS} sets of tags")
    return learned_costs([tuple(r) for r in rows], rounds, smoothing)


def open_sets(options: Mapping[str, str]) -> list[str]:
    """The sets of several tags that a tag table uses, as ``tag_sets`` writes them."""
    sets = {"|".join(sorted(set(tags.split("|")))) for tags in options.values() if tags is not None}
    return sorted(s for s in sets if "|" in s)


def short_runs(costs: Mapping[tuple[str, str], int], sets: Collection[str]) -> dict[str, str]:
    """The cheapest path of every run of few open tokens, by the tag before it, its sets and the tag after it.

    All runs of one token, then of two and so on, as long as there are MOST_RUNS of them at most.
    """
    lefts, rights = (sorted({pair[k] for pair in costs}) for k in (0, 1))
    out: dict[str, str] = {}
    length, count = 1, len(lefts) * len(rights) * len(sets)
    while 0 < len(out) + count <= MOST_RUNS and count:
        for before, run, after in itertools.product(lefts, itertools.product(sets, repeat=length), rights):
            try:
                out[" ".join([before, *run, after])] = " ".join(_cheapest(before, run, after, costs))
            except KeyError:  # tags that never meet
                continue
        length, count = length + 1, count * len(sets)
    return out


def _cheapest(before: str, run: Iterable[str], after: str, costs: Mapping[tuple[str, str], int]) -> tuple[str, ...]:
    """What ``sequence_tag`` gives a run, for one that is known beforehand."""
    states: list[tuple[int, str, tuple[str, ...]]] = [(0, before, ())]
    for tags in run:
        found = []
        for tag in tags.split("|"):
            cost, _, path = min((c + costs[last, tag], last, (*path, tag)) for c, last, path in states)
            found.append((cost, tag, path))
        states = found
    return min((c + costs[last, after], last, path) for c, last, path in states)[2]


def sequence_tag(
    df: DataFrame, costs: Mapping[tuple[str, str], int], sets: Collection[str] = ()
) -> DataFrame:
    """Adds ``pos``: the cheapest sequence of possible tags; among equals the smaller tag earlier on.

    ``costs`` must know every pair of tags that can meet. Tags must hold no blank. ``sets`` (see
    ``open_sets``) changes no result: short runs of them are looked up.
    """
    known = short_runs(costs, sets)
    short = inline_lookup(known, "string") if known else lambda key: F.lit(None).cast("string")
    find = inline_lookup({f"{a} {b}": cost for (a, b), cost in costs.items()}, "bigint")

    def cost(a: Column, b: Column) -> Column:
        return find(F.concat(a, F.lit(" "), b))

    def best(run: Column, before: Column, after: Column) -> Column:
        def step(states: Column, tags: Column) -> Column:
            def reach(tag: Column) -> Column:
                ways = F.transform(
                    states,
                    lambda s: F.struct(
                        (s["cost"] + cost(s["tag"], tag)).alias("cost"),
                        s["tag"].alias("tag"),
                        F.concat(s["path"], F.array(tag)).alias("path"),
                    ),
                )
                return let(F.array_min(ways), lambda w: F.struct(w["cost"], tag.alias("tag"), w["path"]))

            return F.transform(F.split(tags, r"\|"), reach)

        def end(states: Column) -> Column:
            ways = F.transform(
                states,
                lambda s: F.struct((s["cost"] + cost(s["tag"], after)).alias("cost"), s["tag"], s["path"]),
            )
            return F.array_min(ways)["path"]

        start = F.struct(
            F.lit(0).cast("long").alias("cost"),
            before.alias("tag"),
            F.array().cast("array<string>").alias("path"),
        )
        return F.aggregate(run, F.array(start), step, end)

    line = F.concat(F.array_join("tag_sets", " "), F.lit(" "))
    # runs of sure and of open tokens in turn
    runs = F.regexp_extract_all(line, F.lit(r"(?:[^ |]++ )++|(?:[^ |]*+\|[^ ]*+ )++"), F.lit(0))

    def tags_of(runs: Column) -> Column:
        def open_run(run: Column, i: Column) -> Column:
            before = F.coalesce(F.substring_index(F.rtrim(F.get(runs, i - 1)), " ", -1), F.lit(START))
            after = F.coalesce(F.substring_index(F.get(runs, i + 1), " ", 1), F.lit(END))
            path = short(F.concat(before, F.lit(" "), run, after))
            sought = F.array_join(best(F.split(F.rtrim(run), " "), before, after), " ")
            return F.concat(F.coalesce(path, sought), F.lit(" "))

        tagged = F.transform(runs, lambda run, i: F.when(run.contains("|"), open_run(run, i)).otherwise(run))
        return F.split(F.rtrim(F.array_join(tagged, "")), " ")

    empty = F.array().cast("array<string>")
    return df.withColumn("pos", F.when(F.size("tag_sets") > 0, let(runs, tags_of)).otherwise(empty))
