"""Rule-based valence scoring of token arrays (Hutto & Gilbert 2014)."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.lookup import inline_lookup
from parley.functions.text import let

# Fixed values of the published model.
ALPHA = 15.0
NEGATION = -0.74
DAMPING = (1.0, 0.95, 0.9)
NEVER_SO = (1.5, 1.25)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5


def adjusted_valences(
    valued: Column | str,
    boosters: Mapping[str, float],
    negators: Collection[str],
    phrases: Mapping[str, float],
) -> Column:
    """array<double> from array<struct<word, value>>: each token's valence after the three tokens
    before it had their say.

    A degree word scores nothing itself and moves its follower away from (or towards) zero; a
    negator flips it, but not "without" with "doubt" between. "never so" and "never this" raise it.
    A word of the lexicon does none of that. "least" flips the word right after it, save in "at
    least" and "very least". A phrase that ends at, or begins with, a token with three others before
    it gives that token its own valence. After a "but", what came before counts half and what
    follows one and a half times.

    Word, value, degree and flip of each token are looked up once; tokens that the lexicon lacks
    are 0 without further work.
    """
    boost, phrase = inline_lookup(boosters, "double"), inline_lookup(phrases, "double")
    negating = sorted(negators)

    def flips(word: Column) -> Column:
        return word.isin(negating) | word.contains("n't") if negating else F.lit(False)

    def marked(token: Column) -> Column:
        word = token["word"]
        return F.struct(
            word.alias("word"), token["value"].alias("value"), boost(word).alias("boost"), flips(word).alias("flips")
        )

    def scored(row: Column) -> Column:
        def near(i: Column, back: int) -> Column:
            return F.get(row, i - back)

        def is_word(i: Column, back: int, *words: str) -> Column:
            return F.coalesce(near(i, back)["word"].isin(list(words)), F.lit(False))

        def between(i: Column, back: int, *words: str) -> Column:
            found = F.lit(False)
            for b in range(1, back):
                found = found | is_word(i, b, *words)
            return found

        def said_by(value: Column, i: Column, back: int) -> Column:
            before = near(i, back)
            push = F.coalesce(before["boost"], F.lit(0.0)) * DAMPING[back - 1]
            moved = value + F.when(value < 0, -push).otherwise(push)
            out = F.when(before["flips"], moved * NEGATION).otherwise(moved)
            if back > 1:
                raised = NEVER_SO[back - 2]
                spared = is_word(i, back, "without") & between(i, back, "doubt")
                out = F.when(spared, moved).otherwise(out)
                out = F.when(is_word(i, back, "never") & between(i, back, "so", "this"), moved * raised).otherwise(out)
            if back == 3 and phrases:
                pairs = [(2, 1), (1, 0), (3, 2), (0, -1)]
                own = [phrase(F.concat_ws(" ", near(i, x)["word"], near(i, y)["word"])) for x, y in pairs]
                out = F.coalesce(own[3], own[1], own[0], own[2], out)
            heard = before.isNotNull() & before["value"].isNull()
            return F.when(heard, out).otherwise(value)

        def step(value: Column, i: Column, back: int) -> Column:
            return let(value, lambda v: said_by(v, i, back))

        def one(token: Column, i: Column) -> Column:
            value = token["value"]
            for back in (1, 2, 3):
                value = step(value, i, back)
            least = is_word(i, 1, "least") & near(i, 1)["value"].isNull() & ~is_word(i, 2, "at", "very")
            value = F.when(least, value * NEGATION).otherwise(value)
            plain = token["value"].isNull() | token["boost"].isNotNull()
            return F.when(plain, F.lit(0.0)).otherwise(value)

        return F.transform(row, one)

    column = F.col(valued) if isinstance(valued, str) else valued
    return let(F.transform(column, marked), lambda row: _after_but(scored(row), row))


def _after_but(values: Column, row: Column) -> Column:
    """Halves what comes before the first "but" and raises what follows it."""
    at = F.array_position(F.transform(row, lambda t: t["word"]), "but")
    weighed = F.transform(
        values, lambda v, i: F.when(i + 1 < at, v * BEFORE_BUT).when(i + 1 > at, v * AFTER_BUT).otherwise(v)
    )
    return F.when(at > 0, weighed).otherwise(values)


def polarity(valences: Column | str) -> Column:
    """struct<compound, positive, neutral, negative> of one text's valences; zeros when empty."""
    zero = F.lit(0.0)

    def sums(values: Column) -> Column:
        def total(keep: Callable[[Column], Column]) -> Column:
            return F.aggregate(F.filter(values, keep), zero, lambda acc, v: acc + F.abs(v) + 1.0)

        return F.struct(
            F.aggregate(values, zero, lambda acc, v: acc + v).alias("s"),
            total(lambda v: v > 0).alias("pos"),
            total(lambda v: v < 0).alias("neg"),
            F.size(F.filter(values, lambda v: v == 0)).cast("double").alias("neu"),
        )

    def scores(t: Column) -> Column:
        whole = t["pos"] + t["neg"] + t["neu"]
        compound = t["s"] / F.sqrt(t["s"] * t["s"] + ALPHA)
        return F.struct(
            F.round(compound, 4).alias("compound"),
            *[
                F.when(whole > 0, F.round(t[part] / whole, 3)).otherwise(zero).alias(name)
                for part, name in (("pos", "positive"), ("neu", "neutral"), ("neg", "negative"))
            ],
        )

    column = F.col(valences) if isinstance(valences, str) else valences
    return let(let(column, sums), scores)
