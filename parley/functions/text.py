"""Text to token arrays. Everything stays inside the row."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in Unicode text.
SPACES = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# Punctuation split off at either end of a word.
EDGE = r".,;:!?*\-()\"'"

# A run of edge punctuation, or a word with edge punctuation only inside it.
WORD_TOKEN = rf"[{EDGE}]+|[^\s{EDGE}](?:\S*[^\s{EDGE}])?"

# What normalising strips from tokens written as one line.
NON_LETTERS = {"unicode": r"[^\p{L}+ ]", "ascii": r"[^a-z ]"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column | str) -> Column:
    """Split on runs of white space; no empty words."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def without_words(
    tokens: Column | str, stop_words: Collection[str], case_sensitive: bool = True
) -> Column:
    stops = sorted(stop_words if case_sensitive else {w.lower() for w in stop_words})
    if not stops:
        return F.col(tokens) if isinstance(tokens, str) else tokens
    if case_sensitive:
        return F.filter(tokens, lambda w: ~w.isin(stops))
    return F.filter(tokens, lambda w: ~F.lower(w).isin(stops))


def lowered(tokens: Column | str) -> Column:
    return F.transform(tokens, lambda w: F.lower(w))


def word_tokens(text: Column | str) -> Column:
    """Words and punctuation runs in order of appearance."""
    return F.regexp_extract_all(text, F.lit(WORD_TOKEN), F.lit(0))


def normalized(tokens: Column | str, letters: str = "unicode") -> Column:
    """Lower-case, strip everything but letters, drop what is left empty.

    The tokens are treated as one line, as none of them holds a blank.
    """
    line = F.regexp_replace(F.lower(F.array_join(tokens, " ")), NON_LETTERS[letters], "")
    return F.filter(F.split(line, " "), lambda t: t != "")


def term_runs(terms: Column | str) -> Column:
    """array<struct<word, tf>>: each distinct term with its count, by run lengths of the sorted terms.

    Counting inside the row keeps repeated ids apart and needs no shuffle.
    """
    nothing = F.array().cast("array<struct<word:string,tf:bigint>>")

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )

        def counted(first: Column) -> Column:
            ends = F.concat(F.slice(first, 2, n), F.array(n + 1))
            return F.zip_with(
                first,
                ends,
                lambda lo, hi: F.struct(
                    F.get(ordered, lo - 1).alias("word"),
                    (hi - lo).cast("bigint").alias("tf"),
                ),
            )

        return F.when(n > 0, let(starts, counted)).otherwise(nothing)

    return let(F.sort_array(terms), runs)
