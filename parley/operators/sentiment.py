"""Sentiment scores of texts."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import scoring
from parley.functions.lookup import Dictionary, map_tokens
from parley.functions.rows import once
from parley.operators.annotate import annotate
from parley.sources.records import lift_fields
from parley.sources.wordlists import BOOSTERS, LEXICON, NEGATORS, PHRASES

SCORES = ["compound", "positive", "neutral", "negative"]


def sentiment(
    df: DataFrame,
    tokens: str = "finished_no_stop_lemmatized",
    lexicon: Dictionary = LEXICON,
    boosters: Mapping[str, float] = BOOSTERS,
    negators: Collection[str] = NEGATORS,
    rules: bool = True,
    phrases: Mapping[str, float] = PHRASES,
) -> DataFrame:
    """Adds ``sentiment`` struct<compound, positive, neutral, negative> from a token array.

    ``rules=False`` takes the plain sum of valences: no degree words, no negation, no phrases. Texts
    are scored as cleaned; pass another token column to score raw ones.
    """
    valued = map_tokens(
        df,
        tokens,
        lexicon,
        "_valued",
        "double",
        lambda word, value: F.struct(word.alias("word"), value.alias("value")),
    )
    if rules:
        values = scoring.adjusted_valences("_valued", boosters, negators, phrases)
    else:
        values = F.transform("_valued", lambda v: F.coalesce(v["value"], F.lit(0.0)))
    return once(valued, "sentiment", scoring.polarity(values)).drop("_valued")


def sentiment_table(
    df: DataFrame,
    text: str = "text",
    lexicon: Dictionary = LEXICON,
    boosters: Mapping[str, float] = BOOSTERS,
    negators: Collection[str] = NEGATORS,
    rules: bool = True,
    phrases: Mapping[str, float] = PHRASES,
    **annotation,
) -> DataFrame:
    """Input columns, finished token arrays, ``processed_text`` and the four scores."""
    annotated = annotate(df, text, **annotation)
    scored = sentiment(
        annotated,
        lexicon=lexicon,
        boosters=boosters,
        negators=negators,
        rules=rules,
        phrases=phrases,
    )
    return lift_fields(scored, "sentiment")
