"""Token annotation: words, normal forms, lemmas, tags and phrases as array columns.

One row stays one row. The arrays are computed inside it, so the steps need no key, no shuffle and
no state, and run unchanged on a stream.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.functions.lookup import Dictionary, map_tokens
from parley.functions.rows import each
from parley.sources.wordlists import DEFAULT_TAG, LEMMAS, STOP_WORDS, TAGS

# Phrase shapes. One or more of the first tag, then one of the second.
CHUNK_SHAPES = (("JJ", "NN"), ("NN", "NN"))

FINISHED = {
    "no_stop_lemmatized": "finished_no_stop_lemmatized",
    "normalized": "finished_normalized",
    "tokenized": "finished_tokenized",
}


def assemble_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``document``, the text to annotate; a null text becomes an empty one."""
    return df.withColumn("document", F.coalesce(F.col(text), F.lit("")))


def nlp_tokenize(df: DataFrame) -> DataFrame:
    return df.withColumn("tokenized", tx.word_tokens("document"))


def normalize(df: DataFrame, letters: str = "unicode") -> DataFrame:
    return df.withColumn("normalized", tx.normalized("tokenized", letters))


def lemmatize(df: DataFrame, lemmas: Dictionary = LEMMAS) -> DataFrame:
    """Adds ``lemmatized``: each normal form's lemma, or the form itself."""
    return map_tokens(
        df,
        "normalized",
        lemmas,
        "lemmatized",
        "string",
        lambda token, lemma: F.coalesce(lemma, token),
    )


def clean_stopwords(
    df: DataFrame, stop_words: Collection[str] | DataFrame = STOP_WORDS
) -> DataFrame:
    """Adds ``no_stop_lemmatized``: the lemmas that are not stop words."""
    if not isinstance(stop_words, DataFrame):
        return df.withColumn(
            "no_stop_lemmatized", tx.without_words("lemmatized", stop_words, case_sensitive=False)
        )
    marked = stop_words.select(F.lower(F.col(stop_words.columns[0])), F.lit(True))
    kept = map_tokens(
        df.withColumn("_lower", F.transform("lemmatized", lambda t: F.lower(t))),
        "_lower",
        marked,
        "_stop",
        "boolean",
        lambda token, stop: stop,
    )
    named = F.zip_with("lemmatized", "_stop", lambda t, s: F.when(s.isNull(), t))
    return kept.withColumn("no_stop_lemmatized", F.array_compact(named)).drop("_lower", "_stop")


def pos_tag(
    df: DataFrame,
    tags: Dictionary = TAGS,
    tokens: str = "lemmatized",
) -> DataFrame:
    """Adds ``pos``: one tag per token, a noun where the table has none."""
    return map_tokens(
        df,
        tokens,
        tags,
        "pos",
        "string",
        lambda token, tag: F.coalesce(tag, F.lit(DEFAULT_TAG)),
    )


def chunk(
    df: DataFrame,
    shapes: Sequence[tuple[str, str]] = CHUNK_SHAPES,
    tokens: str = "lemmatized",
) -> DataFrame:
    """Adds ``ngrams``: the phrases of each shape, shape by shape, in order of appearance.

    Tokens and tags are written as ``token/TAG `` and the longest runs are cut from that line, so
    the work grows with the length of the text only. Tokens must not hold "/" or a blank.
    """
    tagged = F.array_join(
        F.zip_with(tokens, "pos", lambda t, p: F.concat(t, F.lit("/"), p, F.lit(" "))), ""
    )

    def phrases(line: Column) -> Column:
        return F.concat(*[_runs(line, many, last) for many, last in shapes])

    bare = F.transform(
        tx.let(tagged, phrases), lambda p: F.rtrim(F.regexp_replace(p, r"/[A-Z$]+ ", " "))
    )
    return df.withColumn("ngrams", bare)


def _runs(line: Column, many: str, last: str) -> Column:
    """Runs of ``many`` with the ``last`` that ends them; of one tag alone, runs of two or more."""
    run = rf"(?<![^ ])(?:[^/ ]++/{many} )++"
    if many == last:
        found = F.regexp_extract_all(line, F.lit(run), F.lit(0))
        return F.filter(found, lambda r: r.rlike(r"^[^ ]+ [^ ]"))
    found = F.regexp_extract_all(line, F.lit(rf"{run}(?:[^/ ]++/{last} )?"), F.lit(0))
    return F.filter(found, lambda r: r.endswith(f"/{last} "))


def finish(df: DataFrame) -> DataFrame:
    """Keep the input columns and three token arrays under their final names."""
    working = {"document", "lemmatized", "pos", "ngrams", *FINISHED}
    kept = [c for c in df.columns if c not in working]
    return df.select(*kept, *[F.col(a).alias(b) for a, b in FINISHED.items()])


def processed_text(df: DataFrame) -> DataFrame:
    """Adds ``processed_text``: the lemmas without stop words, as one line."""
    return df.withColumn("processed_text", F.array_join("finished_no_stop_lemmatized", " "))


def annotate(
    df: DataFrame,
    text: str = "text",
    lemmas: Dictionary = LEMMAS,
    stop_words: Collection[str] | DataFrame = STOP_WORDS,
    letters: str = "unicode",
) -> DataFrame:
    """Input columns, the three finished token arrays and ``processed_text``.

    Tags and phrases never reach this table; ``noun_chunks`` returns them.
    """
    return (
        df.transform(assemble_documents, text)
        .transform(nlp_tokenize)
        .transform(normalize, letters)
        .transform(lemmatize, lemmas)
        .transform(clean_stopwords, stop_words)
        .transform(finish)
        .transform(processed_text)
    )


def noun_chunks(
    df: DataFrame,
    text: str = "text",
    id: str = "id",
    lemmas: Dictionary = LEMMAS,
    tags: Dictionary = TAGS,
    letters: str = "unicode",
) -> DataFrame:
    """(id, chunk): one row per phrase."""
    chunked = (
        df.select(id, text)
        .transform(assemble_documents, text)
        .transform(nlp_tokenize)
        .transform(normalize, letters)
        .transform(lemmatize, lemmas)
        .transform(pos_tag, tags)
        .transform(chunk)
    )
    return each(chunked, "chunk", F.col("ngrams"), id)
