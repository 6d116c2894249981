"""Language ID: n-gram presence kernels, Nystrom landmarks, one-versus-rest kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1 to 3) that both hold, over the
geometric mean of their own counts. It spans the usual n-grams of all training texts, counted in one
aggregate; a second one adds up the normal equations of the regression over all of them. A text's kernel
values to the landmarks are one product of its presence row with the landmarks' rows, and the
classifiers' outputs are a second product; both are taken for a batch of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm import tokens
from parley.llm.common import ship
from parley.session import staged

#: Landmarks of a language.
LANDMARKS = 24
#: A feature is held by two texts at least and by this share of some language's training texts, so a
#: language has no more of them than 100 texts have n-grams, and noise in few texts adds none.
LEAST_SHARE = 0.01
#: N-grams that a counting window holds, and steps of the histogram of known shares.
WINDOW = 1_000_000
STEPS = 1 << 16
#: The most usual letters, whose n-grams have a dense table; those with others are looked up by code.
ALPHABET = 126
RIDGE = 1e-2
#: A text is rejected under this part of the share of known 3-grams that nearly all learned texts reach.
KNOWN_MARGIN = 2 / 3
#: Characters of a text handled at a time.
PART = 1 << 20
FOLDS = 5
_LETTER: list[np.ndarray] = []


def held_out() -> Column:
    """Whether a document is kept out of training: the CRC-32 of its doc_id falls in fold 0."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case and the text that each belongs to.

    Runs of characters other than letters are one 0, and every text begins and ends with a 0.
    """
    if not _LETTER:
        _LETTER.append(np.array([c == 0 or chr(c).isalpha() for c in range(0x110000)]))
    lowered = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    joined = "\x00" + "\x00\x00".join(lowered.to_pylist()) + "\x00"
    size = pc.utf8_length(lowered).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    points[~_LETTER[0][points]] = 0
    owner = np.repeat(np.arange(len(size)), size + 2)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0) | (owner[1:] != owner[:-1])
    return points[keep], owner[keep]


def parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``letters`` of all texts, a long one in turns, cut at blanks, where no n-gram is broken."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    long = size > PART
    yield letters(pc.if_else(pa.array(long), "", texts) if long.any() else texts)
    for i in np.flatnonzero(long).tolist():
        text, start = texts[i].as_py(), 0
        while start < len(text):
            stop = text.find(" ", start + PART) + 1 or len(text)
            points, owner = letters(pa.array([text[start:stop]]))
            yield points, owner + i
            start = stop


def has_letters(texts: pa.Array) -> np.ndarray:
    found = np.zeros(len(texts), bool)
    for points, owner in parts(texts):
        found[owner[points > 0]] = True
    return found


def grams(texts: pa.Array) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, 21 bits a character (code point plus 1).

    None goes across a blank, though it may begin or end with one.
    """
    points, owner = letters(texts)
    for p in np.split(points + 1, np.searchsorted(owner, np.arange(1, len(texts)))):
        two = p[:-1] << 21 | p[1:]
        three = (two[:-1] << 21 | p[2:])[p[1:-1] > 1]
        yield np.unique(np.concatenate([p, two, three]))


@dataclass
class Model:
    languages: list[str]
    alphabet: np.ndarray  # code point -> number; 0 for other characters, 1 for less usual letters
    base: int  # how many numbers there are
    numbers: np.ndarray  # n-gram of usual letters -> its column, or the last one for unknown n-grams
    rare: np.ndarray  # codes of n-grams with less usual letters, as ``grams`` has them, sorted
    rare_columns: np.ndarray  # their columns
    landmarks: np.ndarray  # columns x landmarks, rows over their norm
    outputs: np.ndarray  # landmarks x languages

    def codes(self, p: np.ndarray) -> list[np.ndarray]:
        """Codes of the 1-, 2- and 3-grams that begin at each character number, along the first axis."""
        base = self.base
        one = p + base**3 + base**2
        two = p[:-1] * base + p[1:] + base**3
        three = p[:-2] * base**2 + p[1:-1] * base + p[2:]
        return [one, two, three]

    def _rare_column(self, points: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Columns of the n-grams of k + 1 characters that begin at ``at``."""
        code = points[at] + 1
        for j in range(1, k + 1):
            code = code << 21 | (points[at + j] + 1)
        spot = np.minimum(np.searchsorted(self.rare, code), len(self.rare) - 1)
        return np.where(self.rare[spot] == code, self.rare_columns[spot], self.landmarks.shape[0])

    def outputs_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's classifier outputs, and whether it holds a letter."""
        return self.evidence(texts)[:2]

    def evidence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``outputs_of`` and, of the 3-grams of each text, the share that the model knows."""
        near, has_letter, known = self.kernel(texts)
        return near @ self.outputs, has_letter, known

    def kernel(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's kernel values to the landmarks, and as ``evidence``."""
        rows, has_letter, known = self.presence(texts)
        return rows @ self.landmarks, has_letter, known

    def presence(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which n-grams each text holds, over the root of their number, and as ``evidence``."""
        n, width = len(texts), self.landmarks.shape[0]
        present = np.zeros((n, width + 1), bool)
        has_letter = np.zeros(n, bool)
        known, whole_count = np.zeros(n, np.int64), np.zeros(n, np.int64)
        flat = present.reshape(-1)
        for points, owner in parts(texts):
            has_letter[owner[points > 0]] = True
            numbered = self.alphabet[points]
            less_usual = numbered == 1
            for k, code in enumerate(self.codes(numbered)):
                first = owner[: len(code)]
                whole = first == owner[len(owner) - len(code) :]
                if len(points) - len(code) == 2:
                    whole &= points[1:-1] > 0
                column = self.numbers[code]
                if len(self.rare) and less_usual.any():
                    here = np.flatnonzero(np.logical_or.reduce([less_usual[j : j + len(code)] for j in range(k + 1)]))
                    column[here] = self._rare_column(points, here, k)
                column = column[whole]
                flat[first[whole] * (width + 1) + column] = True
                if len(points) - len(code) == 2:
                    known += np.bincount(first[whole][column < width], minlength=n)
                    whole_count += np.bincount(first[whole], minlength=n)
        present = present[:, :width].astype(np.float32)
        norm = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return present / norm, has_letter, known / np.maximum(whole_count, 1)


def _labelled(docs: DataFrame, which: Column, per_language: int | None) -> DataFrame:
    """(doc_id, lang, text) of the labelled documents ``which``, by ``per_language`` at most that many a language.

    Those of a bounded number are taken by a hash of doc_id.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & which).select("doc_id", "lang", "text")
    if per_language is None:
        return known
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("rank", F.row_number().over(order))
    chosen = chosen.filter(F.col("rank") <= per_language).select("doc_id", "lang").distinct()
    # at most per_language rows a language, so this side may be sent whole
    return known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts (lang, text), reported whenever WINDOW n-grams are held."""
    tokens.forget()
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def report() -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            columns = [pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    for whole in batches:
        for batch in tokens.slices(whole, "text", 1 << 20):
            for lang, found in zip(batch.column("lang").to_pylist(), grams(batch.column("text")), strict=True):
                if len(found) > 1:
                    held.setdefault(lang, []).append(np.append(found, 0))
                    size += len(found)
            if size >= WINDOW:
                yield from report()
                held, size = {}, 0
    yield from report()


def _gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): how many of a language's texts hold an n-gram; 0 stands for any text with a letter."""
    rows = texts.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, per_language: int | None = None, landmarks: int = LANDMARKS) -> Model | None:
    """Learns from text and lang of all documents outside fold 0; None without any.

    ``per_language`` bounds the documents of a language, for a quicker and rougher model. Landmarks are
    the first texts by a hash of doc_id, so nothing depends on row order.
    """
    spark = docs.sparkSession
    texts = _labelled(docs, ~held_out(), per_language)
    counts = staged(_gram_counts(texts), "language-grams")
    sizes = {r["lang"]: r["n"] for r in counts.filter("gram = 0").collect()}
    if not sizes:
        return None
    least = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, LEAST_SHARE * n)])
    usual = F.max(F.col("n") >= least[F.col("lang")])
    features = counts.filter("gram > 0").groupBy("gram").agg(F.sum("n").alias("n"), usual.alias("usual"))
    single = features.filter(f"gram < {1 << 21} and gram > 1").orderBy(F.desc("n"), "gram").limit(ALPHABET).toPandas()
    chosen = features.filter("usual and n > 1").select("gram").toPandas()
    if chosen.empty:  # no n-gram is in two texts
        chosen = features.filter("usual").select("gram").toPandas()

    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "hash")
    first = texts.filter(F.col("text").rlike(r"\p{L}")).select("lang", "doc_id", F.xxhash64("text").alias("hash"), "text")
    places = first.drop("text").withColumn("rank", F.row_number().over(order))
    places = F.broadcast(places.filter(F.col("rank") <= landmarks))
    marks = first.join(places, ["lang", "doc_id", "hash"], "left_semi").select("lang", "text", F.xxhash64("doc_id").alias("at"), "hash")
    marks = marks.toPandas().sort_values(["lang", "at", "hash"], ignore_index=True).groupby("lang").head(landmarks)
    if marks.empty:
        return None
    model = _spanned(sorted(sizes), single["gram"].to_numpy(np.int64) - 1, np.sort(chosen["gram"].to_numpy(np.int64)))
    root = _set_landmarks(model, pa.array(marks["text"].tolist(), pa.string()))

    shared = spark.sparkContext.broadcast((model, root))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        model, root = shared.value
        gram, sums = np.zeros(root.shape), np.zeros((len(model.languages), len(root)))
        for whole in batches:
            for batch in tokens.slices(whole, "text", 1 << 20):
                near, has_letter, _ = model.kernel(batch.column("text"))
                values = (near @ root)[has_letter]
                lang = np.searchsorted(model.languages, np.array(batch.column("lang").to_pylist())[has_letter])
                weight = np.array([1 / sizes[x] for x in model.languages])[lang]
                gram += values.T @ (weight[:, None] * values)
                np.add.at(sums, lang, weight[:, None] * values)
        value = np.concatenate([gram, sums]).ravel()
        if value.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], ["cell", "value"])

    cells = texts.select("lang", "text").mapInArrow(add_up, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = cells.toPandas()
    total = np.zeros((len(root) + len(sizes), len(root)))
    total.flat[found["cell"].to_numpy()] = found["value"].to_numpy().round(9)  # whatever order they were added in
    gram, sums = total[: len(root)], total[len(root) :]
    target = 2 * sums - sums.sum(axis=0)
    weights = np.linalg.solve(gram + RIDGE * np.eye(len(root)), target.T)
    model.outputs = (root @ weights).astype(np.float32)
    return model


def _spanned(languages: list[str], usual: np.ndarray, features: np.ndarray) -> Model:
    """A model of these n-grams (as ``grams`` has them), without landmarks; ``usual``: letters by use."""
    alphabet = np.ones(0x110000, np.int32)
    alphabet[0] = 0
    alphabet[usual] = np.arange(2, len(usual) + 2)
    base = len(usual) + 2
    empty = np.zeros(0, np.int64)
    model = Model(languages, alphabet, base, empty, empty, empty, np.zeros((0, 0)), np.zeros((0, 0)))
    mask = (1 << 21) - 1
    codes = []
    for k in range(3):
        g = features[(features >= 1 << 21 * k) & (features < 1 << 21 * (k + 1))]
        # n-grams as runs of characters each: the codes of predict, below 0 with less usual letters
        numbers = np.stack([alphabet[(g >> 21 * j & mask) - 1] for j in range(k, -1, -1)])
        rare = (numbers == 1).any(axis=0)
        codes += [model.codes(numbers[:, ~rare])[k].ravel(), -g[rare]]
    codes = np.sort(np.concatenate(codes))
    usual_codes = codes >= 0
    model.numbers = np.full(base**3 + base**2 + base, len(codes), np.int32)
    model.numbers[codes[usual_codes]] = np.flatnonzero(usual_codes)
    model.rare, model.rare_columns = -codes[~usual_codes][::-1], np.flatnonzero(~usual_codes)[::-1]
    model.landmarks = np.zeros((len(codes), 0), np.float32)
    return model


def _set_landmarks(model: Model, texts: pa.Array) -> np.ndarray:
    """Gives ``model`` the landmarks; returns the inverse root of their kernel."""
    rows = [model.presence(texts.slice(i, 1))[0] for i in range(len(texts))]
    model.landmarks = np.ascontiguousarray(np.concatenate(rows).T)
    kernel = model.landmarks.T @ model.landmarks
    value, vector = np.linalg.eigh(kernel.astype(np.float64))
    value = np.where(value > 1e-6, value, np.inf)
    return vector / np.sqrt(value) @ vector.T


def predict(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    if model is None:
        return ["und"] * len(texts), np.zeros(len(texts))
    outputs, has_letter = model.outputs_of(texts)
    best = outputs.argmax(axis=1)
    names = [model.languages[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)]
    top = outputs[np.arange(len(best)), best].astype(np.float64)
    return names, np.where(has_letter, np.clip((top + 1) / 2, 0, 1), 0.0)


def language_id(docs: DataFrame, per_language: int | None = None, landmarks: int = LANDMARKS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``.

    ``lang_pred`` is a learned language, or ``und`` (score 0) where the text is null or has no
    letter, or nothing could be learned. ``score`` is the winning classifier's output, its targets
    -1 and 1 mapped to 0 and 1. ``held_out`` is false for a null doc_id, which is never learned
    from. Of equal outputs the first language by name wins. Repeated rows and very long texts are
    predicted like any other; no rows give no rows; other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(fit(docs, per_language, landmarks))

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in tokens.slices(whole, "text", 1 << 20):
                names, score = predict(shared.value, batch.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        classify, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )


def rejection_levels(docs: DataFrame, model: Model, per_language: int | None = None) -> np.ndarray:
    """For each language of ``model``, the share of known 3-grams under which a text isn't in it.

    ``KNOWN_MARGIN`` of the share that all but 1 % of its fold-0 texts reach (of all languages' for one
    without any; 0 where there is no fold-0 text at all). All of them count, or ``per_language`` texts
    each; shares are rounded down to steps of 1 / STEPS.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for whole in batches:
            for batch in tokens.slices(whole, "text", 1 << 20):
                _, has_letter, known = shared.value.evidence(batch.column("text"))
                rows = pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(known)], ["lang", "known"])
                yield rows.filter(pa.array(has_letter))

    found = _labelled(docs, held_out(), per_language).select("lang", "text").mapInArrow(shares, "lang string, known double")
    found = found.groupBy("lang", F.floor(F.col("known") * STEPS).alias("step")).agg(F.count("*").alias("n")).toPandas()

    def level(own: pd.DataFrame) -> float:
        own = own.groupby("step")["n"].sum().sort_index()
        return own.index[np.searchsorted(own.cumsum(), (own.sum() - 1) // 100, side="right")] / STEPS

    levels = np.zeros(len(model.languages))
    for i, lang in enumerate(model.languages):
        own = found[found["lang"] == lang]
        own = own if len(own) else found
        levels[i] = KNOWN_MARGIN * level(own) if len(own) else 0
    return levels


def keep_identified(
    docs: DataFrame, least: float = 0.25, per_language: int | None = None, landmarks: int = LANDMARKS
) -> DataFrame:
    """``docs`` without the rows that are in no learned language.

    A row goes when its text has no letter, when its score is under ``least``, or when the model knows
    a smaller share of its 3-grams than the ``rejection_levels`` of the winning language ask for: so
    go letter noise, other scripts and other languages, unless they are spelt like a learned one.
    Where nothing could be learned, all texts that hold letters stay.
    """
    spark = docs.sparkSession
    ship(spark)
    model = fit(docs, per_language, landmarks)
    levels = None if model is None else rejection_levels(docs, model, per_language)
    shared = spark.sparkContext.broadcast((model, levels))

    def claimed(texts: pa.Array) -> np.ndarray:
        model, levels = shared.value
        if model is None:
            return has_letters(texts)
        outputs, has_letter, known = model.evidence(texts)
        best = outputs.argmax(axis=1)
        score = np.clip((outputs.max(axis=1).astype(np.float64) + 1) / 2, 0, 1)
        return has_letter & (score >= least) & (known >= levels[best])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for whole in batches:
            for batch in tokens.slices(whole, "text", 1 << 20):
                yield batch.filter(pa.array(claimed(batch.column("text"))))

    return docs.mapInArrow(pick, docs.schema)
