import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parley.llm import tokens
from parley.llm.elias_fano import EliasFano
from parley.llm.token_counts import token_counts
from parley.llm.token_output import token_output
from parley.session import work_dir

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
TRICKY = [
    "", " ", "  ", "a  b", "a   b\n\n c", " lead", "trail ", "x\ty z", "don't we'll I'M", "a\n b", "a \nb", "\x00a b",
    "a<|endoftext|>b", "a <|endoftext|> b", "<|startoftext|> hi", "no break  wide", "é ́x", "İstanbul ẞ",
    "日本語 テキスト", "ÀÉÎõü×÷ß Straße,(ÑANDÚ)...x", "a1b22c_d-e", "<|startoftext|><|x", "ªº µm", "e\u0301a É\u0301", "😀 👩‍👩‍👧", "a\x85 b", "a\x1c b", "word " * 3000, "x" * 5000, "1234 5 6", "$$$ &&& ***",
]


def library(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def by_pieces(name, split, texts):
    known = tokens.Pieces(public_tokenizers.path(name), with_ids=True)
    lists = split(pa.array(texts, pa.string()))
    numbers = known.look_up(lists.flatten())
    ids = [known.ids[known.starts[n] : known.starts[n] + known.counts[n]] for n in numbers]
    out, at = [], 0
    for length in [len(x) for x in lists.to_pylist()]:
        out.append([int(i) for part in ids[at : at + length] for i in part])
        at += length
    return out


@pytest.mark.parametrize("name, split", [(BYTE, tokens.blank_kept), (WORD, tokens.letter_runs)])
def test_pieces_give_the_librarys_ids(name, split):
    assert by_pieces(name, split, TRICKY) == library(name, TRICKY)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sÄßÉ,;-5×té\n\t ́😀1.<|endoftext|>"), max_size=40), min_size=1, max_size=5))
def test_any_text(texts):
    for name, split in ((BYTE, tokens.blank_kept), (WORD, tokens.letter_runs)):
        assert by_pieces(name, split, texts) == library(name, texts)


def test_letter_runs():
    texts = ["Word, WORD!(word)", None, "word's x1y2 12", "", " \n ", "ÀÉß×é é<|x 東京 a\tb", "end"]
    assert tokens.letter_runs(pa.array(texts)).to_pylist() == [
        ["word", ",", "word", "!(", "word", ")"], [], ["word's", "x", "1", "y", "2", "1", "2"], [], [],
        ["ÀÉß×é", "é<|x", "東京", "a\tb"], ["end"],
    ]
    assert tokens.letter_runs(pa.array(["ÀÉß é", "A"])[1:]).to_pylist() == [["a"]]
    assert tokens.letter_runs(pa.array([], pa.string())).to_pylist() == []


def test_output_in_several_files(spark):
    """Ids that repeat and nulls go over several files, and starts go on from file to file."""
    rows = [(i // 40 if i % 3 else None, f"Text number {i}, again and again. " * 5) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = work_dir(spark, "files")
    got = sorted(token_output(docs, path, file_bytes=6000).collect(), key=lambda r: r.start)
    files = spark.read.format("binaryFile").load(path).select("path").count()
    assert files > 8
    assert [r.doc_id if r.doc_id is not None else -1 for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]
    ids = library(WORD, [t for _, t in rows])
    want = [(i or -1, len(x) + 1, zlib.crc32(np.array([*x, 1], "<u4"))) for (i, _), x in zip(rows, ids)]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)


def test_memory_is_bounded():
    known = tokens.Pieces(public_tokenizers.path(WORD), with_ids=True, most=50)
    for k in range(10):
        known.look_up(pa.array([f"w{k}x{i}" for i in range(20)]))
        assert len(known.known) <= 50


def test_pieces_met_again_are_kept(monkeypatch):
    """Ten batches overflow the memory several times; a word of every batch is learned once, with its ids."""
    learned = []
    learn = tokens.Pieces._learn
    monkeypatch.setattr(tokens.Pieces, "_learn", lambda self, new: (learned.extend(new), learn(self, new)))
    for with_ids in (True, False):
        known = tokens.Pieces(public_tokenizers.path(WORD), with_ids, most=50)
        learned.clear()
        for k in range(10):
            words = [f"w{k}x{i}" for i in range(20)] + ["often", "unquestionably"]
            numbers = known.look_up(pa.array(words))
            want = library(WORD, words)
            assert [int(known.counts[n]) for n in numbers] == [len(x) for x in want]
            if with_ids:
                assert [known.ids[known.starts[n] : known.starts[n] + len(x)].tolist() for n, x in zip(numbers, want)] == want
        assert learned.count("often") == learned.count("unquestionably") == 1


def test_signs_that_end_words_are_pieces():
    texts = ["Word, word. No... a) b! é. 5; it's.", "end.", "a . b.c", None]
    assert tokens.blank_kept(pa.array(texts)).to_pylist() == [
        ["Word", ",", " word", ".", " No...", " a)", " b", "!", " é.", " 5", ";", " it's", "."],
        ["end", "."], ["a", " .", " b.c"], [""],
    ]


def test_counts_of_edge_rows(edge_docs, edge_rows):
    got = token_counts(edge_docs, limit=60).collect()
    ids = library(BYTE, [t or "" for _, t in edge_rows])
    want = [(i or -1, len((t or "").encode()), len(x), len(x) > 60) for (i, t), x in zip(edge_rows, ids)]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)


def test_output_of_edge_rows(spark, edge_docs, edge_rows):
    got = token_output(edge_docs, work_dir(spark, "out")).collect()
    got.sort(key=lambda r: r.start)
    assert [r.doc_id or -1 for r in got] == sorted(i or -1 for i, _ in edge_rows)
    ids = library(WORD, [t or "" for _, t in edge_rows])
    want = [(i or -1, len(x) + 1, zlib.crc32(np.array([*x, 1], "<u4"))) for (i, _), x in zip(edge_rows, ids)]
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]


def test_no_rows(spark, no_docs):
    assert token_counts(no_docs).count() == 0
    assert token_output(no_docs, work_dir(spark, "out")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3000), max_size=1500), st.integers(0, 50))
def test_elias_fano_round_trip(steps, extra):
    values = np.cumsum(np.array(steps, np.int64)) if steps else np.zeros(0, np.int64)
    universe = int(values[-1]) + extra if steps else extra
    data = EliasFano.encode(values, universe)
    code = EliasFano(data)
    assert code.values().tolist() == values.tolist()
    for i in range(0, len(values), 97):
        assert code.select(i) == values[i]
    if len(values) > 500:
        assert len(data) < 4 * len(values)
    with pytest.raises(IndexError):
        code.select(len(values))
