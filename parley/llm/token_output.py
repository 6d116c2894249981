"""Token-id files: one long id array with Elias-Fano document boundaries, and their reader.

A file holds a run of documents in ascending doc_id order::

    magic "PTOK0001", width of an id in bytes (1 byte), documents without an id (8 bytes, first in
    order), documents (8 bytes), ids (8 bytes); doc_ids (8 bytes each); ids; boundary code

Boundaries are the end of each document in the array. Files are written under a temporary name and
renamed, so a task that runs again replaces its file by the same bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.llm import tokens
from parley.llm.common import ship
from parley.llm.elias_fano import EliasFano
from parley.session import staged

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
MAGIC = b"PTOK0001"
HEADER = "<8sBQQQ"
#: Text whose ids go to one file, in bytes.
FILE_BYTES = 48 << 20

Batches = Iterator[pa.RecordBatch]


def encoder(vocabulary: str, end_id: int, width: int) -> Callable[[Batches], Batches]:
    """(doc_id, text) to (doc_id, ids): little-endian ids of each whole text, then ``end_id``.

    For vocabularies of lower-case letter runs that drop white space (``tokens.letter_runs``). Null
    counts as empty and has the end id alone.
    """

    def encode(batches: Batches) -> Batches:
        known = tokens.pieces_of(vocabulary, with_ids=True)
        if max(known.tokenizer.get_vocab_size(), end_id + 1) > 1 << 8 * width:
            raise ValueError(f"ids need more than {width} bytes")
        for whole in batches:
            for batch in tokens.slices(whole, "text"):
                lists = tokens.letter_runs(batch.column("text"))
                numbers = known.look_up(lists.flatten())
                counts = known.counts[numbers]
                total = tokens.sums(counts, lists)
                ends = np.cumsum(total + 1)
                # a worker's memory holds far fewer ids than 32 bits can number
                shift = (known.starts[numbers] - (np.cumsum(counts) - counts)).astype(np.int32)
                at = np.repeat(shift, counts)
                at += np.arange(len(at), dtype=np.int32)
                out = np.full(int(ends[-1]), end_id, f"<u{width}")
                inside = np.ones(len(out), bool)
                inside[ends - 1] = False
                out[inside] = known.ids[at]
                offsets = np.concatenate([[0], ends]) * width
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(total), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]
                )
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), data], ["doc_id", "ids"])

    return encode


def writer(path: str, width: int) -> Callable[[Batches], Batches]:
    """(doc_id, ids) of one partition to its file; gives (part, file, n_docs, n_ids)."""

    def write(batches: Batches) -> Batches:
        part = TaskContext.get().partitionId()
        doc_ids, ends, blocks, used = [], [], [], 0
        for batch in batches:
            doc_ids.append(batch.column("doc_id"))
            data = batch.column("ids")
            offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
            blocks.append(data.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0])))
            ends.append((offsets[1:] - offsets[0]) // width + used)
            used += int(offsets[-1] - offsets[0]) // width
        n = sum(map(len, doc_ids))
        if not n:
            return
        keys = pa.chunked_array(doc_ids).combine_chunks()
        fs, folder = pa.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        name = f"{folder}/part-{part:06d}.ptok"
        draft = f"{name}.{TaskContext.get().taskAttemptId()}"
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(draft) as out:
            out.write(struct.pack(HEADER, MAGIC, width, keys.null_count, n, used))
            out.write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for block in blocks:
                out.write(block)
            out.write(EliasFano.encode(np.concatenate(ends), used))
        fs.move(draft, name)
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [n], "n_ids": [used]})

    return write


def write_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    width: int = 2,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the ids of ``docs`` under ``path``; (part, file, n_docs, n_ids) of the files.

    Parts ascend by doc_id, nulls first; equal ones follow each other, in several files if need be.
    Texts are exchanged once and encoded where they are written. ``path`` is a folder that all executors share, given as a URI or
    a plain path.
    """
    ship(docs.sparkSession)
    encode, write = encoder(vocabulary, end_id, width), writer(path, width)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = (
        texts.withColumn("row_id", F.monotonically_increasing_id())
        .repartitionByRange(max(1, -(-total // file_bytes)), "doc_id", "row_id")
        .sortWithinPartitions("doc_id", "row_id")
        .drop("row_id")
        .mapInArrow(lambda batches: write(encode(batches)), "part long, file string, n_docs long, n_ids long")
    )
    return staged(parts, "token-files")


def read_files(parts: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files, from the files alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(row["file"]) as source:
                    data = source.read_buffer()
                magic, width, nulls, n, used = struct.unpack_from(HEADER, data)
                if magic != MAGIC:
                    raise ValueError(f"{row['file']} holds no token ids")
                keys = np.frombuffer(data, "<i8", n, struct.calcsize(HEADER))
                ids = np.frombuffer(data, f"<u{width}", used, struct.calcsize(HEADER) + 8 * n)
                ends = EliasFano(memoryview(data)[struct.calcsize(HEADER) + 8 * n + width * used :]).values()
                starts = np.concatenate([[0], ends[:-1]])
                crc = [
                    zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64(), mask=np.arange(n) < nulls),
                        pa.array(starts + row["base"], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # one row per file, so the single task of this window handles few rows
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return (
        placed.repartition(max(1, parts.count()))
        .select("file", "base")
        .mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_output(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Encodes ``docs``, writes the files under ``path`` and reads them back.

    (doc_id, start, n_tokens, ids_crc32), one row per row of ``docs``: ids of all documents before
    it, ids with the end id, and the unsigned CRC-32 of those ids as 32-bit little-endian integers.
    A null doc_id sorts first; rows that repeat a doc_id follow each other in any order. A null or
    empty text is the end id alone. No rows give no files and no rows; other columns are ignored.
    """
    return read_files(write_files(docs, path, vocabulary, end_id, file_bytes=file_bytes), path)
