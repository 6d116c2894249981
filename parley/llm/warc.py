"""WARC archives by way of a chunked record table.

A payload is rows of (record, chunk number, at most CHUNK bytes), each with the size and the digests
of the payload up to its end, so the last chunk's row describes the whole payload. Which record
holds a payload and which ones only refer to it is settled on those last rows. A header row then
joins its record's chunks in one exchange, by sort and not by join, and each task writes its records
chunk by chunk. Reading gives the same rows again: no step after the table that holds the pages has a
payload larger than a chunk in memory.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import ship
from parley.session import staged

CHUNK = 256 << 10
#: Payload bytes that go to one archive, about.
FILE_BYTES = 64 << 20
#: Records with equal payloads are first settled in this many parts.
SALTS = 64
#: Capture time of pages that bring none.
DATE = "2000-01-01T00:00:00Z"
#: Bytes of rows handed on at a time, and the longest header block that is read.
BATCH, HEADER = 4 << 20, 1 << 20
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"

Batches = Iterator[pa.RecordBatch]

_CHUNKS = (
    "row_id long, page_id string, url string, chunk long, packed binary, size long, digest binary, "
    "check binary, last boolean"
)
_RECORDS = (
    "file string, record long, record_type string, record_id string, target_uri string, "
    "headers map<string,string>, http map<string,string>, chunk long, data binary, "
    "payload_bytes long, payload_digest string, last boolean"
)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds["map<string,string>"] = pa.map_(pa.string(), pa.string())
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


class Rows:
    """Collects rows and hands them on in batches of bounded size."""

    def __init__(self, ddl: str) -> None:
        self.schema, self.rows, self.size = arrow_schema(ddl), [], 0

    def add(self, row: tuple, size: int = 0) -> Batches:
        self.rows.append(row)
        self.size += size + 200
        if self.size >= BATCH:
            yield from self.rest()

    def rest(self) -> Batches:
        if self.rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


class Digest:
    """What is known of a payload so far: bytes, SHA-1 and a second hash."""

    def __init__(self) -> None:
        self.size, self.sha1, self.other = 0, hashlib.sha1(), hashlib.blake2b(digest_size=16)

    def update(self, data: bytes | memoryview) -> None:
        self.size += len(data)
        self.sha1.update(data)
        self.other.update(data)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, payload: str = "html", chunk: int = CHUNK) -> DataFrame:
    """The pages as chunk rows, written to the work folder; an empty payload is one empty chunk.

    Chunks are packed (zstd) one by one, as they are written, exchanged and read once more.
    """

    def cut(batches: Batches) -> Batches:
        rows, packer = Rows(_CHUNKS), zstandard.ZstdCompressor()
        for batch in batches:
            known = [batch.column(c).to_pylist() for c in ("row_id", "page_id", "url")]
            for row_id, page_id, url, text in zip(*known, batch.column("payload"), strict=True):
                buffer = text.as_buffer()
                data, digest, at = memoryview(buffer) if buffer else b"", Digest(), 0
                while True:
                    part = data[at * chunk : (at + 1) * chunk]
                    digest.update(part)
                    last = digest.size == len(data)
                    now = digest.size, digest.sha1.digest(), digest.other.digest()
                    packed = packer.compress(part)
                    yield from rows.add((row_id, page_id, url, at, packed, *now, last), len(packed))
                    if last:
                        break
                    at += 1
        yield from rows.rest()

    ship(pages.sparkSession)
    whole = pages.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("page_id").cast("string").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"),
    )
    return staged(whole.mapInArrow(cut, _CHUNKS), "warc-chunks")


def settled(chunks: DataFrame, id_type: str = "bigint", least: int = 0, salts: int = SALTS) -> DataFrame:
    """(row_id, page_id, url, size, digest, first): each record and the one that holds its payload.

    Of records with equal payloads of at least ``least`` bytes the one with the smallest page_id (as
    ``id_type``; null last, then the first row) holds it: its ``first`` is null, that of the others
    is its (row_id, page_id, url). Parts of a group are settled before they meet, and the answer
    goes back to the parts, so that no task has more of a group than a part.
    """
    key = ["size", "digest", "check"]
    number = F.col("page_id").cast(id_type)
    best = F.struct(number.isNull().alias("none"), number.alias("id"), "row_id", "page_id", "url")
    ends = chunks.filter("last").select("row_id", "page_id", "url", *key)
    ends = ends.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int"))
    parts = ends.groupBy("part", *key).agg(F.min(best).alias("best"), F.count("*").alias("n"))
    parts = staged(parts, "warc-parts")
    whole = parts.groupBy(*key).agg(F.min("best").alias("first"), F.sum("n").alias("n"))
    shared = parts.select("part", *key).join(whole.filter("n > 1").drop("n"), key)
    first = F.when(
        (F.col("first.row_id") != F.col("row_id")) & (F.col("size") >= least),
        F.struct("first.row_id", "first.page_id", "first.url"),
    )
    found = ends.join(shared, ["part", *key], "left").withColumn("first", first)
    return found.select("row_id", "page_id", "url", "size", "digest", "first")


def record_id(row_id: int, page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{row_id}')}>"


def _line(value: str) -> str:
    """A value that can't end its header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _block(headers: list[tuple[str, str | None]], first: str) -> bytes:
    lines = [first, *(f"{name}: {_line(value)}" for name, value in headers if value is not None)]
    return "\r\n".join([*lines, "", ""]).encode()


def record_start(row: dict, date: str = DATE) -> bytes:
    """All of a record that comes before its payload."""
    http = _block(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(row["size"]))], "HTTP/1.1 200 OK"
    )
    first = row["first"]
    headers = [
        ("WARC-Type", "revisit" if first else "response"),
        ("WARC-Record-ID", record_id(row["row_id"], row["page_id"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["url"]),
        ("WARC-Payload-Digest", f"sha1:{base32(row['digest'])}"),
        ("X-Page-Id", row["page_id"]),
    ]
    if first:
        headers += [
            ("WARC-Profile", REVISIT),
            ("WARC-Refers-To", record_id(first["row_id"], first["page_id"])),
            ("WARC-Refers-To-Target-URI", first["url"]),
            ("WARC-Refers-To-Date", date),
            ("X-Refers-To-Page-Id", first["page_id"]),
        ]
    headers += [
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(http) + (0 if first else row["size"]))),
    ]
    return _block(headers, VERSION) + http


def info_record(name: str, date: str = DATE) -> bytes:
    """The record that opens an archive."""
    body = b"format: WARC File Format 1.1\r\n"
    headers = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", record_id(0, name)),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
        ("Content-Length", str(len(body))),
    ]
    return _block(headers, VERSION) + body + END * 2


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path there."""
    if path.startswith("file:"):
        path = path.removeprefix("file:")
        path = "/" + path.lstrip("/")
    return pa.fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


def archive_writer(path: str, date: str, level: int):
    """Header and chunk rows of one partition, in order, to one archive: a gzip member a record."""

    def write(batches: Batches) -> Batches:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.warc.gz"
        fs, folder = filesystem(path)
        draft, out, records = f"{folder}/.{name}.{context.taskAttemptId()}", None, 0
        row, packer, unpacker = None, None, zstandard.ZstdDecompressor()

        def end() -> None:
            if row["got"] != (row["size"], row["digest"]):
                raise ValueError(f"the chunks of record {row['row_id']} are not its payload")
            out.write(packer.compress(END * 2) + packer.flush())

        for batch in batches:
            head = [batch.column(c).to_pylist() for c in ("row_id", "chunk", "size", "digest", "page_id", "url", "first")]
            for *fields, packed in zip(*head, batch.column("packed"), strict=True):
                row_id, chunk, size, digest, page_id, url, first = fields
                if chunk < 0:
                    if out is None:
                        fs.create_dir(folder, recursive=True)
                        out = fs.open_output_stream(draft, compression=None)
                        packer = zlib.compressobj(level, wbits=31)
                        out.write(packer.compress(info_record(name, date)) + packer.flush())
                    if row:
                        end()
                    row = dict(row_id=row_id, page_id=page_id, url=url, size=size, digest=digest, first=first)
                    row["got"] = (size, digest) if first else None
                    packer = zlib.compressobj(level, wbits=31)
                    out.write(packer.compress(record_start(row, date)))
                    records += 1
                elif row is None or row["row_id"] != row_id:
                    raise ValueError(f"chunk {chunk} of record {row_id} has no header")
                elif not row["first"]:
                    out.write(packer.compress(unpacker.decompress(packed.as_buffer())))
                    row["got"] = size, digest
        if out is None:
            return
        end()
        size = out.tell()
        out.close()
        fs.move(draft, f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": [records], "bytes": [size]})

    return write


def write_archives(
    pages: DataFrame,
    path: str,
    payload: str = "html",
    least: int = 0,
    chunk: int = CHUNK,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
    level: int = 6,
) -> DataFrame:
    """Writes a record for each row of ``pages`` (page_id, url, payload) under ``path``.

    Gives (file, records, bytes) of the archives. The payload is the column's UTF-8, null as empty;
    records are responses, or revisits of the one ``settled`` names. ``path`` is a folder that all
    executors share, as a URI or plain path; files are written under another name and then renamed,
    so a task that runs again leaves the same file. Null ids and urls leave their header out. Rows
    that repeat a page_id are records of their own. No rows give no files; other columns of
    ``pages`` are ignored.
    """
    spark = pages.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    chunks = chunk_table(pages, payload, chunk)
    total = chunks.filter("last").agg(F.sum("size")).first()[0] or 0
    records = settled(chunks, pages.schema["page_id"].dataType.simpleString(), least)
    order = ["row_id", "chunk"]
    heads = records.withColumn("chunk", F.lit(-1).cast("long"))
    both = heads.unionByName(chunks.select(*order, "packed", "size", "digest"), allowMissingColumns=True)
    dealt = both.repartition(max(1, -(-total // file_bytes)), "row_id").sortWithinPartitions(*order)
    written = dealt.mapInArrow(archive_writer(path, date, level), "file string, records long, bytes long")
    return staged(written, "warc-files")


class Source:
    """The bytes of an archive as they are wanted; gzip members follow each other unseen."""

    def __init__(self, stream, packed: bool) -> None:
        self.stream, self.packed, self.buffer = stream, packed, b""
        self.unpacker, self.left = None, b""

    def _more(self) -> bool:
        """Takes in up to 1 MB; False at the end."""
        while True:
            if not self.left:
                self.left = self.stream.read(1 << 16)
                if not self.left:
                    if self.unpacker:
                        raise ValueError("an archive ends within a record")
                    return False
            if not self.packed:
                self.buffer, self.left = self.buffer + self.left, b""
                return True
            self.unpacker = self.unpacker or zlib.decompressobj(wbits=31)
            data = self.unpacker.decompress(self.left, 1 << 20)
            if self.unpacker.eof:
                self.left, self.unpacker = self.unpacker.unused_data, None
            else:
                self.left = self.unpacker.unconsumed_tail
            if data:
                self.buffer += data
                return True

    def block(self, most: int = HEADER) -> bytes | None:
        """Lines up to an empty one, which is read as well; None at the end of the archive."""
        while (at := self.buffer.find(END * 2)) < 0:
            if len(self.buffer) > most:
                raise ValueError("no header of bounded length")
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("an archive ends within a record")
                return None
        found, self.buffer = self.buffer[:at], self.buffer[at + 4 :]
        return found

    def pieces(self, size: int, most: int) -> Iterator[bytes]:
        """The next ``size`` bytes in pieces of ``most``, the last one shorter."""
        while size:
            want = min(size, most)
            while len(self.buffer) < want:
                if not self._more():
                    raise ValueError("an archive ends within a record")
            yield self.buffer[:want]
            self.buffer = self.buffer[want:]
            size -= want


def _fields(block: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line is none."""
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def records_of(source: Source, chunk: int) -> Iterator[tuple]:
    """(record number, headers, HTTP headers, chunk, bytes, digest so far, last) of an archive."""
    number = 0
    while (block := source.block()) is not None:
        if not block.startswith(b"WARC/"):
            raise ValueError(f"not a record: {block[:40]!r}")
        headers, http = _fields(block), {}
        size = int(headers["content-length"])
        if headers.get("content-type", "").startswith("application/http"):
            block = source.block()
            http = _fields(block)
            size -= len(block) + 4
        digest, at = Digest(), 0
        end = digest.size + size
        for data in source.pieces(size, chunk):
            digest.update(data)
            yield number, headers, http, at, data, digest, digest.size == end
            at += 1
        if not size:
            yield number, headers, http, 0, b"", digest, True
        known = headers.get("warc-payload-digest")
        if known and headers.get("warc-type") != "revisit" and known != f"sha1:{base32(digest.sha1.digest())}":
            raise ValueError(f"record {headers.get('warc-record-id')} is damaged")
        if b"".join(source.pieces(4, 4)) != END * 2:
            raise ValueError("a record is longer than it says")
        number += 1


def read_archives(spark: SparkSession, path: str, payloads: bool = True, chunk: int = CHUNK) -> DataFrame:
    """The records of all archives (``.warc``, ``.warc.gz``) under ``path`` as chunk rows.

    (file, record, record_type, record_id, target_uri, headers, http, chunk, data, payload_bytes,
    payload_digest, last): ``payload_bytes`` and ``payload_digest`` (base32 SHA-1) cover the payload
    up to the chunk's end, and header names are in lower case. ``payloads=False`` gives one row a
    record, the last chunk's without its bytes. A payload is what follows the HTTP headers, or the
    whole block of other records. Archives are read as streams, one task each or several small ones;
    a record that is cut short or differs from its digest is an error.
    """

    def scan(batches: Batches) -> Batches:
        rows = Rows(_RECORDS)
        for batch in batches:
            for file in batch.column("path").to_pylist():
                fs, place = filesystem(file)
                with fs.open_input_stream(place, compression=None) as stream:
                    source = Source(stream, place.endswith(".gz"))
                    for number, headers, http, at, data, digest, last in records_of(source, chunk):
                        if not (payloads or last):
                            continue
                        row = (
                            posixpath.basename(place),
                            number,
                            headers.get("warc-type"),
                            headers.get("warc-record-id"),
                            headers.get("warc-target-uri"),
                            list(headers.items()),
                            list(http.items()),
                            at,
                            data if payloads else None,
                            digest.size,
                            base32(digest.sha1.digest()),
                            last,
                        )
                        yield from rows.add(row, len(data) if payloads else 0)
        yield from rows.rest()

    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc{,.gz}").load(path)
    return files.select("path").mapInArrow(scan, _RECORDS)


def warc_round_trip(pages: DataFrame, path: str, **options) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), read from new archives.

    ``pages`` are written under ``path`` by ``write_archives`` and all columns come from what was
    written: a revisit's size from its HTTP headers, its digest from its record header.
    """
    write_archives(pages, path, **options)
    kind = pages.schema["page_id"].dataType
    records = read_archives(pages.sparkSession, path, payloads=False).filter("record_type != 'warcinfo'")
    again = F.col("record_type") == "revisit"
    size, digest = F.col("http")["content-length"].cast("long"), F.col("headers")["warc-payload-digest"]
    return records.select(
        F.col("headers")["x-page-id"].cast(kind).alias("page_id"),
        F.when(again, size).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(again, F.substring(digest, 6, 32)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("headers")["x-refers-to-page-id"].cast(kind).alias("refers_to"),
    )
