import base64
import glob
import gzip
import hashlib
import zlib

import pytest

from parley.llm import warc
from parley.llm.warc import read_archives, warc_round_trip, write_archives

SCHEMA = "page_id long, url string, html string, size string, digest string, chunk string, packed string, first string, row_id string"


def expected(rows, least=0):
    groups = {}
    for k, (page, _, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((page is None, page or 0, k, page))
    out = []
    for html, members in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        members.sort()
        for place, (*_, page) in enumerate(members):
            again = place > 0 and len(data) >= least
            out.append((page, len(data), digest, "revisit" if again else "response", members[0][3] if again else None))
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(map(tuple, df.collect()), key=str)


LONG = "<p>Ünïcödé 😀</p>\r\n\r\n" * 3000
ROWS = [
    (5, "http://a/1", "<html>one</html>"),
    (3, "http://a/2", "<html>one</html>"),
    (3, "http://a/2", "<html>one</html>"),
    (9, "http://a/3", None),
    (8, None, ""),
    (None, "http://a/4", "<html>one</html>"),
    (None, None, "alone"),
    (None, None, "nobody's"),
    (None, None, "nobody's"),
    (2**60 + 1, "http://a/\r\nX-Page-Id: 1", LONG),
    (2**60 + 3, "http://a/ü", LONG),
    (1, "http://a/5", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"),
    (12, "http://a/6", "\r\n\r\n"),
    *((100 + i, f"http://b/{i}", f"page {i % 7} " * 40) for i in range(200)),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, *"abcdef") for r in ROWS], SCHEMA).repartition(4)


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 18])
def test_round_trip(pages, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(warc, "BATCH", 5000)
    got = warc_round_trip(pages, str(tmp_path), chunk=chunk, file_bytes=40_000)
    assert len(glob.glob(f"{tmp_path}/*.warc.gz")) > 2
    # equal rows are settled by row order, which the SQL of a table can't see; as a multiset they agree
    assert found(got) == expected(ROWS)


def test_small_payloads_are_all_responses(pages, tmp_path):
    assert found(warc_round_trip(pages, str(tmp_path), least=17)) == expected(ROWS, 17)


def test_payloads_come_back_in_chunks(spark, pages, tmp_path):
    write_archives(pages, str(tmp_path), chunk=1000)
    rows = read_archives(spark, str(tmp_path), chunk=500).filter("record_type = 'response'").collect()
    assert max(len(r.data) for r in rows) == 500
    texts, parts = [], {}
    for r in sorted(rows, key=lambda r: (r.file, r.record, r.chunk)):
        parts.setdefault((r.file, r.record), []).append(r)
    for chunks in parts.values():
        whole = b""
        for k, r in enumerate(chunks):
            whole += r.data
            assert (r.chunk, r.payload_bytes, r.last) == (k, len(whole), k == len(chunks) - 1)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(whole).digest()).decode()
        texts.append(whole.decode())
    assert sorted(texts) == sorted({html or "" for _, _, html in ROWS})


def test_archives_are_well_formed(pages, tmp_path):
    """A plain reader of whole records agrees: lengths, types, references, one gzip member each."""
    write_archives(pages, str(tmp_path))
    ids, refers = {}, []
    for file in glob.glob(f"{tmp_path}/*.warc.gz"):
        data, members = open(file, "rb").read(), []
        assert gzip.decompress(data)
        while data:
            unpacker = zlib.decompressobj(wbits=31)
            members.append(unpacker.decompress(data))
            data = unpacker.unused_data
        for k, record in enumerate(members):
            head, _, rest = record.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            assert len(fields) == len(lines) - 1
            assert rest[int(fields["Content-Length"]) :] == b"\r\n\r\n"
            assert (fields["WARC-Type"] == "warcinfo") == (k == 0)
            assert fields["WARC-Record-ID"] not in ids
            ids[fields["WARC-Record-ID"]] = fields["WARC-Type"]
            if fields["WARC-Type"] == "revisit":
                refers.append(fields["WARC-Refers-To"])
                assert rest.endswith(b"\r\n\r\n\r\n\r\n")
    assert refers and all(ids[r] == "response" for r in refers)


def test_other_archives(spark, tmp_path):
    """Uncompressed, several records, blocks without HTTP headers, header names in any case."""
    body = b"hello\r\n\r\nworld"
    record = b"WARC/1.0\r\nwarc-type: resource\r\nCONTENT-LENGTH:  %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    (tmp_path / "x.warc").write_bytes(record * 3)
    (tmp_path / "y.warc").write_bytes(b"")
    rows = read_archives(spark, str(tmp_path)).collect()
    assert [(r.record, bytes(r.data), r.record_type) for r in rows] == [(k, body, "resource") for k in range(3)]


@pytest.mark.parametrize("damage", ["cut", "flip", "length"])
def test_damaged_archives_are_errors(spark, pages, tmp_path, damage):
    write_archives(pages, f"{tmp_path}/a", level=0)
    (file,) = glob.glob(f"{tmp_path}/a/*.warc.gz")
    data = gzip.decompress(open(file, "rb").read())
    at = data.index(b"<html>one")
    if damage == "cut":
        data = data[: at + 4]
    elif damage == "flip":
        data = data[:at] + b"X" + data[at + 1 :]
    else:
        data = data.replace(b"<html>one</html>\r\n\r\n", b"<html>one</html>....", 1)
    (tmp_path / "b.warc").write_bytes(data)
    with pytest.raises(Exception, match="ends within a record|is damaged|longer than it says"):
        read_archives(spark, f"{tmp_path}/b.warc", payloads=False).collect()


def test_no_rows(spark, pages, tmp_path):
    assert warc_round_trip(pages.limit(0), str(tmp_path)).count() == 0
    text_ids = pages.selectExpr("string(page_id) page_id", "url", "html")
    got = found(warc_round_trip(text_ids, f"{tmp_path}/text"))
    assert len(got) == len(ROWS) and all(isinstance(r[0], (str, type(None))) for r in got)
