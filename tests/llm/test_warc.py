"""WARC archives: exact round trip, format, revisits, edge cases."""

import hashlib
import struct

import pytest
import zstandard

from tabml.llm import warc as W

BIG = "x" * 1000


def pages(spark):
    rows = [(1, "u1", BIG), (2, "u2\r\n x", BIG), (3, None, "small"), (4, "u", "small"), (5, "u5", None), (6, "u6", "y" * 999),
            (7, "u7", "y" * 999), (2, "again", BIG), (None, "n", BIG), (None, "n", "é" * 500), (None, "m", "é" * 500),
            (9, "u9", "é\r\n\r\nWARC/1.1" * 9000), (8, "u8", "é\r\n\r\nWARC/1.1" * 9000)]
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, digest string"), rows


def expected(rows):
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        same = [q for q, _, g in rows if (g or "").encode() == raw and q is not None] if len(raw) >= 1000 else []
        head = max(same) if same and (p is None or p < max(same)) else None
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "response" if head is None else "revisit", head))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [8 << 20, 1])
def test_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", size)
    df, rows = pages(spark)
    archives = W.archive(df)
    assert result(W.read_archives(archives, payload=False)) == expected(rows)
    back = {r.page_id: r for r in W.read_archives(archives).filter("page_id in (1, 2, 5, 9)").collect()}
    assert back[9].payload.decode() == rows[11][2] and bytes(back[5].payload) == b"" and back[1].payload is None
    assert archives.agg({"records": "sum"}).first()[0] == len(rows)


def test_file_layout(spark, tmp_path):
    df, rows = pages(spark)
    files = W.export(W.archive(df.repartition(1)), tmp_path.as_uri()).collect()
    data = (tmp_path / files[0].archive).read_bytes()
    assert len(data) == files[0].bytes
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and len(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
    records = list(W.frames(data))
    assert len(records) == len(rows) and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    with pytest.raises(ValueError):
        list(W.frames(data[:-3]))


def test_trained_dictionary_and_empty(spark):
    many = spark.createDataFrame([(i, "http://x", f"<p>line {i * 7919 % 1000} of text {i}</p>" * 40) for i in range(300)],
                                 "page_id long, url string, html string")
    rec = W.classify(many)
    assert W.train(rec)[:4] == b"\x37\xa4\x30\xec"      # a trained dictionary
    assert W.read_archives(W.archive(many)).count() == 300
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.read_archives(W.archive(none)).count() == 0


def test_record_ids_of_repeated_and_null_pages(spark):
    df, rows = pages(spark)
    heads = []
    for r in W.archive(df).collect():
        heads += [dict(x.split(": ", 1) for x in raw[:raw.index(b"\r\n\r\n")].decode().split("\r\n")[1:])
                  for raw in W.frames(bytes(r.data))]
    by_id = {h["WARC-Record-ID"]: h for h in heads}
    assert len(by_id) == len(heads) == len(rows)
    for h in heads:
        if h["WARC-Type"] == "revisit":
            to = by_id[h["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["X-Page-ID"] == h["X-Refers-To-Page"]
            assert to["WARC-Target-URI"] == h["WARC-Refers-To-Target-URI"]
            assert to["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]
    twice = spark.createDataFrame([(1, None, BIG), (1, None, BIG), (None, None, BIG)], "page_id long, url string, html string")
    out = W.read_archives(W.archive(twice), payload=False).collect()
    assert sorted(r.record_type for r in out) == ["response", "response", "revisit"]
