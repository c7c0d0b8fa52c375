"""Repeated substrings against brute force over all windows."""

import hashlib
import random

import duckdb
import pytest

from conftest import SF01
from tabml.llm import queries, suffix_dedup as S


def brute(rows, length):
    """rows in document order: (n_bytes, n_removed, n_spans, sha of the rest)."""
    seen, out = set(), []
    for text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def sample():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(60), text(25)
    rows = [text(rng.randrange(0, 120)) for _ in range(40)]
    rows += [text(20) + passage + text(20) for _ in range(12)] + [line * 7, passage, passage[:99], passage[1:101]]
    rows += ["a" * 3000, "ab" * 700, "a" * 100, "", None, rows[3], rows[3], "x" * 70_000 + passage]
    rows += [rows[5][:200] + "!" + rows[5][200:], rows[41][:150] + rows[42][150:]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot, length", [(50_000, 100), (3, 100), (4, 45)])
def test_as_brute_force(spark, monkeypatch, hot, length):
    monkeypatch.setattr(S, "HOT", hot)
    rows = sample()
    ids = random.Random(4).sample(range(-500, 500), len(rows))
    docs = spark.createDataFrame([(i, t, "u", 1) for i, t in zip(ids, rows)], "doc_id long, text string, uid string, copy int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicated(docs, length).collect()}
    order = sorted(zip(ids, rows))
    assert got == dict(zip([i for i, _ in order], brute([t for _, t in order], length)))


def test_repeated_and_null_ids(spark):
    long = "".join(chr(97 + i * i % 26) + str(i) for i in range(60))
    rows = [(5, long), (5, long), (None, long), (2, "zz" + long), (5, None), (2, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want = [(i, *b) for (i, _), b in zip(order, brute([t for _, t in order], 100))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicated(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table_and_text_after_removal(spark):
    assert S.deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        S.deduplicated(spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, kept int"))
    a = "é" * 60 + "tail of the first one"
    docs = spark.createDataFrame([(1, a, 81), (2, "x" + "é" * 51, 52)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in S.remove_repeats(docs).collect()}
    assert out[2].text == "x" and out[2].n_chars == 1 and out[1].text.endswith("tail of the first one")


def test_documents_as_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet' order by doc_id").fetchall()
    want = dict(zip([i for i, _ in rows], brute([t for _, t in rows], 100)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op9_bucket_pointer(spark, SF01).collect()}
    assert got == want


def test_hot_buckets_meet_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECES", 10)
    rows = spark.createDataFrame([(1, i, i % 3) for i in range(900)] + [(b, b, 0) for b in (2, 2, 3, 4)] + [(9, 9, 9)],
                                 "bucket long, uid long, place int")
    side = spark.createDataFrame([(1, 900, "x"), (2, 2, "y"), (3, 1, "z"), (4, 1, "z")], "bucket long, many long, tag string")
    limit = S._limit(side)
    marked = S._marked(rows, side, limit)
    assert limit == 90 and {r.bucket for r in marked.filter("many is not null").select("bucket").distinct().collect()} == {1}
    got = S._meet(marked, side, limit).collect()
    assert sorted((r.bucket, r.uid, r.place, r.many, r.tag) for r in got) == sorted(
        [(1, i, i % 3, 900, "x") for i in range(900)] + [(2, 2, 0, 2, "y")] * 2 + [(3, 3, 0, 1, "z"), (4, 4, 0, 1, "z")])
