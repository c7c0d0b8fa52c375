"""Multiset hash: homomorphism, the edited text, likeness, edge cases."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from tabml.llm import fingerprint as H
from tabml.llm.common import Powers, blank_table


def fp(*texts):
    return H.fingerprints([t.encode() for t in texts], Powers(), blank_table())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n", max_size=30), max_size=6), st.randoms())
def test_sum_of_paragraphs_in_any_order(paragraphs, rng):
    whole = fp("\n".join(paragraphs))[0]
    rng.shuffle(paragraphs)
    parts = fp(*paragraphs, "")
    assert H.to_text(parts.sum(axis=0, dtype=np.uint32)) == H.to_text(whole)      # each lane by its modulus
    assert (fp("\n".join(paragraphs))[0] == whole).all()


def test_different_texts_differ_and_count_matters():
    seen = {H.to_text(x) for x in fp("", "a", "a\na", "b", "a\nb", "a b", "A")}
    assert len(seen) == 7
    a, b = (H.to_text(x) for x in fp("one\ntwo", "two"))
    assert H.minus(a, b) == H.to_text(fp("one")[0]) and H.plus(H.minus(a, b), b) == a


def test_batching_does_not_matter():
    texts = ["x y z w\nq", "", "é" * 50, "a b c d e f " * 200, "\n\n"]
    assert (fp(*texts) == np.concatenate([fp(t) for t in texts])).all()


def test_edited_against_brute_force(spark):
    rows = [(7, "abcdefg"), (2, None), (3, "x"), (5, ""), (9, "één twee drie\nvier"), (5, "zz"), (None, "null id"), (9, "één")]
    docs = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, key int, bucket int")
    order = sorted(((-1 << 63) if a is None else a, b or "") for a, b in rows)
    want = []
    for i, (a, t) in enumerate(order):
        n, nxt = len(t), order[(i + 1) % len(order)][1]
        e = t[:n - n // 2] + nxt[:n // 2]
        x = fp(t, e, nxt)
        want.append((None if a == -1 << 63 else a, n, hashlib.sha256(e.encode()).hexdigest(), H.to_text(x[0]),
                     H.to_text(x[1]), float(H.likeness(x[:1], x[1:2])[0]), float(H.likeness(x[:1], x[2:])[0])))
    got = [tuple(r) for r in H.with_edited(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_one_row_and_no_rows(spark):
    one = H.with_edited(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0
    assert H.with_edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_updates_without_the_text(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "c"), (None, "d")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, "b", False), (1, "x\ny", True), (3, "z", True), (2, None, True), (None, "e", True)],
                                  "doc_id long, paragraph string, inserted boolean")
    got = {r.doc_id: r.fingerprint for r in H.updated(H.fingerprint(docs), edits).collect()}
    want = dict(zip((1, 2, 3, None), (H.to_text(x) for x in fp("a\nx\ny", "c", "z", "d\ne"))))
    assert got == want


def test_likeness_on_documents(spark):
    rows = H.with_edited(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")).collect()
    assert len(rows) == 200 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert sum(r.near_edited > r.near_next for r in rows) >= 190


def test_columns_that_exist_are_refused(spark):
    docs = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, fingerprint string")
    with pytest.raises(ValueError, match="fingerprint"):
        H.fingerprint(docs)
    assert H.fingerprint(docs, out="print").columns == ["doc_id", "text", "fingerprint", "print"]
