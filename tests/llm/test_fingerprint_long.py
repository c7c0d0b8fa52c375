"""Likeness of texts that hold a shingle more than 32,767 times."""

from tabml.llm import fingerprint as H


def test_likeness_of_very_long_repetitive_texts(spark):
    docs = spark.createDataFrame([(1, "x " * 40_000), (2, "x " * 20_000)], "doc_id long, text string")
    near = {r.doc_id: (r.near_edited, r.near_next) for r in H.with_edited(docs).collect()}
    assert min(near[1][1], near[2][0]) > 0.99


def test_likeness_is_that_of_the_published_fingerprints(spark):
    docs = spark.createDataFrame([(1, "x " * 40_000), (2, "x " * 20_000), (3, "y z w " * 9)], "doc_id long, text string")
    rows = H.with_edited(docs).orderBy("doc_id").collect()
    lanes = [H.from_text(r.fingerprint)[None] for r in rows]
    for i, r in enumerate(rows):
        assert float(H.likeness(lanes[i], lanes[(i + 1) % 3])[0]) == r.near_next
        assert float(H.likeness(lanes[i], H.from_text(r.edited_fingerprint)[None])[0]) == r.near_edited
