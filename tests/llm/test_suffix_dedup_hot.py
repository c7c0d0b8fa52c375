"""Hot buckets are refined without a row for each of their windows."""

import random

import pytest

from llm.test_suffix_dedup import brute
from tabml.llm import suffix_dedup as S


def corpus(rng):
    """One line in every document, beside other text, in near copies, with a
    beginning in common, and a passage of many windows."""
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, before, passage = text(80), text(60), text(400)
    rows = [text(120) + line + text(120) for _ in range(60)]
    rows += [text(90) + before + line + text(rng.randrange(0, 90)) for _ in range(40)]
    rows += [text(50) + passage + line + text(50) for _ in range(30)]
    rows += [rows[3][:i] + "!" + rows[3][i:] for i in range(20, 300, 20)]
    return rows


@pytest.mark.parametrize("hot", [6, 25])
def test_rows_follow_the_anchors(spark, monkeypatch, hot):
    rows = corpus(random.Random(8))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    made, kept = {}, S.stored

    def counted(df, name):
        out = kept(df, name)
        made.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "stored", counted)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicated(docs).collect()}
    assert got == dict(enumerate(brute(rows, 100)))
    places = made["places"][0].selectExpr("sum(size(place)) as n").first().n
    assert made["contexts"][0].count() == places            # an anchor, not each of its windows
    halves = [t.count() for t in made["halves"]]
    assert halves and max(halves) <= 2 * places
