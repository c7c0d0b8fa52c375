"""Positional index and contamination against a plain scan."""

import re
import random

import pytest

from tabml.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def toks(t):
    return WORD.findall("".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in t or ""))


def brute(docs, bench, n):
    out = []
    for d, t in docs:
        w, hit, items = toks(t), set(), set()
        for item, b in bench:
            x = toks(b)
            for i in range(max(1, len(x) - n + 1)) if x else ():
                run = x[i:i + n]
                for p in range(len(w) - len(run) + 1):
                    if w[p:p + len(run)] == run:
                        hit.update(range(p, p + len(run)))
                        items.add(item)
        items = sorted(str(x) for x in items if x is not None)
        out.append((d, len(w), len(hit), items, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    voc = ["a", "b", "c", "É", "dé", "x1", "The"]
    docs = [(i, " ".join(rng.choice(voc) for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "... !!"), (3, "a b c a b c"), (None, "c c c c"), (63, "x " * 50_000 + "b, B-b a")]
    bench = [(i, "-".join(rng.choice(voc) for _ in range(rng.randrange(0, 8)))) for i in range(12)]
    bench += [(None, "c c c c"), (20, None), (21, " . "), (1, "b b b a"), (22, "B b  b A"), (100, "a b c a")]
    return docs, bench


@pytest.mark.parametrize("block", [200_000, 7])
def test_as_brute_force(spark, tables, monkeypatch, block):
    docs, bench = tables
    monkeypatch.setattr(D, "BLOCK", block)
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, n_words int")
    b = spark.createDataFrame([(*x, "z") for x in bench], "item_id long, text string, run string")
    got = sorted((tuple(r) for r in D.contamination(d, b, 4).collect()), key=repr)
    assert got == brute(docs, bench, 4)


def test_proximity_and_phrase_rows(spark):
    d = spark.createDataFrame([(1, "a x b y c"), (2, "c b a"), (3, "a b c"), (4, "a . . b z z z z z c")],
                              "doc_id long, text string")
    b = spark.createDataFrame([(9, "a b c")], "item_id long, text string")
    index = D.build_index(d)
    index = D.stored(index, "t")
    assert [tuple(r) for r in D.matches(index, b, 3).collect()] == [(3, 9, 0, 2)]
    near = sorted(tuple(r) for r in D.matches(index, b, 3, slop=2).collect())
    assert near == [(1, 9, 0, 4), (2, 9, 0, 2), (3, 9, 0, 2)]


def test_empty_tables_and_removal(spark, tables):
    docs, bench = tables
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(d, none).filter("contaminated").count() == 0
    assert D.contamination(spark.createDataFrame([], "doc_id long, text string"), b).count() == 0
    kept = [r.doc_id for r in D.remove_contaminated_rows(d, b, 4).collect()]
    assert sorted(kept, key=repr) == sorted((r[0] for r in brute(docs, bench, 4) if not r[4]), key=repr)
