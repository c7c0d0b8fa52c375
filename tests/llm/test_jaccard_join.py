"""Chosen-path join against all pairs."""

import itertools
import random
import re

import duckdb
import pytest

from conftest import SF01
from tabml.llm import jaccard_join as J, queries
from tabml.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, k=5):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k=5):
    """rows: (id, text) in document order."""
    sets = [shingles(t, k) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sets.index)
    by_token, links = {}, {s: set() for s in distinct}
    for s in distinct:
        for t in s:
            by_token.setdefault(t, []).append(s)
    tried = {frozenset(p) for group in by_token.values() for p in itertools.combinations(group, 2)}
    for a, b in map(tuple, tried):
        if 10 * len(a & b) >= 8 * len(a | b):
            links[a].add(b)
            links[b].add(a)
    root = {}
    for s in distinct:
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = s
                todo += links[x]
    first = {}
    for (i, _), s in zip(rows, sets):
        if s:
            first.setdefault(root[s], i)
    return sorted(((i, first[root[s]], len(links[s]), sets.count(s) - 1) if s else (i, i, 0, 0)
                   for (i, _), s in zip(rows, sets)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample():
    rng = random.Random(9)
    voc = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(voc) for _ in range(n)]
    common, rows = text(40), []
    for _ in range(12):
        base = text(rng.randrange(30, 120))
        for _ in range(rng.randrange(1, 9)):
            edit = list(base)
            for _ in range(rng.randrange(0, 4)):
                edit[rng.randrange(len(edit))] = rng.choice(voc)
            rows.append(" ".join(edit))
    rows += [" ".join(text(30) + common) for _ in range(25)]
    base = text(150)
    for i in range(60):
        edit = list(base)
        edit[i * 2] = f"x{i}"
        rows.append(" ".join(edit))
    rows += [rows[3].upper() + "!", rows[3], "one two", "Two  one", "one, two", "", None, "...", "one"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("limit, block", [(1024, 512), (5, 7)])
def test_as_all_pairs(spark, monkeypatch, limit, block):
    monkeypatch.setattr(J, "LIMIT", limit)
    monkeypatch.setattr(J, "BLOCK", block)
    rows = sample()
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, uid int, class string")
    out = J.join(docs)
    assert out.columns == ["doc_id", "class_id", "n_links", "n_copies"]
    assert result(out) == brute(rows)
    kept = {r.doc_id for r in J.keep_one(docs).collect()}
    assert kept == {i for i, c, _, _ in brute(rows) if i == c}


def test_repeated_null_ids_and_no_rows(spark):
    t = "a b c d e f g h i j k l"
    rows = [(None, t), (3, t), (3, t), (4, t + " m"), (5, None), (4, None)]
    out = J.join(spark.createDataFrame(rows, "doc_id long, text string"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert result(out) == brute(order)
    assert J.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains(spark):
    rng = random.Random(1)
    nodes = list(range(200))
    rng.shuffle(nodes)
    links = [(nodes[i], nodes[i + 1]) for i in range(199) if i % 50 != 49] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for c in range(0, 200, 50):
        part = nodes[c:c + 50]
        assert all(got.get(n, n) == min(part) for n in part)


def test_runs_reach_the_target():
    assert J.runs_for(0.999, 3) == 15 and J.runs_for(0.9, 1) == 3


def test_documents_as_all_pairs(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet' order by doc_id").fetchall()
    assert result(queries.op4_chosen_path_join(spark, SF01)) == brute(rows)
