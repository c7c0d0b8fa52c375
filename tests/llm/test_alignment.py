"""Cross-tokenizer alignment against a plain loop over the tokenizers' own libraries."""

import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF001
from tabml.llm import alignment, queries

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["a simple text", None, "", " ", "a  b ", "a▁b", "<|endoftext|> is <s> text", "\x00\x1f  ａ ﬁ", "שלום 日本語 😀👍🏽\r\n\t",
         "a" * 3000, "x y " * 40_000, " " * 300, "x" + "\n " * 60_000 + "y", "naïve café déjà-vu", "a simple text", "it's 12345 we'll", "é क़"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment._byte_letters()
    bytes_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    bytes_b = {i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.vocab_size())}

    def encode(text):
        if not text:
            return [], []
        out = []
        for ids, table in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a), (b.encode(text), bytes_b)):
            at, spans = 0, []
            for i in ids:
                spans.append((i, at, at + len(table[i])))
                at += len(table[i])
            if b"".join(table[i] for i in ids) != (" " + text).encode():
                return [], []
            out.append(spans)
        return out

    return encode


def brute(texts, encode):
    """Rows as the contract has them, and the pair counts, by plain loops."""
    count, rows = Counter(), []
    for text in texts:
        a, b = encode(text)
        links, j = [], 0
        for i, lo, hi in a:
            while j < len(b) and b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        count.update(links)
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups, i, j = [], 0, 0
        for end in ends:
            x, y = [], []
            while i < len(a) and a[i][2] <= end:
                x.append(a[i][0])
                i += 1
            while j < len(b) and b[j][2] <= end:
                y.append(b[j][0])
                j += 1
            groups.append((x, y))
        rows.append((len(a), len(b), groups, links))
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for n_a, n_b, groups, links in rows:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, count, top


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_cases(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK", 2000)               # several chunks
    docs = spark.createDataFrame([(i if i else None, t, i, "x") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, chunk int, `k0 links` string").repartition(3)
    out = alignment.align(docs, A, B)
    assert out.columns == ["doc_id", "chunk", "k0 links", *NAMES]
    want, count, top = brute(TEXTS, libraries)
    got = {r["chunk"]: r for r in out.collect()}
    assert len(got) == len(TEXTS)
    for i, w in enumerate(want):
        assert tuple(got[i][c] for c in NAMES) == w, TEXTS[i][:20]
    assert got[5].n_a == 0 and got[5].groups_sha256 == ""       # the model writes U+2581 as a space
    table = {(r.a, r.b): (r.links, r.best) for r in alignment.pair_counts(docs, A, B).collect()}
    assert table == {p: (n, n == top[p[1]]) for p, n in count.items()}


def test_whole_table(spark, libraries):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    want, _, _ = brute([r.text for r in rows], libraries)
    got = {r.doc_id: r for r in queries.op11_merge_asof_alignment(spark, SF001).collect()}
    assert len(got) == len(rows)
    for r, w in zip(rows, want):
        assert tuple(got[r.doc_id][c] for c in NAMES) == w


def test_groups_spell_the_text(spark, libraries):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:9])], "doc_id long, text string").coalesce(1)
    got = {}
    for r in alignment.groups(docs, A, B).orderBy("doc_id", "group").collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.a_ids, r.b_ids))
    for i, t in enumerate(TEXTS[:9]):
        a, b = libraries(t)
        mine = got.get(i, [])
        assert [x for g in mine for x in g[2]] == [x[0] for x in a]
        assert [x for g in mine for x in g[3]] == [x[0] for x in b]
        assert [g[1] for g in mine] == sorted({x[2] for x in a} & {x[2] for x in b})
        assert [g[0] for g in mine] == [0, *[g[1] for g in mine]][:len(mine)]


def test_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).count() == 0
    none = spark.createDataFrame([(1, None), (1, ""), (None, None)], "doc_id long, text string")
    assert [tuple(r[1:]) for r in alignment.align(none, A, B).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3
    with pytest.raises(ValueError, match="n_links"):
        alignment.align(docs.withColumnRenamed("doc_id", "n_links"), A, B)
    with pytest.raises(ValueError, match="merge order"):
        alignment.byte_level_tokens(P.path("word_bpe_49k.json"))


def test_parts_do_not_change_tokens(monkeypatch):
    ids, files = alignment.byte_level_tokens(A), (alignment._read(A), alignment._read(B))
    texts = [t for t in TEXTS if t]

    def encode():
        return [[f(" " + t) for t in texts] for f, _ in alignment._encoders(ids, *files)]

    whole = encode()
    monkeypatch.setattr(alignment, "PART", 3)
    assert encode() == whole
