"""Cross-tokenizer alignment (operator 11).

A text is encoded by two tokenizers whose tokens tile the same bytes: A, a
byte-level BPE in the tokenizers library's JSON, on a space and the text; B, a
sentencepiece model, which adds that space itself.

1. *Overlaps.*  Per batch of texts, ``pandas.merge_asof`` keyed by document
   finds for the start of each A token the B token that covers it, and for the
   start of each B token the covering A token.  Two tokens overlap exactly if
   the later one starts inside the other, so the union of both directions is
   all overlaps; only tokens that start together are found twice.
2. *Groups.*  Byte offsets where a token of either side ends cut the text into
   the smallest pieces that both sides spell with whole tokens.
3. *Links.*  An id pair counts once per overlapping pair of occurrences in the
   corpus.  Texts are taken in chunks of ``CHUNK`` bytes, a chunk tells Spark each of its
   different pairs once; the sums are joined back to the chunks, not to texts
   or tokens, and a chunk rates its own texts.  So what is shuffled are pairs
   per chunk, and a pair that every text has is one row per chunk.

Texts that are null, empty, or that a tokenizer does not spell byte by byte
(it normalises, or maps characters to an unknown id) have no tokens: all
numbers are 0 and the groups empty.  Every row is a document of its own, so
repeated rows and ids, and null ids, are counted and returned like any other.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, text_buffers

#: Text bytes of a chunk (one text may be longer); bounds what a task holds.
CHUNK = 2 << 20
#: Characters after which a long text is cut for the tokenizers, where no token crosses.
PART = 1 << 16
#: Runs of white space from here on go through the tokenizers library, as tiktoken's pattern overflows on far longer ones.
BLANKS = 10_000
#: Size bound of a vocabulary file, which travels with the tasks.
MAX_VOCABULARY_BYTES = 64 << 20

#: Fixed value: the pre-token pattern of plain byte-level BPE.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCABULARY_BYTES} bytes")
    return data


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable
    Latin-1 characters stand for themselves, the other bytes follow U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a tokenizers JSON file.  Only plain byte-level BPE
    whose ids rise in the order of its merges is taken, since merging by id (as
    the tiktoken library does, several times faster) is then the same; special
    tokens are left out (in texts they are plain text)."""
    spec = json.loads(_read(path))
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"] for t in spec.get("added_tokens") or []}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab.get(a + b, -1) for a, b in merges]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
            or not pre.get("use_regex", True) or spec.get("normalizer") or model.get("dropout") \
            or len(vocab) - len(merges) != 256 or min(made, default=0) < 0 or sorted(made) != made:
        raise ValueError(f"{path}: not plain byte-level BPE with ids in merge order")
    letters = _byte_letters()
    return {bytes(letters[c] for c in t): i for t, i in vocab.items()}


def _parts(text: str) -> list[str]:
    """A text (with its leading space) in parts that both tokenizers may
    encode by themselves: cut before a single space between other characters."""
    if len(text) <= PART:
        return [text]
    cuts, at, cut = [0], PART, re.compile(r"(?<=\S) (?=\S)")
    while at < len(text) and (m := cut.search(text, at)):
        cuts.append(m.start())
        at = m.start() + PART
    return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)])]


class _Tokens:
    """Bytes of each id: sizes, and a list for joining."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)


def _encoders(ids_a: dict[bytes, int], json_a: bytes, model_b: bytes):
    """(encode, tokens) of A and B, inside a task."""
    import sentencepiece
    import tiktoken
    import tokenizers

    bpe = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=ids_a, special_tokens={})
    table = [b""] * (max(ids_a.values()) + 1)
    for t, i in ids_a.items():
        table[i] = t
    sp = sentencepiece.SentencePieceProcessor(model_proto=model_b)
    pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    crossing = any("▁" in p.lstrip("▁") for p in pieces)

    blanks, slow = re.compile(rf"\s{{{BLANKS}}}"), []

    def plain(part: str) -> list[int]:
        if len(part) < BLANKS or not blanks.search(part):
            return bpe.encode_ordinary(part)
        if not slow:
            slow.append(tokenizers.Tokenizer.from_buffer(json_a))
            slow[0].encode_special_tokens = True
        return slow[0].encode(part, add_special_tokens=False).ids

    def encode_a(text: str) -> list[int]:
        parts = _parts(text)
        return plain(text) if len(parts) == 1 else [i for p in parts for i in plain(p)]

    def encode_b(text: str) -> list[int]:
        parts = [text] if crossing else _parts(text)
        return [i for p in parts for i in sp.encode(p[1:])] if len(parts) > 1 else sp.encode(text[1:])

    return (encode_a, _Tokens(table)), (encode_b, _Tokens(
        [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]))


def _encoded(texts: list[str | None], a, b):
    """(row, id) of the A and the B tokens of all texts, and which rows have any."""
    (encode_a, tokens_a), (encode_b, tokens_b) = a, b
    rows, ids_a, ids_b = [], [], []
    for r, text in enumerate(texts):
        if not text:
            continue
        whole = " " + text
        raw, x, y = whole.encode(), encode_a(whole), encode_b(whole)
        if b"".join(map(tokens_a.bytes.__getitem__, x)) == raw == b"".join(map(tokens_b.bytes.__getitem__, y)):
            rows.append(r)
            ids_a.append(np.array(x, np.int32))
            ids_b.append(np.array(y, np.int32))

    def flat(lists):
        n = np.array([len(x) for x in lists], np.int64)
        return np.repeat(np.array(rows, np.int64), n), np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int64)

    return flat(ids_a), flat(ids_b)


def overlaps(doc_a, start_a, doc_b, start_b) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) index of every overlapping pair, once.  Tokens of a
    document tile the same bytes; starts rise through all documents."""
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(doc_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(doc_b))})
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at_a = pd.merge_asof(a, b, on="start", by="doc")
    at_b = pd.merge_asof(b, a, on="start", by="doc")
    found = start_a[at_b["a"].to_numpy()] != start_b          # starting together: found from A already
    return (np.r_[at_a["a"].to_numpy(), at_b["a"].to_numpy()[found]],
            np.r_[at_a["b"].to_numpy(), at_b["b"].to_numpy()[found]])


def common_ends(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets where tokens of both sides end, group of each A token, of each B token)."""
    mark = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.uint8)
    mark[end_a] = 1
    mark[end_b] += 2
    last_a, last_b = mark[end_a] == 3, mark[end_b] == 3
    return end_a[last_a], np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b


def digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the ids below ``size``, left-aligned in a byte matrix with room for one more, and their number."""
    text = np.arange(size).astype(f"S{len(str(size))}")
    return np.c_[text.view(np.uint8).reshape(size, -1), np.zeros(size, np.uint8)], np.char.str_len(text)


def groups_text(ids_a, group_a, ids_b, group_b, chars, size) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all groups (each ends in ``;``), and where each ends."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    to_a, to_b = (np.cumsum(np.bincount(g, minlength=n)) for g in (group_a, group_b))
    at_a = np.arange(len(ids_a)) + np.r_[0, to_b][group_a]
    at_b = np.arange(len(ids_b)) + to_a[group_b]
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
    ids[at_a], ids[at_b] = ids_a, ids_b
    for at, group, last in ((at_a, group_a, b"|"), (at_b, group_b, b";")):
        mark[at] = np.where(np.r_[group[1:] != group[:-1], True][:len(at)], last[0], b","[0])
    chars, size = chars[ids], size[ids]
    chars[np.arange(len(ids)), size] = mark
    ends = np.cumsum(size + 1)[mark == b";"[0]]
    return chars[np.arange(chars.shape[1]) <= size[:, None]].tobytes(), ends


def _aligned_chunk(texts, a, b, numbers):
    """Everything about a chunk of texts: numbers and digest per row, the
    chunk's pairs (A id, B id, links), and each row's own pairs as (index, links)."""
    n = len(texts)
    (doc_a, ids_a), (doc_b, ids_b) = _encoded(texts, a, b)
    size_a, size_b = a[1].size[ids_a], b[1].size[ids_b]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)       # documents laid end to end: the same bytes on both sides
    both, group_a, group_b = common_ends(end_a, end_b)
    doc_group = doc_a[np.searchsorted(end_a, both)]
    text, ends = groups_text(ids_a, group_a, ids_b, group_b, *numbers)
    i, j = overlaps(doc_a, end_a - size_a, doc_b, end_b - size_b)
    local, pairs = pd.factorize(ids_a[i] << 32 | ids_b[j])
    links = np.bincount(local, minlength=len(pairs))
    own, times = np.unique(doc_a[i] * len(pairs) + local, return_counts=True)
    doc_own = own // max(len(pairs), 1)

    def per_row(doc):
        return np.bincount(doc, minlength=n).astype(np.int64)

    n_groups = per_row(doc_group)
    cut = np.r_[0, ends][np.r_[0, np.cumsum(n_groups)]]
    digests = [hashlib.sha256(text[lo:hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist())]
    kind = "<u2" if len(pairs) < 1 << 16 and times.max(initial=0) < 1 << 16 else "<u4"
    index, times = (own % max(len(pairs), 1)).astype(kind), times.astype(kind)
    cut = np.searchsorted(doc_own, np.arange(n + 1)).tolist()
    rows = {"n_a": per_row(doc_a), "n_b": per_row(doc_b), "n_groups": n_groups, "n_links": per_row(doc_a[i]),
            "groups_sha256": digests, "own_pairs": [index[lo:hi].tobytes() for lo, hi in zip(cut[:-1], cut[1:])],
            "own_times": [times[lo:hi].tobytes() for lo, hi in zip(cut[:-1], cut[1:])], "wide": [kind == "<u4"] * n}
    return rows, (pairs >> 32, pairs & 0xFFFFFFFF, links)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _chunks(docs: DataFrame, a_path: str, b_path: str, text: str, keep: list[str]) -> DataFrame:
    """Per row: ``keep``, numbers, digest and own pairs; ``chunk``, and on the
    first row of a chunk its pairs (packed)."""
    ids_a, json_a, model_b = byte_level_tokens(a_path), _read(a_path), _read(b_path)
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                      F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        a, b = _encoders(ids_a, json_a, model_b)
        numbers = digits(max(len(a[1].size), len(b[1].size)))
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch, _, _ in slices(whole, "text", CHUNK):
                rows, pairs = _aligned_chunk(batch.column(len(keep)).to_pylist(), a, b, numbers)
                packed = [np.stack(pairs, axis=1).astype("<i8").tobytes()] + [None] * (batch.num_rows - 1)
                kinds = {"groups_sha256": pa.string(), "own_pairs": pa.binary(), "own_times": pa.binary(), "wide": pa.bool_()}
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *[pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()],
                     pa.array([chunk] * batch.num_rows, pa.int64()), pa.array(packed, pa.binary())],
                    names=[*[f"k{i}" for i in range(len(keep))], *rows, "chunk", "pairs"])
                chunk += 1

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in src.schema if f.name != "text"]
                       + [f"{c} long" for c in _NUMBERS]
                       + ["groups_sha256 string, own_pairs binary, own_times binary, wide boolean, chunk long, pairs binary"])
    return src.mapInArrow(run, schema)


def _pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, i, a, b, links): the i-th pair of a chunk."""
    def run(batches):
        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(packed.as_buffer(), "<i8").reshape(-1, 3)
                for lo in range(0, len(rows), 1 << 16):
                    part = rows[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), chunk)), pa.array(np.arange(lo, lo + len(part), dtype=np.int32)),
                         pa.array(part[:, 0].astype(np.int32)), pa.array(part[:, 1].astype(np.int32)), pa.array(part[:, 2])],
                        names=["chunk", "i", "a", "b", "links"])

    return chunks.filter("pairs is not null").select("chunk", "pairs") \
        .mapInArrow(run, "chunk long, i int, a int, b int, links long")


def _counts(pairs: DataFrame) -> DataFrame:
    """(a, b, links, best): links of each id pair, and whether no other A id
    has more links with this B id.  A B id has at most a vocabulary of pairs."""
    total = pairs.groupBy("a", "b").agg(F.sum("links").alias("links"))
    top = total.groupBy("b").agg(F.max("links").alias("top"))
    return total.join(top, "b").select("a", "b", "links", (F.col("links") == F.col("top")).alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """The corpus' token translation table: ``a``, ``b`` (ids), ``links``
    (overlapping pairs of occurrences) and ``best`` (no A id has more with b)."""
    return _counts(_pairs(_chunks(docs, a_path, b_path, text, [])))


def groups(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per group: the ``keep`` columns (default: all but the text),
    ``group`` (from 0), ``start``, ``end`` (byte offsets in space + text),
    ``a_ids`` and ``b_ids``.  Texts without tokens have no rows."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    made = ["group", "start", "end", "a_ids", "b_ids"]
    if set(made) & set(keep):
        raise ValueError(f"columns {sorted(set(made) & set(keep))} exist already")
    ids_a, json_a, model_b = byte_level_tokens(a_path), _read(a_path), _read(b_path)
    src = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                      F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches):
        a, b = _encoders(ids_a, json_a, model_b)
        for whole in batches:
            for batch, _, _ in slices(whole, "text", CHUNK):
                (doc_a, x), (doc_b, y) = _encoded(batch.column(len(keep)).to_pylist(), a, b)
                end_a, end_b = np.cumsum(a[1].size[x]), np.cumsum(b[1].size[y])
                both, _, _ = common_ends(end_a, end_b)
                doc = doc_a[np.searchsorted(end_a, both)]
                first = np.searchsorted(doc, doc)                 # first group of the same text
                base = np.r_[0, both][first]

                def lists(ids, end):
                    cut = np.searchsorted(end, both, "right").astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), cut]), pa.array(ids.astype(np.int32)))

                yield pa.RecordBatch.from_arrays(
                    [*[c.take(pa.array(doc)) for c in batch.columns[:-1]], pa.array(np.arange(len(doc)) - first),
                     pa.array(np.r_[0, both][:-1] - base), pa.array(both - base), lists(x, end_a), lists(y, end_b)],
                    names=[*[f"k{i}" for i in range(len(keep))], *made])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in src.schema if f.name != "text"]
                       + ["`group` long, `start` long, `end` long, a_ids array<int>, b_ids array<int>"])
    return src.mapInArrow(run, schema).toDF(*keep, *made)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: the ``keep`` columns (default: all but the
    text), ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    pair is the B id's most linked in the corpus, ties included), ``count_sum``
    (corpus count of the pair, summed over links) and ``groups_sha256`` (of
    ``a1,a2|b1;a3|b2,b3``; empty without tokens).  An empty table gives an
    empty one; a kept column named like a result is refused."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    made = [*_NUMBERS, "n_best", "count_sum", "groups_sha256"]
    if set(made) & set(keep):
        raise ValueError(f"columns {sorted(set(made) & set(keep))} exist already")
    chunks = stored(_chunks(docs, a_path, b_path, text, keep), "aligned")
    pairs = _pairs(chunks)
    rated = pairs.select("chunk", "i", "a", "b").join(_counts(pairs), ["a", "b"]).select("chunk", "i", "links", "best")
    texts = chunks.drop("pairs")
    names = [c for c in texts.columns if c not in ("own_pairs", "own_times", "wide", "chunk")] + ["n_best", "count_sum"]

    def rate(own: pa.Table, pair: pa.Table) -> pa.Table:
        """A chunk's texts, rated by the corpus counts of the chunk's pairs."""
        order = np.argsort(pair.column("i").to_numpy())
        links = pair.column("links").to_numpy()[order]
        best = pair.column("best").to_numpy(zero_copy_only=False)[order]
        kind = "<u4" if own.column("wide")[0].as_py() else "<u2"
        (raw, off), (raw_times, _) = (text_buffers(own.column(c)) for c in ("own_pairs", "own_times"))
        index, times = np.frombuffer(raw.tobytes(), kind), np.frombuffer(raw_times.tobytes(), kind).astype(np.int64)
        cut = off // np.dtype(kind).itemsize

        def total(x):
            return np.diff(np.r_[0, np.cumsum(x)][cut])

        return own.select([c for c in names if c in own.column_names]) \
            .append_column("n_best", pa.array(total(times * best[index]), pa.int64())) \
            .append_column("count_sum", pa.array(total(times * links[index]), pa.int64()))

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name in names]
                       + ["n_best long, count_sum long"])
    out = texts.groupBy("chunk").cogroup(rated.groupBy("chunk")).applyInArrow(rate, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *made)

