"""Byte-level BPE encoding and decoding (operator 3).

A rank file of a byte-level BPE vocabulary is serialised directly as a
sentencepiece model: each token becomes a piece of one printable character
per byte, its score is its negative rank, and the normaliser is the identity.
The sentencepiece library then merges the same pairs in the same order as the
ranks ask for.  Text is cut into pre-tokens first and every pre-token is
encoded by itself; decoding is the inverse mapping from ids to bytes.

The work is a narrow map over Arrow batches: no shuffle.  The vocabulary is
read once on the driver and broadcast (about 1 MB; refused above
``MAX_VOCABULARY_BYTES``).
"""

from __future__ import annotations

import base64
import hashlib
import struct
import sys
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Size bound of the broadcast vocabulary file.
MAX_VOCABULARY_BYTES = 64 << 20
#: Pre-tokens whose ids one Python worker remembers (about 200 bytes each);
#: beyond it the memory starts anew.
CACHE_ENTRIES = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x.strip())}


#: A character that no byte maps to.
SEPARATOR = "\u0300"


def byte_alphabet() -> list[str]:
    """A distinct character per byte value, none of them white space: byte b
    is the character U+0100 + b."""
    return [chr(0x100 + b) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value) -> bytes:
    """One protobuf field: int (varint), float (32 bits) or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece BPE model of a rank vocabulary.  Piece i is
    the token of rank i; unused ranks and the unknown piece get a private
    character that no byte maps to."""
    alphabet = byte_alphabet()
    size = max(ranks.values()) + 1
    tokens = [None] * size
    for token, rank in ranks.items():
        tokens[rank] = "".join(alphabet[b] for b in token)
    out = bytearray()
    for rank, piece in enumerate(tokens):
        name, kind = (piece, 1) if piece is not None else (f"{rank}", 5)
        out += _field(1, _field(1, name.encode()) + _field(2, float(-rank)) + _field(3, kind))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, size + 1) + _field(40, size) + _field(41, 0xFFFFFFFFFFFFFFFF) \
        + _field(42, 0xFFFFFFFFFFFFFFFF) + _field(43, 0xFFFFFFFFFFFFFFFF)
    normalizer = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


#: The pattern's character classes for text below U+0240, where Python's own
#: (faster) ``re`` can express them; text beyond it takes the ``regex`` library.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u023f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t-\r \x85\xa0"
#: UTF-8 lead bytes from here on begin characters of U+0240 and above.
_BEYOND = 0xC9


def latin_pattern(pattern: str) -> str | None:
    """The same pattern for text below U+0240, or None if it uses other classes."""
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_BLANK}{_LETTER}{_NUMBER}]")
    for cls, chars in ((r"\p{L}", f"[{_LETTER}]"), (r"\p{N}", f"[{_NUMBER}]"),
                       (r"\S", f"[^{_BLANK}]"), (r"\s", f"[{_BLANK}]")):
        out = out.replace(cls, chars)
    return None if "\\" in out else out


class Codec:
    """Encoder and decoder of one vocabulary, built once per task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import regex
        import sentencepiece

        self.pattern = regex.compile(pattern)
        latin = latin_pattern(pattern)
        self.latin = re.compile(latin) if latin else self.pattern
        self.to_piece = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        self.to_pieces = self.to_piece | {10: SEPARATOR}
        self.ranks = ranks
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_size = np.array([len(t) for t in tokens], np.int32)
        self.token_start = np.cumsum(self.token_size, dtype=np.int32) - self.token_size
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        # Python workers run many tasks: what one has learnt serves the next.
        # Only for the same vocabulary: the key is a digest of every token, rank and the pattern.  A worker
        # remembers one vocabulary at a time, so its memory stays bounded over many jobs.
        key = hashlib.sha256(repr((pattern, sorted(ranks.items(), key=lambda x: x[1]))).encode()).digest()
        held = vars(sys).setdefault("_byte_bpe_ids", {})
        if key not in held:
            held.clear()
        self.cache: dict[str, bytes] = held.setdefault(key, {})

    def learn(self, rest: set[str]) -> None:
        """Encode pre-tokens that the cache lacks: a token of the vocabulary
        is itself.  The rest go through the model, many to a call: a character
        outside the vocabulary stands between them, which no merge can cross."""
        model = []
        for pre in rest:
            rank = self.ranks.get(pre.encode())
            if rank is None:
                model.append(pre)
            else:
                self.cache[pre] = struct.pack("<I", rank)
        plain = [pre for pre in model if "\n" not in pre]
        blocks = [plain[i:i + 256] for i in range(0, len(plain), 256)] + [[pre] for pre in model if "\n" in pre]
        texts = ["\n".join(x).encode().decode("latin-1").translate(self.to_pieces if len(x) > 1 else self.to_piece)
                 for x in blocks]
        for block, ids in zip(blocks, self.model.encode(texts, num_threads=1)):
            ids = np.array(ids, "<u4")
            cut = (np.flatnonzero(ids == len(self.token_size)) * 4).tolist()
            raw = ids.tobytes()
            for pre, lo, hi in zip(block, [-4, *cut], [*cut, len(raw)]):
                self.cache[pre] = raw[lo + 4:hi]

    def pack(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens, packed."""
        rest: set[str] = set()
        for x in lists:
            rest.update(filterfalse(self.cache.__contains__, x))
        if rest:
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
                rest = set().union(*lists)
            self.learn(rest)
        return [b"".join(map(self.cache.__getitem__, x)) for x in lists]

    def split(self, text: str, latin: bool = False):
        """Pre-tokens of a text in lists of bounded length."""
        p = self.latin if latin else self.pattern
        if len(text) < 1 << 20:
            yield p.findall(text)
            return
        block = []
        for m in p.finditer(text):
            block.append(m[0])
            if len(block) == 1 << 16:
                yield block
                block = []
        yield block

    def encode(self, text: str, latin: bool = False) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return b"".join(self.pack([block])[0] for block in self.split(text, latin))

    def encode_all(self, texts: list[str], latin: list[bool]) -> list[bytes]:
        """``encode`` of each text, looking up the new pre-tokens of all short
        ones at once."""
        short = [len(t) < 1 << 20 for t in texts]
        lists = [(self.latin if la else self.pattern).findall(t) if s else []
                 for t, la, s in zip(texts, latin, short)]
        return [x if s else self.encode(t, la)
                for t, la, s, x in zip(texts, latin, short, self.pack(lists))]

    def decode(self, ids: bytes) -> bytes:
        """Bytes of packed ids: gather each token's bytes from one buffer."""
        ids = np.frombuffer(ids, "<u4")
        out = []
        for i in range(0, len(ids), 1 << 18):
            part = ids[i:i + (1 << 18)]
            size = self.token_size[part]
            end = np.cumsum(size, dtype=np.int32)
            out.append(self.token_bytes[np.arange(end[-1], dtype=np.int32)
                                        + np.repeat(self.token_start[part] - end + size, size)].tobytes())
        return b"".join(out)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text",
           keep: list[str] | None = None, ids: bool = True, check: bool = True) -> DataFrame:
    """Tokenise the whole ``text`` of every row (null: empty, no tokens).

    Returns the ``keep`` columns (default: all but the text) and ``n_tokens``,
    ``token_ids`` (packed little-endian uint32, if ``ids``), ``ids_sha256`` and,
    if ``check``, ``decoded_sha256`` of the bytes that the ids decode to.
    Repeated rows and ids are independent rows; an empty table gives an empty
    one.  Only ``keep`` and ``text`` travel to Python, and other columns may
    have any names; a kept column named like a result column is not allowed.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    made = {"n_tokens": "long"} | ({"token_ids": "binary"} if ids else {}) | {"ids_sha256": "string"} \
        | ({"decoded_sha256": "string"} if check else {})
    if set(made) & set(keep):
        raise ValueError(f"columns {sorted(set(made) & set(keep))} exist already")
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "__text"]
                       + [f"{c} {t}" for c, t in made.items()])
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        codec = Codec(ranks.value, pattern)
        kinds = {"n_tokens": pa.int64(), "token_ids": pa.binary()}
        for whole in batches:
            for batch, data, off in slices(whole, "__text"):
                at = batch.schema.get_field_index("__text")
                lead = np.maximum.reduceat(np.r_[data, np.uint8(0)], off[:-1])
                packed = codec.encode_all(batch.column(at).to_pylist(),
                                          ((lead < _BEYOND) | (np.diff(off) == 0)).tolist())
                cols = {"n_tokens": [len(x) // 4 for x in packed]}
                if ids:
                    cols["token_ids"] = packed
                cols["ids_sha256"] = [hashlib.sha256(x).hexdigest() for x in packed]
                if check:
                    cols["decoded_sha256"] = [hashlib.sha256(codec.decode(x)).hexdigest() for x in packed]
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(batch.columns) if i != at]
                    + [pa.array(v, kinds.get(c, pa.string())) for c, v in cols.items()],
                    names=[f.name for i, f in enumerate(batch.schema) if i != at] + list(made))

    return src.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, ids: str = "token_ids") -> DataFrame:
    """Replace packed ids by the bytes they stand for, in a column ``decoded``
    (null ids: null).  A column of that name is refused."""
    if "decoded" in tokens.columns and ids != "decoded":
        raise ValueError("column decoded exists already")
    ranks = tokens.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        table = {r: t for t, r in ranks.value.items()}
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            out = [None if v is None else b"".join(map(table.__getitem__, np.frombuffer(v, "<u4").tolist()))
                   for v in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at] + [pa.array(out, pa.binary())],
                names=[f.name for i, f in enumerate(batch.schema) if i != at] + ["decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != ids]
                       + ["decoded binary"])
    return tokens.mapInArrow(run, schema)
