"""Language identification by hierarchical discrimination (operator 7).

Features are the shares of byte 2-grams and 3-grams of the text (A-Z
lower-cased, all that is neither an ASCII letter nor beyond ASCII taken as a
blank), hashed to 2**BITS.  One linear support vector machine per language
family, one family against the rest, picks the family.  Within it,
one-versus-one machines separate the languages pair by pair, and the language
with the most votes wins (ties: the larger sum of margins).

Families are given by ``FAMILIES``; a language outside it is a family of its
own.  Learnt from about ``per_language`` documents of each language at most.
A null text, or one without a letter, is ``und`` with score 0; so is every
text if no language could be learnt.  The number of distinct languages must be
one of languages (their pairs are models on the driver).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import mix, ship

BITS = 15
PER_LANGUAGE = 2000
SCALE = 20.0
#: Families of closely related languages (ISO 639-1 codes).
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["ar", "fa", "he"],
}
_KEY = np.uint64(0x9E3779B97F4A7C15)


def _table() -> np.ndarray:
    t = np.full(256, 0x20, np.uint64)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


def _gram_tables():
    """Hash of every 2-gram and, of a 3-gram, of its first two and last byte."""
    two = mix(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) >> np.uint64(64 - BITS)
    return _table(), two


def hashed(data: np.ndarray, off: np.ndarray, tables):
    """(feature, text) of every 2-gram and 3-gram; none crosses texts."""
    table, two = tables
    b = table[data]
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    pair = b[:-1] << np.uint64(8) | b[1:]
    ok2 = doc[1:] == doc[:-1]
    trip = mix(pair[:-1] * _KEY + b[2:]) >> np.uint64(64 - BITS) if len(pair) > 1 else b[:0]
    ok3 = doc[2:] == doc[:-2] if len(pair) > 1 else np.zeros(0, bool)
    idx = np.concatenate([two[pair[ok2].astype(np.int64)], trip[ok3]]).astype(np.int32)
    return idx, np.concatenate([doc[1:][ok2], doc[2:][ok3]])


def features():
    tables = _gram_tables()

    def extract(data, off):
        idx, doc = hashed(data, off, tables)
        keys, counts = np.unique(doc.astype(np.int64) << BITS | idx, return_counts=True)
        starts = np.searchsorted(keys >> BITS, np.arange(len(off)))
        total = np.maximum(np.bincount(doc, minlength=len(off) - 1), 1)
        return keys & ((1 << BITS) - 1), SCALE * counts / total[keys >> BITS], starts

    return extract


def family_of(lang: str, families: dict[str, list[str]]) -> str:
    return next((f for f, langs in families.items() if lang in langs), lang)


class Model:
    """Languages by family, and the weights of each machine."""

    def __init__(self, languages: list[str], families: dict[str, list[str]], weights: dict[str, np.ndarray]):
        self.languages = languages
        self.groups: dict[str, list[int]] = {}
        for i, lang in enumerate(languages):
            self.groups.setdefault(family_of(lang, families), []).append(i)
        self.weights = weights


def machines(languages: list[str], families: dict[str, list[str]]):
    """(name, languages of label 1, languages of label 0) of every machine."""
    groups = Model(languages, families, {}).groups
    everyone = set(range(len(languages)))
    out = [(f"family {f}", set(g), everyone - set(g)) for f, g in groups.items()] if len(groups) > 1 else []
    return out + [(f"pair {a} {b}", {a}, {b}) for g in groups.values() for a, b in itertools.combinations(g, 2)]


def fit(docs: DataFrame, learn: Column, lang: str = "lang", per_language: int = PER_LANGUAGE,
        families: dict[str, list[str]] = FAMILIES, c: float = 1.0, epochs: int = 20) -> Model:
    """Learn from rows for which ``learn`` holds and whose language is known."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{lang}`").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text")) \
        .filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], families, {})
    chance = F.create_map(*[F.lit(x) for k, n in counts.items()
                            for x in (k, int((1 << 30) * min(1.0, per_language / n)))])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < chance[F.col("lang")]) \
        .filter(F.col("text").rlike(r"\p{L}")).groupBy("doc_id", "lang").agg(F.min("text").alias("text")) \
        .select(F.col("doc_id").alias("key"), number[F.col("lang")].alias("label"), "text")
    todo = machines(languages, families)
    shards = max(1, sum(min(n, per_language) for n in counts.values()) // linear.SHARD_ROWS)

    def one(x, y):
        out = {}
        for name, yes, no in todo:
            at = [i for i, label in enumerate(y) if label in yes or label in no]
            labels = [int(y[i] in yes) for i in at]
            ones = max(1, sum(labels))
            zeros = max(1, len(labels) - sum(labels))
            out[name] = linear.dual_hinge([x[i] for i in at], labels, 1 << BITS, c * len(at) / (2 * ones),
                                          c * len(at) / (2 * zeros), epochs)
        return out

    fitted = linear.fit_shards(sample, shards, features, one) if todo else {}
    weights = {name: linear.dense(fitted.get(name, {}), (1 << BITS) + 1) for name, _, _ in todo}
    return Model(languages, families, weights)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1: how far the chosen family and
    language are ahead) of every whole text."""
    shipped = ship(docs.sparkSession, model)

    def scorer():
        model, tables = shipped(), _gram_tables()
        letters = np.zeros(256, bool)
        letters[0x41:0x5B] = letters[0x61:0x7B] = True

        def sums(data, off):
            """Features in pieces of bounded length: a long text is added up."""
            n = len(off) - 1
            if len(data) <= 4 << 20:
                yield (*hashed(data, off, tables), n)
                return
            for lo in range(0, len(data), 1 << 20):         # one text alone
                part = data[max(0, lo - 2):lo + (1 << 20)]
                idx, doc = hashed(part, np.array([0, len(part)]), tables)
                yield idx, doc, n

        def run(batch, data, off):
            n = len(off) - 1
            have = np.add.reduceat(np.r_[letters[data], False], off[:-1], dtype=np.int64) * (np.diff(off) > 0) > 0
            beyond = np.flatnonzero(~have & (np.maximum.reduceat(np.r_[data, np.uint8(0)], off[:-1]) >= 0x80)
                                    & (np.diff(off) > 0))
            texts = batch.column(batch.num_columns - 1)
            for i in beyond.tolist():
                have[i] = any(ch.isalpha() for ch in texts[i].as_py())
            if not model.languages:
                return pa.array(["und"] * n, pa.string()), pa.array(np.zeros(n))
            total = np.zeros(n)
            names = list(model.groups)
            margin = {name: np.zeros(n) for name in model.weights}
            pieces = list(sums(data, off)) if len(data) <= 4 << 20 else sums(data, off)
            for idx, doc, _ in pieces:
                total += np.bincount(doc, minlength=n)
                for name, w in model.weights.items():
                    margin[name] += np.bincount(doc, w[:-1][idx], n)
            total = np.maximum(total, 1)
            for name, w in model.weights.items():
                margin[name] = SCALE * margin[name] / total + w[-1]
            if len(names) > 1:
                by_family = np.stack([margin[f"family {f}"] for f in names])
                family = by_family.argmax(axis=0)
                top = np.sort(by_family, axis=0)
                sure = linear.sigmoid(2 * (top[-1] - top[-2]))
            else:
                family, sure = np.zeros(n, np.int64), np.ones(n)
            votes = np.zeros((len(model.languages), n))
            lead = np.ones(n)
            for k, f in enumerate(names):
                votes[model.groups[f]] += (family == k) * 1000.0
                for a, b in itertools.combinations(model.groups[f], 2):
                    m = margin[f"pair {a} {b}"]
                    here = family == k
                    votes[a] += here * ((m > 0) + 1e-3 * np.tanh(m))
                    votes[b] += here * ((m <= 0) - 1e-3 * np.tanh(m))
            best = votes.argmax(axis=0)
            for name in model.weights:
                if name.startswith("pair"):
                    a, b = map(int, name.split()[1:])
                    m = np.where(best == a, margin[name], -margin[name])
                    mine = (best == a) | (best == b)
                    lead = np.where(mine, np.minimum(lead, linear.sigmoid(2 * m)), lead)
            pred = [model.languages[i] if h else "und" for i, h in zip(best.tolist(), have.tolist())]
            return pa.array(pred, pa.string()), pa.array(np.where(have, np.clip(sure * lead, 0, 1), 0.0))

        return run

    return linear.score_texts(docs, scorer, "lang_pred string, score double", keep)
