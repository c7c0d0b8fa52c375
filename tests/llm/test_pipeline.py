"""The whole pipeline against its stages' brute-force versions."""

import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from conftest import SF001
from tabml.llm import bpe, linear, quality
from test_decontaminate import brute as contaminated
from test_jaccard_join import brute as near_duplicates


def without_repeats(rows, length=100):
    seen, out = set(), []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        out.append((i, bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")))
    return out


def test_run_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    model = quality.fit(docs, labels, linear.remainder("doc_id", 5) != 0)
    good = {r.doc_id for r in quality.score(docs, model, ["doc_id"]).filter("predicted = 1").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    first = {i for i, c, _, _ in near_duplicates(rows) if i == c}
    rows = without_repeats([r for r in rows if r[0] in first])
    bad = {r[0] for r in contaminated(rows, bench, 10) if r[4]}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    want = {i: hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in library.encode_ordinary(t))).hexdigest()
            for i, t in rows if i not in bad}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want and len(got) < len(good)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(30)
    docs = docs.unionByName(spark.createDataFrame([(None, None, None, None, None), (1000, "", "en", "s", 0)], docs.schema))
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}


def write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, write(spark, tmp_path, docs)).count() == 0


def test_null_and_repeated_ids_through_all_stages(spark, tmp_path):
    """Rows without an id, or with one that others have, are judged one by one."""
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").orderBy("item_id").first().text
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    clean = [r.text for r in corpus_pipeline.good_quality(spark, docs, SF001).orderBy("doc_id").collect()
             if r.text and len(r.text) > 300 and not contaminated([(0, r.text)], [(0, bench)], 10)[0][4]][:4]
    rows = [(None, clean[0]), (None, clean[1]), (None, f"{clean[2]} {bench}"), (7, clean[3]), (7, f"{clean[0][:200]} {bench}"),
            (None, clean[1])]
    extra = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    base = docs.filter("doc_id > 1000000").unionByName(extra)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[1:4]):
        base = corpus_pipeline.stored(stage(spark, base, write(spark, tmp_path / f"s{k}", extra)), f"null-{k}")
    texts = sorted(r.text for r in base.collect())          # every byte of the second 7 starts earlier
    assert len(texts) == 4 and texts[0] == "" and all(any(t.startswith(c[:60]) for t in texts) for c in (clean[0], clean[1], clean[3]))
    out = corpus_pipeline.run(spark, write(spark, tmp_path / "all", extra)).collect()
    assert {r.doc_id for r in out} <= {None, 7}
