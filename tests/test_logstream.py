import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tabml.streaming import logstream as ls


def test_parse_good_and_bad_lines(spark):
    lines = spark.createDataFrame([
        ("WARN,Tue Dec 01 13:03:22 UTC 2026",),
        ("DEBUG,Wed Dec 02 00:00:01 UTC 2026",),
        ("garbage",),
        ("NOPE1,Tue Dec 01 13:03:22 UTC 2026",),
        ("INFO,Tue Dec 99 13:03:22 UTC 2026",),
        (None,)], "line string")
    good, bad = ls.parse_lines(lines, levels=ls.LEVELS)
    g = sorted((r.level, r.ts) for r in good.collect())
    assert g == [("DEBUG", dt.datetime(2026, 12, 2, 0, 0, 1)), ("WARN", dt.datetime(2026, 12, 1, 13, 3, 22))]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad date", "bad level", "no separator", "no separator"]


def test_render_parse_roundtrip(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = ls.render_lines(ev, "event_type", "ts", keep=("event_id",))
    good, bad = ls.parse_lines(lines)
    assert bad.count() == 0 and good.count() == ev.count()


def test_stream_equals_batch_and_append_withholds_open_windows(spark):
    src = "/root/testdata/sf0.01"
    schema = spark.read.parquet(f"{src}/events.parquet").schema
    batch = ls.level_counts(spark.read.parquet(f"{src}/events.parquet"), "ts", "event_type")
    want = sorted((r.window_start, r.level, r.n) for r in batch.collect())
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(src))
    ck = tempfile.mkdtemp(prefix="tabml-stream-")
    q = ls.start_level_counts(spark, stream, os.path.join(ck, "c"), sink="memory", name="lc_complete",
                              level="event_type", mode="complete")
    q.awaitTermination(120)
    got = sorted((r.window_start, r.level, r.n) for r in spark.table("lc_complete").collect())
    assert got == want
    q2 = ls.start_level_counts(spark, stream, os.path.join(ck, "a"), sink="memory", name="lc_append",
                               level="event_type", mode="append")
    q2.awaitTermination(120)
    app = spark.table("lc_append").collect()
    assert 0 < len(app) < len(want)
    last = max(w for w, _, _ in want)
    assert all(r.window_start < last for r in app)   # the last day is still open


def test_level_share_sums_to_one(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    s = ls.level_share(ev, "event_type").agg(F.sum("share"), F.sum("n")).head()
    assert abs(s[0] - 1.0) < 1e-12 and s[1] == ev.count()
    c = ls.level_counts(ev, "ts", "event_type")
    s2 = {r.level: r.n for r in ls.level_share(c, "level", weight="n").collect()}
    s1 = {r.level: r.n for r in ls.level_share(ev, "event_type").collect()}
    assert s1 == s2


def test_stream_parquet_sink_foreach_batch(spark):
    src = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{src}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(src)
    base = tempfile.mkdtemp(prefix="tabml-sink-")
    out = os.path.join(base, "out")
    q = ls.start_level_counts(spark, stream, os.path.join(base, "ck"), sink="parquet", path=out,
                              level="event_type", mode="update")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert set(got.columns) >= {"window_start", "level", "n", "epoch"}
    batch = ls.level_counts(spark.read.parquet(f"{src}/events.parquet"), "ts", "event_type")
    assert got.agg(F.sum("n")).head()[0] == batch.agg(F.sum("n")).head()[0]


def test_late_line_is_dropped_after_watermark(spark):
    """Append mode: once the watermark has passed a window, a line for that
    window arriving later does not change its count."""
    base = tempfile.mkdtemp(prefix="tabml-late-")
    src, out, ck = (os.path.join(base, x) for x in ("src", "out", "ck"))
    rows1 = [("INFO", dt.datetime(2026, 1, 1, 10)), ("INFO", dt.datetime(2026, 1, 1, 11)),
             ("WARN", dt.datetime(2026, 1, 5, 12))]
    spark.createDataFrame(rows1, "level string, ts timestamp").write.parquet(os.path.join(src, "a"))
    schema = "level string, ts timestamp"

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(src)
        q = ls.start_level_counts(spark, stream, ck, sink="parquet", path=out, mode="append",
                                  window="1 day", watermark="1 hour")
        q.awaitTermination(120)

    run()
    late = [("INFO", dt.datetime(2026, 1, 1, 12))]       # day 1 closed long ago
    spark.createDataFrame(late, schema).write.parquet(os.path.join(src, "b"))
    run()
    got = {(r.window_start.date().isoformat(), r.level): r.n
           for r in spark.read.parquet(out).collect()}
    assert got[("2026-01-01", "INFO")] == 2


def test_class_rates_empty_class(spark):
    from tabml.operators import metrics as me
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    r = {x["class"]: x for x in me.class_rates(df).collect()}
    assert r[1.0]["tp"] == 0 and r[1.0]["precision"] is None and r[1.0]["tpr"] == 0.0
    assert r[0.0]["precision"] == 1 / 3 and r[0.0]["accuracy"] == 1 / 3


def test_class_rates_null_class_is_one_row(spark):
    from tabml.operators import metrics as me
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0), (0.0, 0.0)],
                               "label double, prediction double")
    rows = me.class_rates(df).collect()
    assert len(rows) == 3
    r = {x["class"]: x for x in rows}
    assert r[None]["tp"] == 0 and r[None]["fn"] == 1 and r[None]["fp"] == 1
    assert r[1.0]["tp"] == 1 and r[0.0]["tp"] == 1
