"""Log lines (L1-L3): parse ``LEVEL,<java.util.Date>`` text lines, count
levels per event-time window with a watermark, and level shares.

The same functions serve batch DataFrames and Structured Streaming
DataFrames (``withWatermark`` is a no-op on a batch plan), so a stream and a
backfill share one definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType

# The log levels of the line producer, most to least severe.
LEVELS = ("FATAL", "ERROR", "WARN", "INFO", "DEBUG")

# Day names of that layout.
DAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# java.util.Date.toString() layout, e.g. "Tue Dec 01 13:03:22 UTC 2026".
JAVA_DATE = "EEE MMM dd HH:mm:ss zzz yyyy"
# Spark 4 parses no day-of-week names; the 4 leading characters ("Tue ")
# are dropped and the rest parsed with this pattern.
JAVA_DATE_NO_DAY = "MMM dd HH:mm:ss zzz yyyy"


def _as_timestamp(c: str, df: DataFrame):
    if isinstance(df.schema[c].dataType, TimestampNTZType):
        return F.col(c).cast("timestamp")
    return F.col(c)


def render_lines(df: DataFrame, level: str = "level", ts: str = "ts",
                 out: str = "line", keep: tuple = ()) -> DataFrame:
    """Format rows as the producer's text lines ``LEVEL,<date>``."""
    line = F.concat_ws(",", F.upper(F.col(level)),
                       F.date_format(_as_timestamp(ts, df), JAVA_DATE))
    return df.select(*keep, line.alias(out))


def _parsed(df: DataFrame, line: str, levels) -> DataFrame:
    txt = F.col(line)
    lvl = F.trim(F.substring_index(txt, ",", 1))
    rest = F.expr(f"substring({line}, instr({line}, ',') + 1)")
    ts = F.when(F.trim(rest).rlike(f"^({'|'.join(DAYS)}) "),
                F.try_to_timestamp(F.substring(F.trim(rest), 5, 64), F.lit(JAVA_DATE_NO_DAY)))
    ok_level = lvl.isin(list(levels)) if levels else lvl.rlike("^[A-Za-z]+$")
    reason = (F.when(txt.isNull() | ~F.instr(txt, ",").cast("boolean"), F.lit("no separator"))
              .when(~ok_level, F.lit("bad level"))
              .when(ts.isNull(), F.lit("bad date")))
    return df.select("*", lvl.alias("level"), ts.alias("ts"), reason.alias("reason"))


def parse_lines(df: DataFrame, line: str = "line", levels=None) -> tuple[DataFrame, DataFrame]:
    """L1: ``(good, bad)``.  ``good`` adds ``level`` and ``ts``; ``bad`` keeps
    the unparsable rows with a ``reason``.  Both are filters over one
    projection, so a ``foreachBatch`` sink can write both from one read."""
    p = _parsed(df, line, levels)
    good = p.filter(F.col("reason").isNull()).drop("reason")
    bad = p.filter(F.col("reason").isNotNull()).drop("level", "ts")
    return good, bad


def level_counts(df: DataFrame, ts: str = "ts", level: str = "level",
                 window: str = "1 day", watermark: str | None = "1 hour") -> DataFrame:
    """L2: rows per (tumbling event-time window, level), with a watermark so
    a stream's state for closed windows is dropped (not in ``complete``
    mode).  Output
    ``(window_start, window_end, level, n)``; the bounds are wall-clock
    (``timestamp_ntz``) values in the session's (UTC) clock."""
    t = df.withColumn("_ts", _as_timestamp(ts, df))
    if watermark:
        t = t.withWatermark("_ts", watermark)
    g = t.groupBy(F.window("_ts", window).alias("w"), F.col(level).alias("level"))
    return g.agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "level", "n")


def level_share(df: DataFrame, level: str = "level", weight: str | None = None) -> DataFrame:
    """L3: each level's count and share of all rows ``(level, n, share)``.
    ``weight`` lets it run on the output of :func:`level_counts` (weight
    ``n``) instead of raw rows."""
    w = F.col(weight) if weight else F.lit(1)
    per = df.groupBy(F.col(level).alias("level")).agg(F.sum(w).cast("bigint").alias("n"))
    total = per.agg(F.sum("n"))
    return per.withColumn("share", F.col("n") / total.scalar())


def start_level_counts(spark: SparkSession, stream: DataFrame, checkpoint: str,
                       sink: str = "parquet", name: str = "level_counts",
                       mode: str = "append", ts: str = "ts", level: str = "level",
                       window: str = "1 day", watermark: str = "1 hour",
                       available_now: bool = True, path: str | None = None) -> StreamingQuery:
    """Run :func:`level_counts` as a Structured Streaming query.  ``append``
    (the default) emits a window once the watermark passes its end and then
    frees its state; ``complete`` / ``update`` emit running counts, and
    ``complete`` keeps all state.  ``sink="memory"`` (Spark's debugging
    sink, collected on the driver) is for tests only.  The parquet sink writes each
    micro-batch with ``foreachBatch`` into its own ``epoch=<id>`` folder
    (read back with ``epoch`` as a column); a retried batch overwrites its
    folder, so output is exactly once."""
    counts = level_counts(stream, ts=ts, level=level, window=window, watermark=watermark)
    w = counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    if sink == "parquet":
        base = path.rstrip("/")

        def write(batch: DataFrame, epoch: int) -> None:
            # one folder per micro-batch, overwritten on a retry of that batch:
            # a replayed epoch replaces its own output instead of duplicating it
            batch.write.mode("overwrite").parquet(f"{base}/epoch={epoch}")
        return w.foreachBatch(write).start()
    raise ValueError(f"unknown sink {sink!r}")


def start_line_job(spark: SparkSession, source: str, path: str, checkpoint: str, levels=None, window: str = "1 day",
                   watermark: str = "1 hour", files_per_batch: int | None = None, available_now: bool = True) -> StreamingQuery:
    """L1 + L2 on a text stream: the lines below ``source`` are read once and
    parsed once, and each micro-batch writes below ``path``

    - ``bad``: the lines that do not parse, with their reason;
    - ``counts``: its good lines per window and level (increments, which
      :func:`line_counts` adds up);
    - ``stats``: how many lines were seen, bad, and late, and the last event time.

    A line is late, and not counted, if its window had closed before the batch
    began: its end lies ``watermark`` or more before the last event time of earlier
    batches.  These numbers are observed while the outputs are written.  Every
    output has a folder per batch (``epoch``), which a retry overwrites, and what
    is late is decided from the batches before, so output is exactly once
    across restarts from ``checkpoint``."""
    base, delay = path.rstrip("/"), F.expr(f"INTERVAL {watermark}")
    lines = spark.readStream
    if files_per_batch:
        lines = lines.option("maxFilesPerTrigger", files_per_batch)

    def write(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        before = session.read.parquet(f"{base}/stats").filter(F.col("epoch") < epoch).agg(F.max("last")).first()[0] \
            if epoch else None
        parsed = _parsed(batch.select(F.col("value").alias("line")), "line", levels).persist()
        try:
            seen, kept, good = Observation(), Observation(), F.col("reason").isNull()
            parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("bad"),
                           F.max(F.when(good, F.col("ts"))).alias("last")) \
                .filter(~good).select("line", "reason").write.mode("overwrite").parquet(f"{base}/bad/epoch={epoch}")
            late = F.lit(False) if before is None else F.col("w.end") <= F.lit(before) - delay
            parsed.filter(good).select("level", F.window("ts", window).alias("w")) \
                .observe(kept, F.count_if(late).alias("late")).filter(~late) \
                .groupBy("w", "level").agg(F.count(F.lit(1)).alias("n")) \
                .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "level", "n") \
                .write.mode("overwrite").parquet(f"{base}/counts/epoch={epoch}")
            session.createDataFrame([(seen.get["lines"], seen.get["bad"], kept.get["late"], seen.get["last"])],
                                    "lines long, bad long, late long, last timestamp") \
                .coalesce(1).write.mode("overwrite").parquet(f"{base}/stats/epoch={epoch}")
        finally:
            parsed.unpersist()

    w = lines.text(source).writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.foreachBatch(write).start()


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(window_start, window_end, level, n)`` of a :func:`start_line_job` so far."""
    return spark.read.parquet(f"{path.rstrip('/')}/counts") \
        .groupBy("window_start", "window_end", "level").agg(F.sum("n").alias("n"))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reason)`` of a :func:`start_line_job` so far."""
    return spark.read.parquet(f"{path.rstrip('/')}/bad").select("line", "reason")
