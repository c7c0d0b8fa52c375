"""WARC archives with an embedded Zstandard dictionary (operator 10).

An archive is a ``.warc.zst`` file: a leading skippable frame holds the
dictionary (itself compressed), then every record is one frame of its own,
compressed with the dictionary.  The dictionary is trained on a bounded sample
of the records to be archived.  Archives are rows of a table in the shared
folder (``archive`` name, ``data`` bytes), so Spark's commit keeps them whole
when tasks are retried; ``data`` is byte for byte the file.

Of records with equal payloads of at least ``MIN_PAYLOAD`` bytes, the one with
the largest page id is a response (each of its rows, if the id is repeated)
and the others are revisits of it; smaller ones are all responses.  A null
payload is empty.  Rows without a page id come before all others; if a payload
has no other rows, all are responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_path, stored

MIN_PAYLOAD = 1000
#: Records the dictionary is trained on (those with the smallest id hashes),
#: the bytes taken of each, and the dictionary's size.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 1 << 16, 1 << 15
#: An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classify(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest`` (SHA-1, hex), ``size`` and
    ``refers_to`` (the response's page id, or null) of every row.  Only groups
    with a payload to revisit take part in the join."""
    p = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                     F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("digest", F.sha1(F.col("payload"))).withColumn("size", F.octet_length("payload").cast("long"))
    groups = p.filter(F.col("size") >= MIN_PAYLOAD).groupBy("digest") \
        .agg(F.max(F.struct(F.col("page_id").alias("head"), F.col("url").alias("head_url"))).alias("h"),
             F.count(F.lit(1)).alias("n")).filter("n > 1 and h.head is not null")
    groups = stored(groups.select("digest", "h.head", "h.head_url"), "payload-groups")
    earlier = F.coalesce("page_id", F.lit(-(1 << 63))) < F.col("head")
    return p.join(groups, "digest", "left").select(
        "page_id", "url", "payload", "digest", "size",
        F.when(earlier, F.col("head")).alias("refers_to"), F.when(earlier, F.col("head_url")).alias("refers_url"))


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """Of page, address and payload: rows that repeat a page id, or have none,
    have ids of their own unless all three are equal, and a revisit can name
    its response's."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{url}')}>"


def target_uri(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           refers_url: str | None) -> bytes:
    """One WARC record.  A revisit has the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, url, digest)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target_uri(url)}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, refers_url, digest)}",
                 f"WARC-Refers-To-Target-URI: {target_uri(refers_url)}", f"WARC-Profile: {REVISIT_PROFILE}",
                 f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    block = http if refers_to is not None else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says: type, ids, URI, and of the payload its bytes (None
    in a revisit), size and digest.  A response's size and digest are measured
    on the payload read, and must be those of its header."""
    end = raw.index(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in raw[:end].decode().split("\r\n")[1:])
    block = raw[end + 4:end + 4 + int(head["Content-Length"])]
    if raw[end + 4 + len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end where it should")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    response = head["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload is not the one that was archived")
    number = lambda k: int(head[k]) if k in head else None
    return {"page_id": number("X-Page-ID"), "url": head["WARC-Target-URI"], "record_type": head["WARC-Type"],
            "payload": payload if response else None, "payload_bytes": size, "payload_digest": digest,
            "refers_to": number("X-Refers-To-Page")}


def train(records: DataFrame) -> bytes:
    """A dictionary from the records with the smallest id hashes.  With too few
    of them to train on, their own bytes are the dictionary."""
    hashed = records.withColumn("h", F.xxhash64("page_id", "digest"))
    last = hashed.select("h").orderBy("h").limit(SAMPLE_RECORDS).agg(F.max("h")).first()[0]
    rows = hashed.filter(F.col("h") <= F.lit(last)).select(
        "page_id", "url", "digest", "refers_to", "refers_url", F.substring(F.encode("payload", "UTF-8"), 1, SAMPLE_BYTES).alias("payload")) \
        .limit(SAMPLE_RECORDS).collect() if last is not None else []
    samples = [record(r.page_id, r.url, bytes(r.payload), r.digest, r.refers_to, r.refers_url)
               for r in rows]
    if len(samples) >= 32:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
        except zstandard.ZstdError:
            pass        # samples too alike or too short to train on
    return b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"


def write_archives(records: DataFrame, dictionary: bytes, name: str = "archives") -> DataFrame:
    """Archive the records of ``classify``: a stored table of ``archive``,
    ``records`` (their number) and ``data``."""
    spark = records.sparkSession
    shipped = spark.sparkContext.broadcast(dictionary)

    def run(batches):
        words = zstandard.ZstdCompressionDict(shipped.value)
        packer = zstandard.ZstdCompressor(level=3, dict_data=words, write_content_size=True)
        packed = zstandard.ZstdCompressor(level=9).compress(shipped.value)
        lead = struct.pack("<II", SKIPPABLE_MAGIC, len(packed)) + packed
        part, made, frames, size = TaskContext.get().partitionId(), 0, [], 0

        def archive():
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:06d}-{made:05d}.warc.zst"]), pa.array([len(frames)], pa.int64()),
                 pa.array([lead + b"".join(frames)], pa.binary())], names=["archive", "records", "data"])

        for batch in batches:
            for page, url, payload, digest, refers_to, refers_url in zip(*(c for c in batch.columns)):
                frames.append(packer.compress(record(page.as_py(), url.as_py(), payload.as_py().encode(),
                                                     digest.as_py(), refers_to.as_py(), refers_url.as_py())))
                size += len(frames[-1])
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    made, frames, size = made + 1, [], 0
        if frames:
            yield archive()

    path = shared_path(spark, name)
    schema = "archive string, records long, data binary"
    records.select("page_id", "url", "payload", "digest", "refers_to", "refers_url").mapInArrow(run, schema) \
        .write.option("compression", "none").parquet(path)
    return spark.read.schema(schema).parquet(path)


def frames(data: bytes):
    """The records of an archive: its dictionary first, then frame by frame."""
    view = memoryview(data)
    magic, size = struct.unpack("<II", view[:8])
    if magic != SKIPPABLE_MAGIC:
        raise ValueError("no leading dictionary frame")
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(view[8:8 + size]))
    unpacker = zstandard.ZstdDecompressor(dict_data=words)
    at = 8 + size
    while at < len(view):
        frame, out = unpacker.decompressobj(), []
        while not frame.eof:
            piece = view[at:at + 16384]
            if not len(piece):
                raise ValueError("the archive ends within a record")
            out.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(out)


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Every record of the archives, as ``parse`` tells it."""
    columns = {"page_id": ("long", pa.int64()), "url": ("string", pa.string()),
               "record_type": ("string", pa.string()), "payload": ("binary", pa.binary()),
               "payload_bytes": ("long", pa.int64()), "payload_digest": ("string", pa.string()),
               "refers_to": ("long", pa.int64())}
    if not payload:
        del columns["payload"]

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for raw in frames(data.as_buffer()):
                    rows.append(parse(raw))
                    size += len(raw)
                    if size >= 8 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, (_, kind) in columns.items()],
                                          names=list(columns))

    return archives.select("data").mapInArrow(run, ", ".join(f"{c} {t}" for c, (t, _) in columns.items()))


def archive(pages: DataFrame) -> DataFrame:
    """Classify the pages, train a dictionary, write the archives; the stored
    table of archives."""
    records = classify(pages)
    return write_archives(records, train(records))


def export(archives: DataFrame, folder: str) -> DataFrame:
    """Write every archive as a file of its own below ``folder``, a URI that
    ``pyarrow.fs`` can reach from the executors; returns names and sizes."""
    def run(batches):
        from pyarrow import fs
        to, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            sizes = []
            for name, data in zip(names, batch.column(1)):
                with to.open_output_stream(f"{root}/{name}", compression=None) as f:
                    f.write(data.as_buffer())
                sizes.append(len(data.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], names=["archive", "bytes"])

    return archives.select("archive", "data").mapInArrow(run, "archive string, bytes long")
