"""Seekable Zstandard WARC bundles.

Each task writes bundles: records are grouped into independent Zstandard frames, after
which a skippable frame holds the seek table (frame sizes, with the footer of the public
seekable format), so a reader can decompress one frame alone.  The index maps each record
identifier to its bundle, frame, and offset within the frame's plain bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import scratch_dir

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_SCHEMA = (
    "record_key string, record_type string, bundle string, frame int, frame_start long, frame_bytes long, "
    "record_start long, record_bytes long"
)
RECORD_SCHEMA = (
    "record_key string, record_type string, refers_to string, target_uri string, payload_bytes long, "
    "payload_digest string, payload binary"
)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI (file, hdfs, s3, gs) or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


class BundleWriter:
    """Writes one bundle: add() records, close() ends it with the seek table."""

    def __init__(self, uri: str, frame_bytes: int, level: int):
        self.fs, self.path = open_fs(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.at = self.fs.open_output_stream(self.path + ".part"), 0
        self.uri, self.limit, self.packer = uri, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.plain, self.waiting = bytearray(), []

    def add(self, key: str, kind: str, record: bytes) -> list[tuple]:
        """Index rows of the frame that this record completed, if any."""
        self.waiting.append((key, kind, len(self.plain), len(record)))
        self.plain += record
        return self.flush() if len(self.plain) >= self.limit else []

    def flush(self) -> list[tuple]:
        if not self.waiting:
            return []
        packed = self.packer.compress(bytes(self.plain))
        self.out.write(packed)
        rows = [(k, t, self.uri, len(self.frames), self.at, len(packed), start, n) for k, t, start, n in self.waiting]
        self.frames.append((len(packed), len(self.plain)))
        self.at += len(packed)
        self.plain, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)  # a bundle that has its name is whole
        return rows


def seek_table(source) -> list[tuple[int, int, int]]:
    """(start, packed size, plain size) of each frame, read from the bundle's end."""
    size = source.size()
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    source.seek(size - 9 - 8 * n)
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", source.read(8 * n)):
        out.append((at, packed, plain))
        at += packed
    return out


def _header(value: str) -> str:
    """A header value of one line: control characters and % are percent-encoded."""
    return re.sub("[\x00-\x1f\x7f%]", lambda m: quote(m[0], safe=""), value)


def make_record(key: str, uri: str | None, payload: bytes, digest: str, length: int, refers_to: str | None) -> bytes:
    """A WARC/1.1 response, or a revisit that keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:record:{_header(key)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        head.append(f"WARC-Target-URI: {_header(uri)}")
    if refers_to is not None:
        head += [
            f"WARC-Refers-To: <urn:record:{_header(refers_to)}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_records(plain: bytes) -> Iterator[tuple]:
    """Rows of RECORD_SCHEMA from a frame's plain bytes."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        block = plain[end + 4 : end + 4 + size]
        at = end + 8 + size
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        name = lambda x: unquote(x[len("<urn:record:") : -1]) if x else None
        uri = head.get("WARC-Target-URI")
        kind = head["WARC-Type"]
        yield (
            name(head["WARC-Record-ID"]),
            kind,
            name(head.get("WARC-Refers-To")),
            None if uri is None else unquote(uri),
            length,
            head["WARC-Payload-Digest"].removeprefix("sha1:"),
            payload if kind == "response" else None,
        )


def _frame_of(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def mark_revisits(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """pages with _digest (hex SHA-1), _bytes and _first: the smallest key with this payload.

    The digests are pre-aggregated; only digests that occur twice or more are joined back,
    and a digest that a third of all pages share is split by AQE's skew join.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    df = pages.withColumns({"_payload": body})
    df = df.withColumns({"_digest": F.sha1("_payload"), "_bytes": F.length("_payload").cast("long")})
    slim = pages.select(F.col(key), F.sha1(body).alias("_d"), F.length(body).alias("_n"))
    twice = slim.where(F.col("_n") >= least).groupBy("_d").agg(F.min(key).alias("_first"), F.count("*").alias("_c")).where("_c > 1").drop("_c")
    return df.join(twice, F.col("_digest") == F.col("_d"), "left").drop("_d")


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    frame_bytes: int = 1 << 20,
    bundle_bytes: int = 256 << 20,
    level: int = 3,
) -> DataFrame:
    """Write all pages below folder as bundles; returns the index (INDEX_SCHEMA).

    Of pages with equal payloads of at least min_revisit_bytes those with the smallest key
    are responses and the others revisit them.  A payload of null counts as empty, a url of
    null gives no target URI, a key of null gives an empty identifier and sorts last.
    Repeated rows with the smallest key are all responses.  A task holds one frame and one
    record; a payload of any size is one record.  Each attempt of a task writes files of its
    own, and the index, which is stored, names only those of the attempt that counted.
    """
    spark = pages.sparkSession
    marked = mark_revisits(pages.select(key, url, payload), key, payload, min_revisit_bytes)
    revisit = F.col("_first").isNotNull() & (F.col(key).isNull() | (F.col(key) != F.col("_first")))
    rows = marked.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
        F.col(url).cast("string").alias("u"),
        F.when(~revisit, F.col("_payload")).alias("p"),
        F.col("_digest").alias("d"),
        F.col("_bytes").alias("n"),
        F.when(revisit, F.col("_first").cast("string")).alias("r"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, done = None, []
        for batch in batches:
            for k, u, p, d, n, r in batch.itertuples(index=False):
                if writer is None:
                    writer = BundleWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst", frame_bytes, level)
                digest = base64.b32encode(bytes.fromhex(d)).decode()
                done += writer.add(k, "response" if r is None else "revisit", make_record(k, u, p or b"", digest, n, r))
                if writer.at >= bundle_bytes:
                    done += writer.close()
                    writer = None
            if done:
                yield _frame_of(done, INDEX_SCHEMA)
                done = []
        if writer is not None:
            yield _frame_of(writer.close(), INDEX_SCHEMA)

    rows.mapInPandas(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def read_warc(index: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Every record of the index's bundles (RECORD_SCHEMA), frame by frame.

    keep_payload False leaves payload null.
    """
    # frames, not bundles, are dealt out: a large bundle is read by many tasks
    frames = index.select("bundle", "frame").distinct()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle, group in batch.groupby("bundle"):
                fs, path = open_fs(bundle)
                with fs.open_input_file(path) as source:
                    table = seek_table(source)
                    for frame in group["frame"]:
                        start, packed, plain = table[frame]
                        source.seek(start)
                        found = list(parse_records(unpack.decompress(source.read(packed), max_output_size=plain)))
                        if not keep_payload:
                            found = [(*x[:-1], None) for x in found]
                        yield _frame_of(found, RECORD_SCHEMA)

    return frames.mapInPandas(read, RECORD_SCHEMA)


def fetch(index: DataFrame, key: str) -> list[tuple]:
    """The records with this identifier, each from its own frame by its offset in it."""
    out = []
    for r in index.where(F.col("record_key") == key).collect():
        fs, path = open_fs(r["bundle"])
        with fs.open_input_file(path) as source:
            source.seek(r["frame_start"])
            reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(source.read(r["frame_bytes"])))
            plain = reader.read()
        out += parse_records(plain[r["record_start"] : r["record_start"] + r["record_bytes"]])
    return out


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def new_folder(spark: SparkSession) -> str:
    """A fresh shared folder for bundles."""
    return scratch_dir(spark)
