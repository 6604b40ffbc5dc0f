"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a few records,
and a footer in a skippable frame: the seek table with every frame's compressed
and plain size. The index maps a record's identifier to its bundle, its frame
and its offset inside the plain frame, so one record is read by decoding one
frame. Tasks write their bundles to the shared folder under names of their own
attempt and only the index of the attempts that ended names them, so a task
that is lost and run again leaves at most a file that nothing refers to.

Of records with equal payloads (at least ``min_revisit`` bytes) that with the
largest page_id is the response; the others are revisits without a payload.

Defined results: a null payload is empty; rows that repeat the largest page_id
with an equal payload are all responses; a payload whose page_ids are all null
has responses only; a null URL leaves its header out; an empty table writes no
bundle and gives an empty result; a record longer than a frame's target has a
frame of its own.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlaspanel.llm.common import scratch_path, stored

MIN_REVISIT = 1000
#: Plain bytes of a frame and compressed bytes of a bundle, about.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 25
LEVEL = 3

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"
RECORDS = "record_id string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, bundle string, frame int, offset long, payload_ok boolean"


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def warc_record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One WARC/1.1 record; ``refers_to``: page_id of the response, for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """Footer of (compressed, plain) sizes as a skippable frame."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed, plain) of every frame of a bundle."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8
    table, at, out = len(data) - 9 - n * width, 0, []
    for k in range(n):
        size, plain = struct.unpack("<II", data[table + k * width : table + k * width + 8])
        out.append((at, size, plain))
        at += size
    return out


def _frames(bundle) -> list[tuple[int, int, int]]:
    """The seek table of an open bundle file; only its footer is read."""
    size = bundle.size()
    n, flags, _ = struct.unpack("<IBI", bundle.read_at(9, size - 9))
    table = 9 + n * (12 if flags & 0x80 else 8)
    return read_seek_table(bundle.read_at(table, size - table))


def read_frame(bundle, frames: list[tuple[int, int, int]], k: int) -> bytes:
    """One plain frame of an open bundle file; only its own bytes are read."""
    start, size, plain = frames[k]
    return zstandard.ZstdDecompressor().decompress(bundle.read_at(size, start), max_output_size=plain)


_PAGE = re.compile(r"<urn:x-page:(-?\d+)>")


def parse(plain: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at`` of a plain frame, and where the next one starts."""
    end = plain.index(b"\r\n\r\n", at)
    headers = dict(line.split(": ", 1) for line in plain[at:end].decode().split("\r\n")[1:])
    n = int(headers["Content-Length"])
    return headers, plain[end + 4 : end + 4 + n], end + 4 + n + 4


def _qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with its scheme: a bare path lies on the cluster's default file system, not on each machine's own disk."""
    if "://" in folder or folder.startswith("file:/"):
        return folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _filesystem(folder: str):
    if folder.startswith("file:/"):
        folder = "/" + folder[6:].lstrip("/")
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


class _Writer:
    """Records of one task, in frames and bundles; index rows come out when a bundle is on the shared store."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int):
        self.store, self.folder = _filesystem(folder)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.attempt, self.serial = uuid.uuid4().hex, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self._open()

    def _open(self):
        self.frames, self.data, self.rows = [], [], []
        self.plain, self.held = [], 0
        self.name = f"bundle-{self.attempt}-{self.serial:05d}.warc.zst"
        self.serial += 1

    def _close_frame(self):
        if self.plain:
            packed = self.packer.compress(b"".join(self.plain))
            self.frames.append((len(packed), self.held))
            self.data.append(packed)
            self.plain, self.held = [], 0

    def add(self, page_id, record: bytes) -> list[tuple]:
        if self.held and self.held + len(record) > self.frame_bytes:
            self._close_frame()
        self.rows.append((record_id(page_id), page_id, self.name, len(self.frames), self.held, len(record)))
        self.plain.append(record)
        self.held += len(record)
        return self.close() if sum(f[0] for f in self.frames) >= self.bundle_bytes else []

    def close(self) -> list[tuple]:
        self._close_frame()
        if not self.frames:
            return []
        self.store.create_dir(self.folder, recursive=True)
        with self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None) as out:
            for part in self.data:
                out.write(part)
            out.write(seek_table(self.frames))
        rows = self.rows
        self._open()
        return rows


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    names = ["record_id", "page_id", "bundle", "frame", "offset", "length"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches):
        writer = _Writer(folder, frame_bytes, bundle_bytes)
        for b in batches:
            for row in b.to_pylist():
                payload = (row["html"] or "").encode() if row["refers_to"] is None else b""
                rows = writer.add(row["page_id"], warc_record(row["page_id"], row["url"], payload, row["digest"], row["size"], row["refers_to"]))
                if rows:
                    yield batch(rows)
        if rows := writer.close():
            yield batch(rows)

    return run


def write_archives(
    pages: DataFrame, folder: str, id_col="page_id", url_col="url", html_col="html", min_revisit: int = MIN_REVISIT,
    frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write ``pages`` as bundles in ``folder``; returns the stored index (record_id, page_id, bundle, frame, offset, length)."""
    folder = _qualified(pages.sparkSession, folder)
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"),
        F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("size"),
    )
    # only payloads held more than once need the name of their response
    first = (
        rows.filter(F.col("size") >= min_revisit).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("digest").alias("d"), F.col("size").alias("s"), "first")
    )
    named = rows.join(first, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return stored(named.select("page_id", "url", "html", "digest", "size", refers.alias("refers_to")).mapInArrow(_write(folder, frame_bytes, bundle_bytes), INDEX), "warc-index")


def _read(folder: str):
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.bool_()]
    names = ["record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "offset", "payload_ok"]

    def records(name, frame, plain):
        at = 0
        while at < len(plain):
            headers, block, after = parse(plain, at)
            page, kind = _PAGE.match(headers["WARC-Record-ID"]), headers["WARC-Type"]
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)", http)[1])
            digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            refers = _PAGE.match(headers.get("WARC-Refers-To", ""))
            ok = kind == "revisit" or (len(payload) == size and hashlib.sha1(payload).hexdigest() == digest)
            yield headers["WARC-Record-ID"], int(page[1]) if page else None, size, digest, kind, int(refers[1]) if refers else None, name, frame, at, ok
            at = after

    def run(batches):
        store, base = _filesystem(folder)
        for b in batches:
            for name in b.column("bundle").to_pylist():
                with store.open_input_file(f"{base}/{name}") as bundle:
                    frames = _frames(bundle)
                    for k in range(len(frames)):
                        rows = list(records(name, k, read_frame(bundle, frames, k)))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def _dealt(spark: SparkSession, bundles: DataFrame) -> DataFrame:
    """Bundles over all tasks (few small rows would else be put together in one)."""
    return bundles.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), "bundle")


def read_archives(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, read back and checked against its digest.

    Tasks open the bundles where they lie, frame by frame; no bundle moves.
    """
    return _dealt(spark, index.select("bundle").distinct()).mapInArrow(_read(_qualified(spark, folder)), RECORDS)


def verified(records: DataFrame) -> DataFrame:
    """``records`` as read, an error if one's payload is not what its digest says (a filter, so that no selection prunes it)."""
    damaged = F.raise_error(F.format_string("damaged payload: %s in %s, frame %d", "record_id", "bundle", "frame")).cast("boolean")
    return records.filter(F.when(F.col("payload_ok"), True).otherwise(damaged))


def _seek(folder: str):
    def run(batches):
        store, base = _filesystem(folder)
        for b in batches:
            for name, places in zip(b.column("bundle").to_pylist(), b.column("places").to_pylist()):
                with store.open_input_file(f"{base}/{name}") as bundle:
                    frames, at, plain, rows = _frames(bundle), None, b"", []
                    for p in sorted(places, key=lambda p: (p["frame"], p["offset"])):
                        if p["frame"] != at:
                            at, plain = p["frame"], read_frame(bundle, frames, p["frame"])
                        rows.append((p["record_id"], plain[p["offset"] : p["offset"] + p["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["record_id", "record"])

    return run


def fetch_records(spark: SparkSession, folder: str, index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """(record_id, record) of the wanted identifiers, reading and decoding only the frames that hold them."""
    wanted = index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi")
    places = wanted.groupBy("bundle").agg(F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("places"))  # at most a bundle's records
    return _dealt(spark, places).mapInArrow(_seek(_qualified(spark, folder)), "record_id string, record binary")


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as archives and read them back: one row per record, an error if a payload came back damaged."""
    folder = folder or scratch_path(spark, "llm-warc")
    index = write_archives(pages, folder, **columns)
    return verified(read_archives(spark, folder, index))
