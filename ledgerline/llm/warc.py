"""Web archives as seekable Zstandard bundles.

Pages become WARC records. Records are grouped into blocks, each block an
independent Zstandard frame, and a bundle ends with a seek table in a
skippable frame (the published seekable format: compressed and decompressed
size and the low half of the data's XXH64 per frame, then the frame count and a
magic number), so ordinary tools read the bundle whole and a reader reaches one
frame without the others. An index maps a record's identifier to bundle, frame and the
record's place inside the decompressed frame.

Of the records with equal payloads, the one with the largest page_id is a
response and the others are revisit records that refer to it; equality is that
of SHA-1, SHA-256 and length together.

Copies are grouped by payload hash in narrow rows. The few groups with very
many copies (``HOT`` or more, so at most rows / HOT of them) are broadcast if
their number is checked to be small, and their pages keep out of the other
groups' join, so that no task gets a hot group's pages.

Tasks write bundles under the shared checkpoint folder (or a given one)
through Arrow's file systems, under a name of their own for each attempt; the
index is written by Spark, so only bundles of successful attempts are ever
read. A task holds one block at a time.

Defined cases: a null html is an empty payload; a null url leaves out the
target field; control characters and spaces in a url are percent-encoded; a
null page_id is the smallest, refers like others, and is never referred to (a
group of null ids only is all responses); rows that repeat the largest page_id
are all responses; an empty table gives no bundle and no row; other columns
are unused.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, small_batches

BLOCK = 1 << 20              # decompressed bytes after which a frame is closed
BUNDLE = 256 << 20           # compressed bytes after which a bundle is closed
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
HOT = 10_000                 # copies of a payload from which its group is broadcast
HOT_GROUPS = 200_000         # groups that may be broadcast
# fixed values of the formats
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = ("page_id long, bundle string, frame int, frame_offset long, frame_bytes long, "
         "record_offset long, record_bytes long")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head, whose
    Content-Length is the full payload's, and drops the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    name = "null" if page_id is None else str(page_id)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{digest32(payload)}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: "
                 "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record, checked against its own lengths and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    f = dict(line.split(": ", 1) for line in lines[1:])
    block, tail = rest[:int(f["Content-Length"])], rest[int(f["Content-Length"]):]
    if len(block) != int(f["Content-Length"]) or tail != b"\r\n\r\n":
        raise ValueError("record length")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = f["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest32(payload) != digest):
        raise ValueError("payload digest")
    name = f["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = f.get("WARC-Refers-To")
    return {"page_id": None if name == "null" else int(name), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "url": f.get("WARC-Target-URI"),
            "payload": payload if kind == "response" else None,
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None}


def frame_checksum(data: bytes) -> int:
    """The seekable format's: the low 32 bits of XXH64."""
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """Skippable frame of (compressed, decompressed, checksum) entries."""
    body = b"".join(struct.pack("<III", *f) for f in frames)
    body += struct.pack("<IBI", len(frames), 0x80, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """Frames (compressed, decompressed, checksum) of an open bundle."""
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE or flags != 0x80:
        raise ValueError("no seek table")
    f.seek(size - 9 - 12 * n - 8)
    raw = f.read(8 + 12 * n)
    if struct.unpack("<II", raw[:8]) != (SKIPPABLE, 12 * n + 9):
        raise ValueError("seek table frame")
    return [struct.unpack_from("<III", raw, 8 + 12 * i) for i in range(n)]


# Names that Arrow has for the stores of Hadoop addresses.
STORES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
          "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_address(uri: str) -> str:
    """A Hadoop-style address under the name that Arrow has for its store."""
    if "://" not in uri:
        return "file:///" + uri.removeprefix("file:").lstrip("/")
    scheme, _, rest = uri.partition("://")
    if scheme not in STORES:
        raise ValueError(f"{uri}: bundles cannot be written to {scheme}://; give a folder in one of {sorted(STORES)}")
    return f"{STORES[scheme]}://{rest}"


def _file_system(uri: str):
    """(file system, path) of a Hadoop-style address, through Arrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(arrow_address(uri))


class _Bundle:
    """A bundle being written by one task attempt."""

    def __init__(self, folder: str, block: int, level: int):
        import zstandard

        self.uri = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
        store, path = _file_system(folder)
        store.create_dir(path, recursive=True)
        self.out = store.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}", compression=None)
        self.zip = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
        self.block, self.frames, self.at = block, [], 0
        self.raw, self.size, self.ids = [], 0, []

    def add(self, page_id: int | None, raw: bytes) -> list[tuple]:
        self.ids.append((page_id, self.size, len(raw)))
        self.raw.append(raw)
        self.size += len(raw)
        return self.close_frame() if self.size >= self.block else []

    def close_frame(self) -> list[tuple]:
        if not self.ids:
            return []
        data = b"".join(self.raw)
        packed = self.zip.compress(data)
        self.out.write(packed)
        rows = [(p, self.uri, len(self.frames), self.at, len(packed), off, n) for p, off, n in self.ids]
        self.frames.append((len(packed), len(data), frame_checksum(data)))
        self.at += len(packed)
        self.raw, self.size, self.ids = [], 0, []
        return rows

    def close(self) -> list[tuple]:
        rows = self.close_frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return rows


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4]
    cols = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)],
        names=[x.split()[0] for x in INDEX.split(", ")])


def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
             least: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), html.alias("html"))
    key = ["_sha1", "_sha2", "_bytes"]
    rows = rows.select("*", F.sha1("html").alias("_sha1"), F.sha2("html", 256).alias("_sha2"),
                       F.octet_length("html").alias("_bytes"))
    # pre-aggregated by payload: a group of copies of any size is one row
    groups = cut(rows.select("page_id", *key).where(F.col("_bytes") >= least)
                 .groupBy(*key).agg(F.max("page_id").alias("_main"), F.count("*").alias("_n"))
                 .where("_n > 1 and _main is not null"), "warc-copies")
    hot = groups.where(F.col("_n") >= HOT).select(*key, F.col("_main").alias("_hot"))
    if hot.limit(HOT_GROUPS + 1).count() > HOT_GROUPS:
        hot = hot.limit(0)           # so many groups that none is a large part of the pages
        cold = groups
    else:
        cold = groups.where(F.col("_n") < HOT)
    # pages of hot groups have a number of their own in the other join
    spread = F.when(F.col("_hot").isNotNull(), F.xxhash64("page_id", "url")).otherwise(F.lit(0))
    known = rows.join(F.broadcast(hot), key, "left").withColumn("_spread", spread)
    cold = cold.drop("_n").withColumn("_spread", F.lit(0).cast("long"))
    main = F.coalesce("_hot", "_main")
    return known.join(cold.hint("merge"), [*key, "_spread"], "left").select(
        "page_id", "url", "html", F.when(main.isNotNull() & ~F.col("page_id").eqNullSafe(main), main).alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id",
          html_col: str = "html", least: int = 0, block: int = BLOCK, bundle: int = BUNDLE,
          level: int = LEVEL) -> DataFrame:
    """Write the bundles and return their index, a written table."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for b in batches:
            rows = []
            for page_id, url, html, refers in zip(*[c.to_pylist() for c in b.columns]):
                open_ = open_ or _Bundle(folder, block, level)
                rows += open_.add(page_id, record(page_id, url, html.encode("utf-8", "surrogatepass"), refers))
                if open_.at >= bundle:
                    rows += open_.close()
                    open_ = None
            yield _rows(rows)
        if open_ is not None:
            yield _rows(open_.close())
    return cut(revisits(pages, id_col, html_col, least).mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """Read the records of an index back from the bundles, frame by frame;
    each frame is found through the bundle's seek table and each record at its
    indexed place. Any subset of an index reads only its own frames."""
    spark = index.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = index.repartition(n, "bundle", "frame").sortWithinPartitions("bundle", "frame", "record_offset")

    def run(batches):
        import zstandard

        unzip = zstandard.ZstdDecompressor()
        uri = f = table = None
        at, data = None, b""
        for b in batches:
            out = []
            for page_id, bundle, frame, off, size, start, length in zip(*[c.to_pylist() for c in b.columns]):
                if bundle != uri:
                    if f is not None:
                        f.close()
                    store, path = _file_system(bundle)
                    f, uri, at = store.open_input_file(path), bundle, None
                    table = read_seek_table(f, f.size())
                    places = np.cumsum([0] + [x[0] for x in table])
                if frame != at:
                    f.seek(int(places[frame]))
                    data = unzip.decompress(f.read(table[frame][0]))
                    if frame_checksum(data) != table[frame][2] or (int(places[frame]), table[frame][0]) != (off, size):
                        raise ValueError(f"{bundle}: frame {frame} differs from its seek table or index")
                    at = frame
                r = parse_record(data[start:start + length])
                if r["page_id"] != page_id:
                    raise ValueError(f"{bundle}: record {page_id} is not at its indexed place")
                out.append(tuple(r[k] for k in ("page_id", "payload_bytes", "payload_digest",
                                                "record_type", "refers_to", "url", "payload")))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url",
                       "payload"])
        if f is not None:
            f.close()
    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                 "record_type string, refers_to long, url string, payload binary")
