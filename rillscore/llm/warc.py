"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing is a Spark job that leaves archives of bounded size in a shared folder and returns their paths; reading takes such
paths, streams each archive frame by frame and validates magic numbers, headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import bounded_sample, scratch_path, table, tidy

DICT_FRAME = 0x184D2A5D  # skippable frame that holds the dictionary
DICT_MAGIC, ZSTD_MAGIC = b"\x37\xa4\x30\xec", b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A trained dictionary; with too few samples to train, a small one made of them (no bytes at all without samples)."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(s[:1024] for s in samples[:8])


def urn(page_id: int | None) -> str:
    return "<urn:page:>" if page_id is None else f"<urn:page:{page_id}>"


def _id_of(value: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d*)>", value)
    if not m:
        raise ValueError(f"bad record id {value!r}")
    return int(m[1]) if m[1] else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit has the HTTP header (with the full length) but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(payload).digest()).decode()}"]
    if revisit:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; raises ValueError where version, lengths, digest or ends are wrong."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"record of {len(rest) - 4} bytes, header says {length}")
    http, sep, payload = rest[:length].partition(b"\r\n\r\n")
    said = re.search(rb"(?im)^content-length: *(\d+)", http)
    if not sep or not http.startswith(b"HTTP/") or not said:
        raise ValueError("no HTTP header")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response":
        if len(payload) != int(said[1]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("payload does not match its length or digest")
    elif headers["warc-type"] != "revisit" or payload:
        raise ValueError("neither a response nor a revisit without payload")
    return {"page_id": _id_of(headers["warc-record-id"]), "url": headers["warc-target-uri"], "type": headers["warc-type"], "digest": digest, "size": int(said[1]), "payload": payload, "refers_to": _id_of(headers["warc-refers-to"]) if "warc-refers-to" in headers else None}


def read_archive(f: BinaryIO, chunk: int = 1 << 20) -> Iterator[dict]:
    """Records of one archive, decoded one frame at a time; memory is bounded by the longest record."""
    head = f.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICT_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    size = struct.unpack("<I", head[4:])[0]
    dictionary = f.read(size)
    if len(dictionary) != size:
        raise ValueError("the dictionary frame is cut off")
    if dictionary[:4] == ZSTD_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    kind = zstandard.DICT_TYPE_FULLDICT if dictionary[:4] == DICT_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind)) if dictionary else zstandard.ZstdDecompressor()
    left = f.read(chunk)
    while left:
        frame, out = decoder.decompressobj(), []
        while True:
            out.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data or f.read(chunk)
                break
            if not (left := f.read(chunk)):
                raise ValueError("the last frame is cut off")
        yield parse_record(b"".join(out))


def _open(path: str, write: bool):
    """A stream of the path's file system: local folders, HDFS or an object store, by the path's scheme."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else re.sub("^file:", "file://", path))
    if write:
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(name) if write else store.open_input_stream(name)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, most: int = 32 << 20, dictionary_samples: int = 300, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per row to archives of about `most` bytes each; returns (path, records, bytes) of the archives.

    Of rows with equal payloads of at least min_bytes, the one with the smallest id is a response, the others revisit it;
    smaller payloads are all responses. Null html is an empty payload, a null url an empty one. Of repeated rows with the
    smallest id the first is the response. A payload that occurs only under null ids is a response each time. An empty
    table leaves no archive. Payloads are shuffled once, by id, and meet the (small) decisions there, so a payload that a
    third of all rows share is no hot key; the smallest id per digest is found with map-side combining. Files get new
    names on each attempt and only those of finished tasks are returned, so lost executors do no harm.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumn("sha", F.unhex(F.sha1("html")))
    marks = table(src.select("page_id", "sha", F.length("html").alias("n")), "digests")
    first = marks.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    again = marks.where(F.col("n") >= min_bytes).join(first, "sha").select("page_id", "sha", "first").distinct()
    none = F.lit(None)
    both = src.select("page_id", F.lit(1).alias("kind"), "sha", none.cast("long").alias("first"), "url", "html").unionByName(again.select("page_id", F.lit(0).alias("kind"), "sha", "first", none.cast("string").alias("url"), none.cast("binary").alias("html")))
    both = both.withColumn("key", F.coalesce("page_id", F.xxhash64("sha")))
    dealt = both.repartition("key").sortWithinPartitions("key", "page_id", "kind", "sha").select("page_id", "kind", "sha", "first", "url", "html")
    # The dictionary is trained on the beginnings of some pages; it decides how well records compress, never what they hold.
    sample = bounded_sample(src.select("page_id", F.substring("html", 1, 64 << 10).alias("html")), "page_id", dictionary_samples, "html")
    dictionary = train_dictionary([bytes(r.html) for r in sample if r.html])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3, write_content_size=True, **({"dict_data": zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_FULLDICT if dictionary[:4] == DICT_MAGIC else zstandard.DICT_TYPE_RAWCONTENT)} if dictionary else {}))
        done, out, path, size, records = [], None, "", 0, 0

        def finish():
            if out is not None:
                out.close()
                done.append((path, records, size))

        at, firsts, used = object(), {}, set()
        for b in batches:
            for page_id, kind, sha, first, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if page_id != at:
                    at, firsts, used = page_id, {}, set()
                if kind == 0:
                    firsts[sha] = first
                    continue
                origin = firsts.get(sha)
                revisit = origin is not None and (origin != page_id or sha in used)
                used.add(sha)
                if out is None or size >= most:
                    finish()
                    path, size, records = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = _open(path, True)
                    out.write(struct.pack("<II", DICT_FRAME, len(dictionary)) + dictionary)
                frame = coder.compress(record(page_id, url, html, origin, revisit))
                out.write(frame)
                size, records = size + len(frame), records + 1
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], ["path", "records", "bytes"])

    return table(dealt.mapInArrow(tidy(write), "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = False, task_bytes: int = 64 << 20) -> DataFrame:
    """(path, and bytes if known) -> page_id, url, record_type, payload_bytes, payload_digest, refers_to and, if asked for, the payload.

    Archives are dealt to tasks by path and streamed. A damaged archive raises ValueError. payload is null for revisits.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for path in b.column(0).to_pylist():
                    with _open(path, False) as f:
                        yield from read_archive(f)

        some, held = [], 0
        for r in rows():
            some.append(r)
            held += r["size"]
            if len(some) >= 2000 or held > 16 << 20:
                yield batch(some)
                some, held = [], 0
        if some:
            yield batch(some)

    def batch(rs: list[dict]) -> pa.RecordBatch:
        cols = [("page_id", pa.int64()), ("url", pa.string()), ("type", pa.string()), ("size", pa.int64()), ("digest", pa.string()), ("refers_to", pa.int64())]
        arrays = [pa.array([r[c] for r in rs], t) for c, t in cols]
        if payloads:
            arrays.append(pa.array([r["payload"] if r["type"] == "response" else None for r in rs], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payloads
    names = [x.split()[0] for x in schema.split(", ")]
    # As many partitions as archives need by their bytes (or a file each, where these are not known): paths alone are tiny.
    size = F.sum("bytes") if "bytes" in archives.columns else F.lit(None)
    n, total = archives.agg(F.count("*"), size.cast("long")).first()
    parts = n if total is None else min(n, max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // task_bytes)))
    return archives.select("path").repartition(max(1, parts), "path").mapInArrow(tidy(read), schema)


def round_trip(pages: DataFrame, payloads: bool = False, **options) -> DataFrame:
    """Write the pages to archives in the shared folder and read the archives back."""
    return read_archives(write_archives(pages, scratch_path(pages.sparkSession, "warc"), **options), payloads)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS hex FROM p),
bits AS (
  SELECT hex, array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4)), '') AS s
  FROM (SELECT DISTINCT hex FROM h)),
base32 AS (
  SELECT hex, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    16 * substr(s, 5 * i + 1, 1)::INT + 8 * substr(s, 5 * i + 2, 1)::INT + 4 * substr(s, 5 * i + 3, 1)::INT
    + 2 * substr(s, 5 * i + 4, 1)::INT + substr(s, 5 * i + 5, 1)::INT + 1, 1)), '') AS digest FROM bits),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS origin, row_number() OVER (PARTITION BY hex ORDER BY page_id) AS k FROM h)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN origin END AS refers_to
FROM f JOIN base32 USING (hex)
"""
