"""WARC archives with a Zstandard dictionary, written by executors and read back.

A file is a leading skippable frame that holds the dictionary, then one Zstandard
frame for each record, then an empty skippable frame (what the writer puts after
a file). The dictionary is trained on records of that same file: all of them up to
``SAMPLE_BYTES``, beyond it records at even steps. Files that are too small or too
uniform to train on take a raw dictionary, cut from the same records. The dictionary
changes the size of a file, never what is read from it.

Of records with equal payloads (same SHA-1 and length) of at least ``min_bytes``
bytes, those with the largest page_id are responses, the others are revisits
without a payload that name it; all other records are responses.

Defined cases: a null html is an empty payload; a null url is an empty one, and
control characters and spaces in a url are percent-encoded; a record with a null
page_id is a response unless an equal payload has an id; repeated rows each have a
record, and those that share the largest page_id are all responses; an empty table
gives no file; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.blobs import bound_batches, read_blobs, write_blobs
from tidewater.workspace import Workspace

DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
#: An empty skippable frame, as text for the writer.
TRAILER = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 32 << 10, 2 << 20, 3
_DATE = "2024-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[\x00-\x20\x7f-\xa0]")
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    found = name.removeprefix("<urn:page:").removesuffix(">")
    return None if found == "none" else int(found)


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    block = _HTTP.format(len(payload)).encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {_DATE}"]
    head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or ""))
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]):
    import zstandard

    total = sum(map(len, records))
    step = -(-total // SAMPLE_BYTES)
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=200, d=8)
    except zstandard.ZstdError:
        raw = b"".join(sample)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    import zstandard

    held = train_dictionary(records)
    data = held.as_bytes()
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True).compress
    return b"".join([DICTIONARY_MAGIC, struct.pack("<I", len(data)), data, *map(pack, records)])


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        key, _, value = line.decode().rstrip("\r\n").partition(": ")
        out[key] = value
    return out


def read_archive(blob: bytes):
    """(headers, http headers, payload) of each record of a file, streamed."""
    import zstandard

    if blob[:4] != DICTIONARY_MAGIC:
        raise ValueError("no leading dictionary frame")
    (n,) = struct.unpack_from("<I", blob, 4)
    raw = blob[8 : 8 + n]
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    held = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    stream = io.BufferedReader(held.stream_reader(io.BytesIO(memoryview(blob)[8 + n :]), read_across_frames=True), 1 << 18)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("no record where one should begin")
        head = _headers(stream)
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut")
        own = io.BytesIO(block)
        own.readline()
        yield head, _headers(own), own.read()


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, file_bytes: int = 12 << 20) -> None:
    """Archive pages (page_id, url, html) in files of about file_bytes before compression, each held in memory once."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(k) for k in range(5))):
                name = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                held.append(record(page_id.as_py(), url.as_py(), payload.as_py(), name, refers_to.as_py()))
                size += len(held[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_pydict({"file": pa.array([archive(held)], pa.binary())})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"file": pa.array([archive(held)], pa.binary())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    size = F.octet_length("payload").alias("size")
    equal = rows.select("page_id", "digest", size).where(F.col("size") >= min_bytes).groupBy("digest", "size")
    equal = equal.agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null").select(F.col("digest").alias("of"), "kept")
    rows = rows.join(equal, F.col("digest") == F.col("of"), "left")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    write_blobs(rows.select("page_id", "url", "payload", "digest", refers_to).mapInArrow(run, "file binary"), "file", path, TRAILER)


_ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _records(batches):
    for batch in batches:
        for blob in batch.column(0):
            rows = []
            for head, http, payload in read_archive(blob.as_py()):
                kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
                if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                    raise ValueError(f"the payload of {head['WARC-Record-ID']} is not what its digest says")
                rows.append((_page(head["WARC-Record-ID"]), size, digest, kind, _page(head["WARC-Refers-To"]) if kind == "revisit" else None))
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], [x.split()[0] for x in _ROWS.split(", ")])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the files at path, with every payload checked against its digest."""
    return read_blobs(spark, path).mapInArrow(_records, _ROWS)


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives of pages into the shared folder and return the records read back from them."""
    spark = pages.sparkSession
    bound_batches(spark)
    path = Workspace(spark, "warc").path("archives")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
