"""WARC archives in Zstandard (operator 10): writer and reader.

An archive is a ``.warc.zst`` file: a skippable frame (magic 0x184D2A5D) that holds
the dictionary (itself a Zstandard frame), then one frame per record, compressed
with it. The reader loads the dictionary from the leading skippable frame, decodes
one frame at a time and validates frame checksum, version line, required headers,
block length, payload length and payload digest; a bad archive raises ``WarcError``.

``write_archives`` writes one archive per partition. The file name holds the task
attempt, and only archives listed in the manifest (a Spark table, so committed once
per task) exist for readers: retried and speculative attempts leave files that
nobody reads. ``read_archives`` deals the archives out to the tasks and holds one
record in memory at a time.

Payloads of at least ``min_bytes`` that several pages share are stored once, by the
page with the largest id; the others become ``revisit`` records that refer to it.
Equal payloads are found by SHA-1 and length with one aggregate (map-side combine),
whose result (digests that occur twice or more) is joined back.

Cases. Null html: empty payload. Null url: ``urn:page:<id>`` as target. Null page
ids are always responses and read back as null. Rows that repeat the largest id of
a payload are all responses. Line breaks in urls are percent-encoded. Empty table:
no archive, empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uvlens.session import scratch_path

DICT_MAGIC = 0x184D2A5D
DICT_BYTES, SAMPLES, SAMPLE_BYTES = 16_384, 256, 32_768
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive STRING, records BIGINT, bytes BIGINT"
RECORD = ("page_id BIGINT, uri STRING, record_type STRING, refers_to BIGINT, payload_bytes BIGINT, "
          "payload_digest STRING, payload BINARY")


class WarcError(ValueError):
    """An archive that does not hold what its headers say."""


def record_bytes(page_id, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record; ``payload`` is left out of revisits."""
    ident = "" if page_id is None else str(page_id)
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]-._|<>{}^`\" ") if url else f"urn:page:{ident}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (b"" if refers_to is not None else payload)
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{ident}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
            "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Validated fields of one record; raises WarcError."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"no WARC version line: {lines[0][:40]!r}")
    field: dict[str, str] = {}
    for x in lines[1:]:
        name, colon, value = x.partition(":")
        if not colon:
            raise WarcError(f"header without a colon: {x[:80]!r}")
        field[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in field:
            raise WarcError(f"header {name} is missing")
    if not field["content-length"].isdigit():
        raise WarcError("Content-Length is no number")
    size = int(field["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {size}, the block has {len(rest) - 4} bytes")
    http, sep, payload = rest[:size].partition(b"\r\n\r\n")
    sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not sep or not http.startswith(b"HTTP/") or len(sizes) != 1 or not sizes[0].isdigit():
        raise WarcError("no HTTP header block with a Content-Length")
    algorithm, _, digest = field["warc-payload-digest"].partition(":")
    kind, refers = field["warc-type"], field.get("warc-refers-to")
    if algorithm != "sha1" or kind not in ("response", "revisit") or (kind == "revisit") != (refers is not None):
        raise WarcError(f"unexpected record: {kind}, {algorithm}, refers to {refers}")
    if kind == "response" and (len(payload) != int(sizes[0]) or hashlib.sha1(payload).hexdigest() != digest):
        raise WarcError("the payload does not match its length or digest")
    if kind == "revisit" and payload:
        raise WarcError("a revisit record with a payload")

    def page(urn: str) -> int | None:
        if not (urn.startswith("<urn:page:") and urn.endswith(">")):
            raise WarcError(f"unexpected record id: {urn[:80]!r}")
        return int(urn[10:-1]) if urn[10:-1] else None

    return {"page_id": page(field["warc-record-id"]), "uri": field.get("warc-target-uri"), "record_type": kind,
            "refers_to": page(refers) if refers else None, "payload_bytes": int(sizes[0]),
            "payload_digest": digest, "payload": payload if kind == "response" else None}


def dictionary_frame(samples: list[bytes]) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """A dictionary trained on sample records and its leading skippable frame;
    (None, b"") where the samples are too few to train on."""
    if len(samples) < 8:
        return None, b""
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, samples)
    except zstandard.ZstdError:  # too little or too uniform data
        return None, b""
    packed = zstandard.ZstdCompressor(level=9).compress(trained.as_bytes())
    return trained, struct.pack("<II", DICT_MAGIC, len(packed)) + packed


def frames(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time."""
    def exactly(n: int) -> bytes:
        got = b""
        while len(got) < n and (more := stream.read(n - len(got))):
            got += more
        return got

    data, dictionary = exactly(8), None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICT_MAGIC:
        size = struct.unpack("<I", data[4:])[0]
        body = exactly(size)
        if len(body) != size:
            raise WarcError("the dictionary frame is cut off")
        if body[:4] == b"\x28\xb5\x2f\xfd":
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary, data = zstandard.ZstdCompressionDict(body), b""
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        one, parts = decoder.decompressobj(), []
        while True:
            try:
                parts.append(one.decompress(data))
            except zstandard.ZstdError as e:
                raise WarcError(f"a frame cannot be decoded: {e}") from e
            if one.eof:
                data = one.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise WarcError("the last frame is cut off")
        yield b"".join(parts)


def _open(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def classify(pages: DataFrame, min_bytes: int, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, url, payload, size, digest, refers_to of every page."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = (pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
                         payload.alias("payload"))
            .withColumn("size", F.length("payload").cast("bigint")).withColumn("digest", F.sha1("payload")))
    shared = (rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
              .groupBy("digest", "size").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    return (rows.join(shared, ["digest", "size"], "left")
            .withColumn("refers_to", F.expr("CASE WHEN page_id < keeper THEN keeper END")).drop("keeper"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 1000,
                   page_id: str = "page_id", url: str = "url", html: str = "html",
                   date: str = "2024-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write one archive per partition below ``folder`` (default: a fresh one in
    the shared checkpoint folder); returns the manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "llm-warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/{context.partitionId():05d}-{context.taskAttemptId()}.warc.zst"
        out, count, size, packer = None, 0, 0, None
        for batch in batches:
            rows = batch.to_pylist()
            if packer is None and rows:
                fs, path = _open(name)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path, compression=None)  # or it would pack ".zst" again
                trained, lead = dictionary_frame(
                    [record_bytes(r["page_id"], r["url"], r["payload"][:SAMPLE_BYTES], r["size"], r["digest"],
                                  r["refers_to"], date) for r in rows[:SAMPLES]])
                kind = {"dict_data": trained} if trained else {}
                packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **kind)
                out.write(lead)
                size = len(lead)
            for r in rows:
                frame = packer.compress(record_bytes(r["page_id"], r["url"], r["payload"], r["size"], r["digest"],
                                                     r["refers_to"], date))
                out.write(frame)
                count, size = count + 1, size + len(frame)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [count], "bytes": [size]})

    manifest = scratch_path(spark, "llm-warc-manifest")
    classify(pages, min_bytes, page_id, url, html).mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The validated records of all archives of a manifest. Archives that hold
    another number of records than the manifest says raise WarcError."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = _open(row["archive"])
                rows, held, seen = [], 0, 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for raw in frames(stream):
                        r = parse_record(raw)
                        seen += 1
                        if not with_payload:
                            r["payload"] = None
                        rows.append(r)
                        held += len(r["payload"] or b"") + 200
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if seen != row["records"]:
                    raise WarcError(f"{path}: {seen} records, the manifest has {row['records']}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(read, RECORD)
