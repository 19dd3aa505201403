"""Web pages as WARC archives with a Zstandard dictionary, and back.

An archive is a ``.warc.zst`` stream: a leading skippable frame (``DICTIONARY``) holds the dictionary, compressed, which was built from the
archive's own first records; then every record is a frame of its own with a checksum. A frame is followed by an empty skippable
frame, which readers pass over. The text writer puts it there as its line end: Spark writes the archives, so a task that runs again after the loss
of an executor leaves no half archive, and any store will do. A task starts a new archive (``archive=n/part-*``) after ``ARCHIVE`` bytes of
records, so a reader, which takes an archive as one row, stays within bounds; only a record that is larger makes a larger one.

Of pages with equal payloads of at least ``LEAST`` bytes the one with the smallest (page_id, url) is archived as ``response``, the others as
``revisit`` without payload. Equal means equal SHA-256. Pages meet their first by a join on the digest, whose hot values Spark splits.

Defined results: null ``html`` is an empty payload; a null ``page_id`` is never a first, and a group of null ids only is all response; rows that
repeat the first's (page_id, url) are response as well; a null ``url`` gets a ``urn:``; blanks and control characters of a url are written as %XX; an empty
table gives no archive and no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm.blocks import slices

LEAST = 100
ARCHIVE = 64 << 20
SAMPLE = 4 << 20
LARGEST = 112 << 10
LEVEL = 3
#: Values fixed by the formats: magic numbers of frames, and the profile of a revisit.
DICTIONARY = b"\x5d\x2a\x4d\x18"
FRAME = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_SPACE = uuid.UUID("6f1d6a0e-3c0b-5b0e-9a57-0d3c6b1f2a11")
_STEP = 4 << 20


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, and first_id, first_url of the page that a revisit refers to (null: response)."""
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.expr("X''"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    known = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    firsts = (
        rows.where(F.octet_length("payload") >= LEAST).groupBy(F.col("digest").alias("_digest"))
        .agg(F.min(known).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _first is not null")
    )
    other = ~(F.col("page_id").eqNullSafe(F.col("_first.page_id")) & F.col("url").eqNullSafe(F.col("_first.url")))
    revisit = F.col("_first").isNotNull() & other
    return rows.join(firsts, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("_first.page_id")).alias("first_id"), F.when(revisit, F.col("_first.url")).alias("first_url"))


def _target(page_id: int | None, url: str | None) -> str:
    if url is None:
        return f"urn:x-page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {_target(page_id, url)} {digest}')}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, first_id: int | None, first_url: str | None, date: str) -> bytes:
    """A page's record; without payload a revisit of the first page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    own = [] if page_id is None else [("X-Page-ID", page_id)]
    fields = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", _record_id(page_id, url, digest)), ("WARC-Date", date),
              ("WARC-Target-URI", _target(page_id, url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response"), *own]
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first_id, first_url, digest)), ("WARC-Refers-To-Target-URI", _target(first_id, first_url)),
                   ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-ID", first_id)]
    return _record(fields, http + (payload or b""))


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """From at most ``SAMPLE`` bytes and one record; a sixteenth of them, at most ``LARGEST``. Where too little repeats, plain content."""
    size = min(LARGEST, max(1024, sum(map(len, records)) // 16))
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(r[:size] for r in records)[-size:].rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """Frames of one archive in their order."""

    def __init__(self):
        self.size, self.waiting, self.compressor = 0, [], None

    def add(self, one: bytes) -> list[bytes]:
        self.size += len(one)
        if self.compressor:
            return [self.compressor.compress(one)]
        self.waiting.append(one)
        return self.begin() if self.size >= SAMPLE else []

    def begin(self) -> list[bytes]:
        """The dictionary and the records that waited for it; also called at the end of a small archive."""
        if self.compressor or not self.waiting:
            return []
        dictionary = build_dictionary(self.waiting)
        held = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        waiting, self.waiting = self.waiting, []
        return [DICTIONARY + len(held).to_bytes(4, "little") + held, *map(self.compressor.compress, waiting)]


def _archived(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    number, seq, archive, out, held = 0, 0, Archive(), [], 0

    def batch():
        nonlocal out, held, seq
        made = pa.RecordBatch.from_arrays([pa.array([number] * len(out), pa.int32()), pa.array(range(seq, seq + len(out)), pa.int64()), pa.array(out, pa.binary())], ["archive", "seq", "frame"])
        seq, out, held = seq + len(out), [], 0
        return made

    for given in slices(batches, 500):
        for row in given.to_pylist():
            frames = archive.add(record(**row, date=date))
            out += frames
            held += sum(map(len, frames))
            if archive.size >= ARCHIVE:
                out += archive.begin()
                yield batch()
                number, seq, archive = number + 1, 0, Archive()
            elif held >= _STEP:
                yield batch()
    out += archive.begin()
    yield batch()


def write(pages: DataFrame, folder: str, date: dt.datetime | None = None) -> None:
    """Archives of all pages (page_id, url, html) under ``folder``; ``date`` is when they were fetched, now if not given."""
    stamp = (date or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    frames = decided(pages).mapInArrow(lambda batches: _archived(batches, stamp), "archive int, seq long, frame binary")
    # Bytes that are no UTF-8 pass through the cast and the writer as they are. The sort, which moves no row to another task, is the order of the files.
    ordered = frames.sortWithinPartitions("archive", "seq").select("archive", F.col("frame").cast("string").alias("frame"))
    ordered.write.partitionBy("archive").option("lineSep", EMPTY_FRAME).text(folder)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from the sizes of its blocks."""
    checksum = data[at + 4] & 4
    at += zstandard.frame_header_size(data[at : at + 18])
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + (4 if checksum else 0)


def records(content: bytes) -> Iterator[bytes]:
    """Records of one archive."""
    data, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = bytes(data[at : at + 4])
        if magic[1:] == DICTIONARY[1:] and magic[0] >> 4 == 5:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if magic == DICTIONARY and at == 0:
                held = bytes(data[8:end])
                held = zstandard.ZstdDecompressor().decompress(held) if held[:4] == FRAME else held
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
        elif magic == FRAME:
            end = _frame_end(data, at)
            yield reader.decompressobj().decompress(data[at:end])
        else:
            raise ValueError(f"no frame at byte {at}")
        if end > len(data):
            raise ValueError(f"the frame at byte {at} is cut off")
        at = end


def parsed(one: bytes) -> dict:
    """What a record of :func:`record` says; raises where a length or a digest is wrong."""
    head, _, rest = one.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError("no whole record")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
    return {"page_id": number["X-Page-ID"], "target_uri": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number["X-Refers-To-Page-ID"], "payload": payload if kind == "response" else None}


_TYPES = {"page_id": pa.int64(), "target_uri": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
          "payload": pa.binary()}


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to and, if asked for, payload (null for revisits)."""
    types = {k: t for k, t in _TYPES.items() if payloads or k != "payload"}

    def run(batches):
        for batch in slices(batches, 1):
            out, held = [], 0
            for one in records(batch.column("content")[0].as_py()):
                out.append(parsed(one))
                held += len(one)
                if len(out) == 5000 or held >= _STEP:
                    yield pa.RecordBatch.from_pylist(out, pa.schema(types))
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, pa.schema(types))

    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where("length > 0").select("content")
    return archives.mapInArrow(run, "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads)
