"""WARC archives in Zstandard frames: a writer and a validating reader.

An archive starts with a skippable frame that holds the dictionary; every record is a
frame of its own, compressed with it.  Spark's text writer puts the frames into files: it
writes the bytes of a value as they are, and the separator that it puts after each value is
an empty skippable frame, which every reader passes over.  So archives can be written to
and read from any storage that Spark reaches.

The reader loads the dictionary from the leading frame, decodes one frame per record and
checks the WARC and HTTP headers, all lengths and the payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidegauge.llm import wordhash as W
from tidegauge.llm.tables import ship
from tidegauge.session import fresh_path

# Frame magics of the Zstandard format, and the dictionary frame of WARC.
_FRAME, _SKIPPABLE, _DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
_SEPARATOR = struct.pack("<II", _SKIPPABLE, 0).decode("latin-1")

#: Bytes of compressed records after which a task starts another archive.
ARCHIVE_BYTES = 16 * 2**20
#: The dictionary is trained on about so many pages, drawn at random, and so many characters of each.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 800, 4096, 32 * 1024
LEVEL = 3

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class InvalidArchive(ValueError):
    """An archive that breaks its format."""


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the records; empty if the samples are too few to train one."""
    samples = [s for s in samples if s]
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(page_id: int | None, url: str, payload: bytes, sha1: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}/{url}")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """``(magic, start, end)`` of every frame; for skippable frames, of their content."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise InvalidArchive(f"a frame is cut off at byte {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == _SKIPPABLE:
            end = at + 8 + size
            if end > len(data):
                raise InvalidArchive(f"a skippable frame is cut off at byte {at}")
            yield magic, at + 8, end
        elif magic == _FRAME:
            end = at + zstandard.frame_header_size(data[at : at + 18])
            last = False
            while not last:
                if end + 3 > len(data):
                    raise InvalidArchive(f"a frame is cut off at byte {at}")
                header = int.from_bytes(data[end : end + 3], "little")
                last, kind, length = bool(header & 1), header >> 1 & 3, header >> 3
                end += 3 + (1 if kind == 1 else length)
            end += 4 if data[at + 4] & 4 else 0  # checksum
            if end > len(data):
                raise InvalidArchive(f"a frame is cut off at byte {at}")
            yield magic, at, end
        else:
            raise InvalidArchive(f"no frame at byte {at}")
        at = end


def _headers(raw: bytes, first: str) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith(first):
        raise InvalidArchive(f"a header starts with {lines[0][:40]!r}")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise InvalidArchive(f"a header line without a colon: {line[:40]!r}")
        out[name.strip().lower()] = value.strip()
    return out


_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest")


def parse(raw: bytes) -> dict:
    """A checked record: ids, type, digest, length, payload (``None`` for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head, "WARC/1.1")
    if missing := [n for n in _NEEDED if n not in fields]:
        raise InvalidArchive(f"a record lacks {', '.join(missing)}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise InvalidArchive(f"a block of {len(rest) - 4} bytes is announced as {length}")
    block = rest[:length]
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _headers(head, "HTTP/1.1 ")
    announced, sha1 = int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != announced:
            raise InvalidArchive(f"a payload of {len(payload)} bytes is announced as {announced}")
        if digest(payload) != sha1:
            raise InvalidArchive("a payload does not match its digest")
    elif kind != "revisit" or payload or fields.get("warc-profile") != PROFILE:
        raise InvalidArchive(f"a record of type {kind} is not understood")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return {
        "page_id": None if page is None else int(page), "url": fields.get("warc-target-uri"), "payload_bytes": announced,
        "payload_digest": sha1, "record_type": kind, "refers_to": None if refers is None else int(refers),
        "payload": payload if kind == "response" else None,
    }


def records(data: bytes) -> Iterator[dict]:
    """The checked records of one archive."""
    unpack, started = zstandard.ZstdDecompressor(), False
    for magic, start, end in frames(data):
        if magic == _DICTIONARY and not started:
            if end > start:
                unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[start:end]))
        elif magic == _FRAME:
            yield parse(unpack.decompress(data[start:end]))
        started = True


def _decided(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Pages with digest, record type and reference.

    Only groups of equal payloads are joined back; a payload that a large share of the
    pages has is an aggregate and a skewed join.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        payload.alias("html"), F.octet_length(payload).cast("long").alias("size"), F.sha1(payload.cast("binary")).alias("sha1"),
    )
    shared = (
        rows.filter(F.col("size") >= least).groupBy("sha1", "size")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("top")).filter("n > 1").select("sha1", "size", "top")
    )
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.join(shared, ["sha1", "size"], "left").select(
        "page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("kind"),
        F.when(again, F.col("top")).alias("refers_to"),
    )


def _writing(dictionary: bytes, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        lead = struct.pack("<II", _DICTIONARY, len(dictionary)) + dictionary
        task, number, written, place = TaskContext.get().partitionId(), 0, 0, 0
        for whole in batches:
            _, offsets = W.text_buffers(whole.column("html"))
            for first, end in W.slices(offsets):
                out: list[tuple[str, int, bytes]] = []
                for row in whole.slice(first, end - first).to_pylist():
                    if written == 0 or written > archive_bytes:
                        number, written, place = number + 1, len(lead), 1
                        out.append((f"{task:06d}-{number:04d}", 0, lead))
                    body = row["html"].encode("utf-8")
                    url = row["url"].replace("\r", "%0D").replace("\n", "%0A")
                    frame = packer.compress(record(row["page_id"], url, body, digest(body), row["kind"], row["refers_to"], date))
                    out.append((f"{task:06d}-{number:04d}", place, frame))
                    written, place = written + len(frame), place + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary()))], ["archive", "place", "frame"]
                )

    return run


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    revisit_min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per page to Zstandard archives under ``path``.

    Of the pages with equal payloads of at least ``revisit_min_bytes``, those with the
    largest id are responses and the others revisit them; all others are responses.  A
    null page is an empty payload, a null URL an empty one; null ids count as smaller
    than all others, and a group without any id has responses only.
    """
    spark = pages.sparkSession
    ship(spark)
    # Rows drawn in their tasks: what reaches the driver does not grow with the table.
    share = min(1.0, SAMPLE_PAGES / max(pages.count(), 1))
    sample = (
        pages.select(F.substring(F.col(html).cast("string"), 1, SAMPLE_CHARS).alias("s"))
        .filter(F.rand(7) < share).limit(2 * SAMPLE_PAGES).collect()
    )
    dictionary = train_dictionary([r.s.encode("utf-8") for r in sample if r.s])
    packed = _decided(pages, page_id, url, html, revisit_min_bytes).mapInArrow(
        _writing(dictionary, date, archive_bytes), "archive string, place long, frame binary"
    )
    (
        packed.sortWithinPartitions("archive", "place").select("archive", F.col("frame").cast("string").alias("value"))
        .write.partitionBy("archive").option("lineSep", _SEPARATOR).option("compression", "none").text(path)
    )


_RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def _reading(with_payload: bool):
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in rows], t) for n, t in kinds.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for content in whole.column("content"):
                rows, size = [], 0
                for row in records(content.as_py()):
                    size += row["payload_bytes"]
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row)
                    if len(rows) >= 2000 or size > 4 * 2**20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under ``path``; an archive that breaks its format fails the job."""
    ship(spark)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    )
    return files.select("content").mapInArrow(_reading(with_payload), _RECORD)


def round_trip(pages: DataFrame, revisit_min_bytes: int = 0) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, revisit_min_bytes=revisit_min_bytes)
    return read_archives(pages.sparkSession, path, with_payload=False)
