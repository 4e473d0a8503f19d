"""Web archives of Zstandard frames: pages to records and back.

An archive starts with a skippable frame that holds the dictionary its records are compressed with, and every
record is a frame of its own, so a reader needs the dictionary and any one frame to get a record. Spark's text
writer makes the files: a row is one archive, and what it writes after a row is an empty skippable frame, which
a decoder passes over. The reader walks from frame to frame by their block headers and checks
sizes, checksums, the fields of a record, its length and its digest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path
from .common import stored

# Payloads of fewer bytes are stored again rather than referred to.
REVISIT_BYTES = 1000
# Compressed bytes after which an archive is closed, and the records its dictionary is trained on.
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Magic numbers of frames, and the profile of a revisit.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


# --- writing ---------------------------------------------------------------------------


def record_name(page_id: int | None, sha1: str) -> str:
    """The id of a record, from which the page can be told; equal rows have equal records."""
    return f"<urn:x-page:{'' if page_id is None else page_id}:{sha1}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The record of one page, without its payload if it refers to another page that has the same."""
    digest = hashlib.sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_name(page_id, digest.hexdigest())), ("WARC-Date", DATE),
        # What no address may hold, line ends above all, is escaped.
        ("WARC-Target-URI", quote(url or f"urn:x-page:{page_id}", safe="!#$%&'()*+,/:;=?@[]~", errors="replace")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest.digest()).decode()),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_name(refers_to, digest.hexdigest()))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode() + block + b"\r\n\r\n"


def skippable(magic: bytes, content: bytes) -> bytes:
    return magic + len(content).to_bytes(4, "little") + content


class _Archive:
    """Frames of one archive; the first records wait until the dictionary is trained on them."""

    def __init__(self):
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.size = 0
        self.frames: list[bytes] = []
        self.compressor = None

    def add(self, raw: bytes) -> None:
        if self.compressor is None:
            self.waiting.append(raw)
            self.waiting_bytes += len(raw)
            if self.waiting_bytes >= SAMPLE_BYTES:
                self.begin()
        else:
            self.put(self.compressor.compress(raw))

    def put(self, frame: bytes) -> None:
        self.frames.append(frame)
        self.size += len(frame)

    def begin(self) -> None:
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting, k=512, d=8)
            plain = trained.as_bytes()
            self.put(skippable(DICTIONARY_MAGIC, zstandard.ZstdCompressor(level=LEVEL).compress(plain)))
            self.compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(plain), **options)
        except zstandard.ZstdError:  # too few or too small records to learn from: an archive without a dictionary
            self.compressor = zstandard.ZstdCompressor(**options)
        for raw in self.waiting:
            self.put(self.compressor.compress(raw))
        self.waiting = []

    def close(self) -> bytes:
        if self.compressor is None:
            self.begin()
        return b"".join(self.frames)


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    archive, any_row = _Archive(), False
    for batch in batches:
        for key, url, html, keep in zip(*(batch.column(c) for c in ("page_id", "url", "html", "keep"))):
            key, keep = key.as_py(), keep.as_py()
            archive.add(record(key, url.as_py(), html.as_buffer().to_pybytes() if html.is_valid else b"", None if keep == key else keep))
            any_row = True
            if archive.size >= ARCHIVE_BYTES:
                yield pa.record_batch([pa.array([archive.close()], pa.binary())], ["archive"])
                archive, any_row = _Archive(), False
    if any_row:
        yield pa.record_batch([pa.array([archive.close()], pa.binary())], ["archive"])


def write_archives(pages: DataFrame, path: str, *, revisit_bytes: int = REVISIT_BYTES) -> None:
    """A record per row of ``pages`` (``page_id``, ``url``, ``html``) in archives under ``path``.

    Of rows with equal payloads of at least ``revisit_bytes`` bytes those with the largest id are responses, all
    of them if they repeat that id; the others revisit it. Rows whose group has no id are responses. The groups are found on
    digests and counts alone; only then do the pages move, and not at all if Spark can send the groups around.
    """
    html = F.col("html").cast("string")
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    long_ = F.octet_length("html") >= revisit_bytes
    keyed = plain.where(long_).select("page_id", F.sha2("html", 256).alias("key"))
    groups = keyed.groupBy("key").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1 and keep is not null").drop("n")
    groups = stored(groups, "equal_pages")
    found = plain.withColumn("key", F.when(long_, F.sha2("html", 256)))
    # Pages too short to be referred to bypass the join, where a null key would gather them.
    joined = found.where("key is not null").join(groups, "key", "left").unionByName(found.where("key is null").withColumn("keep", F.lit(None).cast("long")))
    archives = joined.select("page_id", "url", "html", "keep").mapInArrow(_writer, "archive binary")
    writer = archives.select(F.col("archive").cast("string").alias("value")).write
    writer.option("lineSep", EMPTY_FRAME.decode()).option("maxRecordsPerFile", 1).text(path)


# --- reading ---------------------------------------------------------------------------


class BadRecord(ValueError):
    """What is wrong with a frame or with the record in it."""


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, by its header and the headers of its blocks."""
    head = bytes(data[at : at + 18])
    if head[:4] != FRAME_MAGIC:
        raise BadRecord("not a frame")
    try:
        checksum = zstandard.get_frame_parameters(head).has_checksum
        pos = at + zstandard.frame_header_size(head)
    except zstandard.ZstdError as e:
        raise BadRecord("truncated frame header") from e
    last = False
    while not last:
        block = int.from_bytes(data[pos : pos + 3], "little")
        if pos + 3 > len(data) or block >> 1 & 3 == 3:
            raise BadRecord("broken block")
        last = block & 1
        pos += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
    pos += 4 * checksum
    if pos > len(data):
        raise BadRecord("truncated frame")
    return pos


def frames(data: bytes) -> Iterator[tuple[int, bytes | None, BadRecord | None]]:
    """``(offset, record, error)`` for each frame of an archive; what follows a frame without an end is not looked at."""
    view, at = memoryview(data), 0
    decompressor = zstandard.ZstdDecompressor()
    while at < len(data):
        magic = bytes(view[at : at + 4])
        if magic[1:] == EMPTY_FRAME[1:4] and magic[0] >> 4 == 5:
            end = at + 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            if end > len(data) or at + 8 > len(data):
                yield at, None, BadRecord("truncated skippable frame")
                return
            if at == 0 and magic == DICTIONARY_MAGIC:
                trained = bytes(view[8:end])
                try:
                    if trained[:4] == FRAME_MAGIC:
                        trained = zstandard.ZstdDecompressor().decompressobj().decompress(trained)
                    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
                except zstandard.ZstdError as e:
                    yield at, None, BadRecord(f"dictionary: {e}")
            at = end
            continue
        try:
            end = frame_end(view, at)
        except BadRecord as e:
            yield at, None, e
            return
        try:
            frame = bytes(view[at:end])
            size = zstandard.frame_content_size(frame)
            raw = decompressor.decompressobj().decompress(frame)
            if size >= 0 and len(raw) != size:
                raise BadRecord("content size")
            yield at, raw, None
        except zstandard.ZstdError as e:
            yield at, None, BadRecord(f"frame: {e}")
        except BadRecord as e:
            yield at, None, e
        at = end


def _fields(head: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    name = None
    for line in head.split(b"\r\n"):
        if line[:1] in b" \t" and line and name:  # a folded line goes on
            out[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise BadRecord("field")
        if name in out:
            raise BadRecord(f"repeated {name}")
        out[name] = value.strip()
    return out


def _sha1_of(value: str) -> str:
    """A labelled digest, base 32 or hexadecimal, as hexadecimal digits."""
    label, _, digits = value.partition(":")
    if label.lower() != "sha1":
        raise BadRecord("unknown digest")
    try:
        return (base64.b32decode(digits.upper()) if len(digits) == 32 else bytes.fromhex(digits)).hex()
    except ValueError as e:
        raise BadRecord("unreadable digest") from e


def _page_of(name: str) -> int | None:
    """The page in the id of a record that ``record_name`` made; none for those of others."""
    parts = name.strip("<>").split(":")
    return int(parts[2]) if len(parts) == 4 and parts[:2] == ["urn", "x-page"] and parts[2].lstrip("-").isdigit() else None


def parse_record(raw: bytes) -> dict:
    """The checked fields of one record and its payload."""
    head, blank, block = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version not in VERSIONS or not blank:
        raise BadRecord("version")
    fields = _fields(lines)
    for name in REQUIRED:
        if name not in fields:
            raise BadRecord(f"no {name}")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(block) != int(length) + 4 or block[-4:] != b"\r\n\r\n":
        raise BadRecord("length")
    block, kind = block[:-4], fields["warc-type"]
    if "warc-block-digest" in fields and _sha1_of(fields["warc-block-digest"]) != hashlib.sha1(block).hexdigest():
        raise BadRecord("block digest")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise BadRecord("http header")
        stated = _fields(http.partition(b"\r\n")[2]).get("content-length")
        size = len(payload)
        if kind == "revisit":
            if payload:
                raise BadRecord("revisit with a payload")
            size = int(stated) if stated and stated.isdigit() else None
        elif stated is not None and stated != str(size):
            raise BadRecord("http length")
    digest = _sha1_of(fields["warc-payload-digest"]) if "warc-payload-digest" in fields else None
    if kind == "revisit":
        if digest is None or "warc-refers-to" not in fields:
            raise BadRecord("revisit of nothing")
    else:
        own = hashlib.sha1(payload).hexdigest()
        if digest not in (None, own):
            raise BadRecord("payload digest")
        digest = own
    return {
        "record_type": kind, "record_id": fields["warc-record-id"], "target_uri": fields.get("warc-target-uri"), "page_id": _page_of(fields["warc-record-id"]),
        "refers_to": _page_of(fields.get("warc-refers-to", "")), "payload_bytes": size, "payload_digest": digest, "payload": payload if kind != "revisit" else None,
    }


_RECORD = pa.schema(
    [("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()),
     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())]
)
_RECORD_DDL = (
    "path string, offset long, record_type string, record_id string, target_uri string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)
ROWS_OUT, BYTES_OUT = 2048, 8 << 20


def read_archives(spark: SparkSession, path: str, *, payload: bool = True, strict: bool = False) -> DataFrame:
    """A row per frame of the archives under ``path``: what its record says, where it is, and what is wrong with it.

    ``error`` is null for a sound record; a frame that cannot be decoded or a record that contradicts itself has nothing but
    its place and its error, and ``strict`` makes it fail the job. ``payload=False`` leaves the payloads out, which are
    null for revisits too. An archive is read whole by one task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for offset, raw, error in frames(content.as_buffer()):
                    row = {}
                    try:
                        row = parse_record(raw) if error is None else {}
                    except BadRecord as e:
                        error = e
                    if error is not None and strict:
                        raise BadRecord(f"{error} at {offset} of {name}")
                    if not payload:
                        row.pop("payload", None)
                    rows.append(row | {"path": name, "offset": offset, "error": None if error is None else str(error)})
                    held += len(row.get("payload") or b"")
                    if len(rows) >= ROWS_OUT or held >= BYTES_OUT:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(read, _RECORD_DDL)


def archived_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri)`` per row of ``pages``, read from archives
    of them that are written first.

    Null ``html`` is an empty payload, null or empty ``url`` a name made of the id. Repeated rows are records of
    their own; a null id is below any other and refers to the largest one of its group, if there is one. An
    empty table makes no record. Other columns are not read.
    """
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path)
    found = read_archives(spark, path, payload=False, strict=True)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")
