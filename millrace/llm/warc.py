"""WARC archives: a writer with revisit records and a reader that splits files by byte range.

An archive file is a sequence of gzip members, one per record. A reading task gets a range
of bytes, looks for the gzip magic, takes a place for a record if the bytes there inflate to
a WARC header, and owns the records that start inside its range, also where they end beyond
it. Records found must then fill their file from its first to its last byte; where they do
not, because a payload holds bytes that look like a record or because bytes are damaged, the
file is read again from its start.

Tasks reach the files through ``pyarrow.fs`` by full URI (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import salted, saved
from millrace.session import path_exists

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
GZIP_MAGIC = b"\x1f\x8b\x08"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_BLOCK = "application/http; msgtype=response"

DATE = "1970-01-01T00:00:00Z"
SPLIT_BYTES = 64 << 20
FILE_BYTES = 1 << 30
#: A record's header has to end within so many bytes.
HEADER_BYTES = 1 << 20
PIECE, SMALL, WINDOW = 1 << 14, 1 << 5, 1 << 20
BATCH_RECORDS, BATCH_BYTES = 2000, 16 << 20

_URN = "urn:record:"
_INDEX = (
    "file string, offset long, length long, record_type string, record_id string, target_uri string, date string, "
    "refers_to string, declared_digest string, payload_bytes long, payload_digest string, damaged boolean"
)


def open_folder(uri: str):
    """The file system and path of a URI, as tasks see them."""
    from pyarrow.fs import FileSystem

    if uri.startswith("file:"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# --- records -----------------------------------------------------------------


def record_urn(key: object) -> str:
    """A record id for a key: ``none`` for null, else the key's text, escaped."""
    return f"<{_URN}none>" if key is None else f"<{_URN}k-{quote(str(key), safe='')}>"


def urn_key(urn: str | None) -> str | None:
    """The key that ``record_urn`` was given, as text; None for null and foreign ids."""
    start = f"<{_URN}k-"
    return unquote(urn[len(start) : -1]) if urn and urn.startswith(start) else None


def _member(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields if value is not None)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head + block + b"\r\n\r\n") + press.flush()


def info_record(date: str = DATE) -> bytes:
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
    return _member([*fields, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")


def page_record(key: object, url: str | None, payload: bytes, digest: str, refers_to: object, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_urn(key)),
        ("WARC-Target-URI", None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Date", date),
        ("WARC-Profile", SAME_PAYLOAD if revisit else None),
        ("WARC-Refers-To", record_urn(refers_to) if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{base32}"),
        ("Content-Type", HTTP_BLOCK),
    ]
    return _member(fields, http if revisit else http + payload)


def parse_header(head: bytes) -> dict[str, str] | None:
    """Fields by lower-case name; None unless it is a WARC header with a length."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    fields: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:  # a folded line goes on with the field before it
            fields[name] = f"{fields[name]} {line.strip()}".strip()
            continue
        label, colon, value = line.partition(":")
        if colon:
            name = label.strip().lower()
            fields.setdefault(name, value.strip())
    return fields if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def hex_digest(declared: str | None) -> str | None:
    """A declared SHA-1 (base32 or hex) as lower-case hex; None for another algorithm."""
    kind, _, value = (declared or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


# --- reading one range -------------------------------------------------------


class Window:
    """A file read forward in large pieces, with small steps back."""

    def __init__(self, file, size: int) -> None:
        self._file, self.size = file, size
        self._start, self._data = 0, b""

    def at(self, offset: int, length: int) -> bytes:
        """Up to ``length`` bytes from ``offset``."""
        length = min(length, self.size - offset)
        if length <= 0:
            return b""
        if not self._start <= offset <= offset + length <= self._start + len(self._data):
            self._file.seek(offset)
            self._start, self._data = offset, self._file.read(max(length, min(WINDOW, self.size - offset)))
        return self._data[offset - self._start : offset - self._start + length]

    def find(self, mark: bytes, offset: int, end: int) -> int:
        """First place of ``mark`` that starts in [offset, end), or -1."""
        while offset < end and self.at(offset, len(mark)):
            last = min(len(self._data), end - self._start + len(mark) - 1)
            found = self._data.find(mark, offset - self._start, last)
            if found >= 0:
                return self._start + found
            offset = max(offset + 1, self._start + len(self._data) - len(mark) + 1)
        return -1


def inflated(window: Window, offset: int, step: int = PIECE) -> Iterator[tuple[bytes, int | None]]:
    """Pieces of the member at ``offset``, read ``step`` bytes at a time; the last comes with the member's end.

    Raises ``zlib.error`` for bytes that are no gzip member or one that is cut off.
    """
    inflate, at = zlib.decompressobj(31), offset
    while not inflate.eof:
        piece = window.at(at, step)
        at += len(piece)
        out = inflate.decompress(piece, PIECE)
        if not (piece or out or inflate.eof):
            raise zlib.error("the member is cut off")
        while not inflate.eof and inflate.unconsumed_tail:
            yield out, None
            out = inflate.decompress(inflate.unconsumed_tail, PIECE)
        yield out, at - len(inflate.unused_data) if inflate.eof else None


class Body:
    """Takes a record's block piece by piece: its payload's size and digest, and if asked the payload."""

    def __init__(self, fields: dict[str, str], keep: bool) -> None:
        kind = fields.get("content-type", "").lower()
        self._left = int(fields["content-length"])
        self._http = b"" if kind.startswith("application/http") else None
        self._keep: list[bytes] | None = [] if keep else None
        self.size, self._sha = 0, hashlib.sha1()

    def add(self, piece: bytes) -> None:
        piece = piece[: self._left]
        self._left -= len(piece)
        if self._http is not None:  # the payload starts after the HTTP header
            self._http += piece
            end = self._http.find(b"\r\n\r\n")
            if end < 0 and len(self._http) <= HEADER_BYTES and self._left:
                return
            piece, self._http = self._http[end + 4 if end >= 0 else 0 :], None  # without a header all is payload
        self.size += len(piece)
        self._sha.update(piece)
        if self._keep is not None:
            self._keep.append(piece)

    @property
    def whole(self) -> bool:
        return self._left == 0

    def result(self) -> tuple[int, str, bytes | None]:
        return self.size, self._sha.hexdigest(), None if self._keep is None else b"".join(self._keep)


def record_at(
    window: Window, offset: int, keep: bool, step: int = PIECE
) -> tuple[dict[str, str], int, Body, bool] | None:
    """Header, end, block and damage of the record at ``offset``; None if there is none."""
    head, fields, body, end = b"", None, None, None
    try:
        for piece, end in inflated(window, offset, step):
            if fields is None:
                head += piece
                if not b"WARC/".startswith(head[:5]):
                    return None
                cut = head.find(b"\r\n\r\n")
                if cut < 0:
                    if len(head) > HEADER_BYTES:
                        return None
                    continue
                fields = parse_header(head[:cut])
                if fields is None:
                    return None
                body, piece = Body(fields, keep), head[cut + 4 :]
            body.add(piece)
    except zlib.error:
        if fields is not None:
            return fields, offset + len(GZIP_MAGIC), body, True
        # A short record that breaks in its first piece may still show a header in small steps.
        return record_at(window, offset, keep, SMALL) if step > SMALL else None
    return None if fields is None else (fields, end, body, not body.whole)


def records(window: Window, start: int, end: int, keep: bool = False) -> Iterator[tuple]:
    """Records that start in [start, end): offset, length, header, block, damage.

    After a damaged record the search goes on right behind its magic.
    """
    at = start
    while (at := window.find(GZIP_MAGIC, at, end)) >= 0:
        found = record_at(window, at, keep)
        if found is None:
            at += 1
            continue
        fields, after, body, damaged = found
        yield at, after - at, fields, body, damaged
        at = after


# --- reading with Spark ------------------------------------------------------


def _read_ranges(ranges: DataFrame) -> DataFrame:
    """The index rows of the records that start in each (file, size, start, end)."""
    names = [part.split()[0] for part in _INDEX.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[part.split()[1]]) for n, part in zip(names, _INDEX.split(", "), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = open_folder(row["file"])
                with fs.open_input_file(path) as file:
                    out = []
                    for at, length, fields, body, damaged in records(Window(file, row["size"]), row["start"], row["end"]):
                        size, digest, _ = body.result()
                        head = [fields.get(n) for n in ("warc-type", "warc-record-id", "warc-target-uri", "warc-date")]
                        more = [fields.get("warc-refers-to"), hex_digest(fields.get("warc-payload-digest"))]
                        facts = [None, None] if damaged else [size, digest]
                        out.append([row["file"], at, length, *head, *more, *facts, damaged])
                        if len(out) == BATCH_RECORDS:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)
                            out = []
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)

    return ranges.select("file", "size", "start", "end").mapInArrow(run, _INDEX)


def _spread(ranges: DataFrame, tasks: int) -> DataFrame:
    """One task for a few ranges, so that a lost one is read again in little time."""
    return ranges.repartition(tasks, F.xxhash64("file", "start"))


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file`` and ``size`` of an archive: its list of written files, else all ``*.warc.gz`` below the folder."""
    if path_exists(spark, f"{folder}/_files"):
        return spark.read.schema("file string, size long, records long").parquet(f"{folder}/_files").select("file", "size")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", True)
    return found.load(folder).select(F.col("path").alias("file"), F.col("length").alias("size"))


def read_warc(spark: SparkSession, folder: str, *, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of an archive, one row each, read by byte ranges of ``split_bytes``.

    ``offset`` and ``length`` are those of the gzip member in its ``file``. ``payload_bytes``
    and ``payload_digest`` are taken from the decoded payload (of an HTTP block, what follows
    its header), ``declared_digest`` is the SHA-1 that the header
    names, both in lower-case hex. A record cut off or broken is
    marked ``damaged``, has no size or digest, and the search goes on behind it. Bytes between
    records are skipped. An archive without files or with empty ones gives no rows.
    """
    files = archive_files(spark, folder)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.where("size > 0").select("file", "size", starts.alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, F.col("size")))
    tasks = max(1, ranges.count())
    index = saved(_read_ranges(_spread(ranges, tasks)), "warc_index")
    filled = index.groupBy("file").agg(F.sum("length").alias("filled"))
    again = files.join(filled, "file", "left").where("size > 0 AND size != coalesce(filled, 0)").select("file", "size")
    if again.isEmpty():
        return index
    whole = again.select("file", "size", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
    reread = _read_ranges(_spread(whole, tasks))
    return saved(index.join(again, "file", "left_anti").unionByName(reread), "warc_index")


def with_payloads(index: DataFrame) -> DataFrame:
    """Adds the decoded ``payload`` to rows of ``read_warc``; null for a damaged record."""
    schema = index.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for batch in batches:
            first, held, out = 0, 0, []
            for k, (uri, offset, length) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                if uri != name:
                    if opened is not None:
                        opened.close()
                    fs, path = open_folder(uri)
                    opened, name = fs.open_input_file(path), uri
                    window = Window(opened, opened.size())
                found = record_at(window, offset, True)
                out.append(None if found is None or found[3] else found[2].result()[2])
                held += len(out[-1] or b"")
                if held >= BATCH_BYTES or k == batch.num_rows - 1:
                    part = batch.slice(first, len(out))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*part.schema.names, "payload"])
                    first, held, out = k + 1, 0, []
        if opened is not None:
            opened.close()

    return index.mapInArrow(run, f"{schema}, payload binary")


# --- writing with Spark ------------------------------------------------------


def _write_rows(pages: DataFrame, folder: str, date: str, file_bytes: int) -> DataFrame:
    """Write the records of each task to files of its own; a row per finished file."""
    kinds = pa.schema([("file", pa.string()), ("size", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        out, name, size, count = None, None, 0, 0

        def finished() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "size": size, "records": count}], kinds)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(base, recursive=True)
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    size += out.write(info_record(date))
                record = page_record(
                    row["key"], row["url"], row["payload"], row["digest"], row["head"], row["revisit"], date
                )
                size, count = size + out.write(record), count + 1
                if size >= file_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    return pages.mapInArrow(run, "file string, size long, records long")


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 1000,
    date: str = DATE,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a record per row below ``folder``, which must be a full URI of shared storage.

    Of rows with equal payloads of ``least_bytes`` and more, those with the largest key become
    response records and the others revisit records that refer to it without the payload.
    Smaller payloads are written whole each time. Rows with a null key follow a known key of
    the same payload; without one they are responses. A null payload is an empty one.

    Each task writes files of its own under new names. Only files of finished tasks are
    listed in ``_files``, so what a lost or repeated task leaves behind is never read.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b"").cast("binary"))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns(
        {
            "digest": F.sha1("payload"),
            "large": F.octet_length("payload") >= least_bytes,
            "_salt": F.pmod(F.xxhash64("key", "url"), F.lit(salts)).cast("int"),
        }
    )
    heads = salted(rows.where("large").select("key", "digest", "_salt"), ["digest"], F.max("key").alias("head"))
    joined = rows.join(heads.withColumn("large", F.lit(True)), ["digest", "large", "_salt"], "left")
    revisit = F.col("head").isNotNull() & ~F.coalesce(F.col("key") == F.col("head"), F.lit(False))
    written = joined.select("key", "url", "payload", "digest", "head", revisit.alias("revisit"))
    _write_rows(written, folder, date, file_bytes).write.mode("errorifexists").parquet(f"{folder}/_files")


def archived_pages(index: DataFrame, key_type: str = "bigint") -> DataFrame:
    """What an archive says of each page: one row per response and revisit record.

    Returns ``key``, ``record_type``, ``payload_bytes``, ``payload_digest`` and ``refers_to``
    (a key). Size and digest of a revisit are those of the payload it stands for, taken from
    the response that it refers to: one with that id whose decoded payload has the digest
    that the revisit declares. They are null where there is none, and for damaged records.
    """
    salts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def key_of(urn: str) -> Column:
        start = f"<{_URN}k-"
        text = F.expr(f"url_decode(substring({urn}, {len(start) + 1}, length({urn}) - {len(start) + 1}))")
        return F.when(F.col(urn).startswith(start), text).cast(key_type)

    pages = index.where("record_type IN ('response', 'revisit')").select(
        key_of("record_id").alias("key"), "record_type", "record_id", "payload_bytes", "payload_digest", "declared_digest",
        F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"),
        F.pmod(F.xxhash64("file", "offset"), F.lit(salts)).cast("int").alias("_salt"),
    )
    columns = ["key", "record_type", "payload_bytes", "payload_digest", key_of("refers_to").alias("refers_to")]
    responses, revisits = pages.where("record_type = 'response'"), pages.where("record_type = 'revisit'")
    known = responses.groupBy(F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("declared_digest"))
    known = known.agg(F.max("payload_bytes").alias("known_bytes"))
    asked = revisits.groupBy("refers_to", "declared_digest").agg(F.collect_set("_salt").alias("_salts"))
    answers = asked.join(known, ["refers_to", "declared_digest"]).withColumn("_salt", F.explode("_salts")).drop("_salts")
    resolved = revisits.join(answers, ["refers_to", "declared_digest", "_salt"], "left").withColumns(
        {
            "payload_bytes": F.col("known_bytes"),
            "payload_digest": F.when(F.col("known_bytes").isNotNull(), F.col("declared_digest")),
        }
    )
    return responses.select(*columns).unionByName(resolved.select(*columns))
