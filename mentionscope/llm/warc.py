"""WARC archives with a Zstandard dictionary of their own, written and read by Spark tasks.

Every page becomes a WARC/1.1 record in a Zstandard frame of its own. A dictionary is built
from all records of an archive; it stands in the skippable frame that the archive begins with,
and every record is compressed with it, so one record can be read by its offset and length
alone. Of the records with equal payloads of ``REVISIT`` bytes or more, the one with the
largest page_id is a response; the others are revisits, which name it and carry no payload.

Which payloads repeat is found by grouping their digests (combined before the shuffle). The
pages then meet the repeated digests in a left join on the digest, which adaptive execution
splits where one payload holds many rows, and each task writes what it has as archives of at
most ``ARCHIVE`` bytes of records (a longer record is an archive of its own). A task that runs
again writes new files: the index, an ordinary table, names those that count.

Edge cases: null html is an empty payload; rows that share the largest page_id of a payload are
all responses; a null page_id is smaller than any other and comes back as null; a null url is
left out; control characters and others beyond ASCII in urls are percent-encoded; an archive with
too few records for a dictionary has none; an empty table gives no archive and an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, shuffles_removed

REVISIT = 1000              # payloads below so many bytes are never revisits
ARCHIVE = 32 << 20          # bytes of records in an archive
DICTIONARY = 112_640        # bytes of a dictionary
LEVEL = 3

# ---- fixed values: of the WARC and Zstandard formats ---------------------------
SKIPPABLE = 0x184D2A5D      # the skippable frame that holds a dictionary
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# ---- end of fixed values -------------------------------------------------------

_IDS = uuid.UUID("6f0c1f0e-6c1e-5f0b-9a53-2f6f9c3f4a11")
_URL_SAFE = "".join(chr(c) for c in range(0x21, 0x7F))

INDEX = "archive string, offset long, length long, page_id string, record_type string"
RECORD = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, intact boolean"


def record_id(page_id: str | None, url: str | None, digest: str) -> str:
    """The same id for the same page, so a revisit can name a record in any archive."""
    name = f"page:{page_id}" if page_id is not None else f"url:{url}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(_IDS, name)}>"


def header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode()


def record(row: dict, date: str) -> bytes:
    """One response or revisit record of a page, whole."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (row["html"] or b"")
    url = None if row["url"] is None else quote(row["url"], safe=_URL_SAFE)
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", record_id(row["page_id"], url, row["sha1"])),
              ("WARC-Date", date), ("WARC-Target-URI", url),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()),
              ("Page-ID", row["page_id"])]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(row["refers_to"], None, row["sha1"])),
                   ("Refers-To-Page-ID", row["refers_to"])]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return header(fields) + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY):
    """A dictionary built from the records, or None where they are too few for one."""
    import zstandard
    # At most a tenth of the records' bytes: a larger one costs more than it saves.
    size = min(size, sum(map(len, records)) // 10)
    if len(records) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, records, d=8, k=200, f=18, accel=1)
    except zstandard.ZstdError:
        return None


def write_archive(sink, rows: list[dict], records: list[bytes], date: str, name: str) -> Iterator[tuple]:
    """Writes one archive; yields (offset, length, page_id, record_type) of each page's record."""
    import zstandard
    found = dictionary(records)
    options = {"level": LEVEL, "write_content_size": True, "write_checksum": True}
    if found is not None:
        options["dict_data"] = found
    compressor = zstandard.ZstdCompressor(**options)
    at = 0
    if found is not None:
        raw = zstandard.ZstdCompressor(level=19).compress(found.as_bytes())
        at += sink.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
    about = f"format: WARC File Format 1.1\r\nrecords: {len(records)}\r\n".encode()
    info = header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_IDS, name)}>"), ("WARC-Date", date),
                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(about)))])
    at += sink.write(compressor.compress(info + about + b"\r\n\r\n"))
    for row, whole in zip(rows, records, strict=True):
        frame = compressor.compress(whole)
        sink.write(frame)
        yield at, len(frame), row["page_id"], row["record_type"]
        at += len(frame)


def open_archive(source) -> tuple:
    """(decompressor, first bytes read) of an archive that ``source`` stands at the start of."""
    import zstandard
    head = source.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        raw = source.read(struct.unpack("<I", head[4:])[0])
        raw = zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME else raw
        return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw)), b""
    return zstandard.ZstdDecompressor(), head


class _After(io.RawIOBase):
    """What was read ahead, then the rest of a stream."""

    def __init__(self, first: bytes, rest):
        self.first, self.rest = first, rest

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        got = self.first[:len(into)] or self.rest.read(len(into))
        self.first = self.first[len(into):]
        into[:len(got)] = got
        return len(got)


def parse(stream) -> Iterator[tuple[dict, bytes]]:
    """(header fields by lower-case name, block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("record cut short")
        yield fields, block


def read_archive(source) -> Iterator[tuple[dict, bytes]]:
    decompressor, first = open_archive(source)
    frames = decompressor.stream_reader(_After(first, source), read_across_frames=True)
    return parse(io.BufferedReader(frames, 1 << 20))


def read_record(folder: str, archive: str, offset: int, length: int) -> tuple[dict, bytes]:
    """One record by its place in the index, without reading those before it."""
    fs, root = _files(folder)
    with fs.open_input_file(f"{root}/{archive}") as f:
        decompressor, _ = open_archive(f)
        f.seek(offset)
        frame = decompressor.decompress(f.read(length))
    return next(parse(io.BytesIO(frame)))


def page(fields: dict, block: bytes) -> tuple:
    """A row of RECORD: digests of responses are made anew from the payload."""
    told = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if fields["warc-type"] == "response":
        made = hashlib.sha1(payload).hexdigest()
        intact = made == told and len(payload) == size
        size, told = len(payload), made
    else:
        intact = not payload
    return (fields.get("page-id"), fields.get("warc-target-uri"), fields["warc-type"], size, told, fields.get("refers-to-page-id"), intact)


def _files(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder)


def decided(pages: DataFrame, revisit: int = REVISIT) -> DataFrame:
    """``page_id, url, html, payload_bytes, sha1, record_type, refers_to``: the html of revisits is null."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.cast("binary").alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha1(html.cast("binary")).alias("sha1"), F.sha2(html, 256).alias("key"))
    digests = pages.select("page_id", F.octet_length(html).alias("n"), F.sha2(html, 256).alias("key")).where(F.col("n") >= revisit)
    repeated = digests.groupBy("key").agg(F.max("page_id").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    rows = rows.join(repeated, "key", "left").drop("key")
    again = F.col("__first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first"))
    return (rows.withColumn("record_type", F.when(again, "revisit").otherwise("response"))
                .withColumn("refers_to", F.when(again, F.col("__first").cast("string")))
                .withColumn("html", F.when(~again, F.col("html")))
                .withColumn("page_id", F.col("page_id").cast("string")).drop("__first"))


def write(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", archive: int = ARCHIVE) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives under ``folder`` and returns the
    index, a row per record of a page, which is kept in ``folder/index``."""
    def archives(batches):
        import pyarrow as pa
        fs, root = _files(folder)
        fs.create_dir(root, recursive=True)
        kind = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.string()), ("record_type", pa.string())])

        def flushed(rows, records):
            name = f"{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(f"{root}/{name}", compression=None) as sink:
                made = list(write_archive(sink, rows, records, date, name))
            return pa.RecordBatch.from_arrays([pa.array([name] * len(made)), *map(pa.array, zip(*made, strict=True))], schema=kind) if made else None

        rows, records, held = [], [], 0
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(names)}
                whole = record(row, date)
                if records and held + len(whole) > archive:
                    yield flushed(rows, records)
                    rows, records, held = [], [], 0
                rows.append({"page_id": row["page_id"], "record_type": row["record_type"]})
                records.append(whole)
                held += len(whole)
        if records:
            yield flushed(rows, records)

    spark = pages.sparkSession
    with shuffles_removed(spark):
        decided(pages).mapInArrow(archives, INDEX).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record of the archives that the index names, as RECORD."""
    def pages(batches):
        import pyarrow as pa
        fs, root = _files(folder)
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
        names = [c.split()[0] for c in RECORD.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{name}", compression=None) as source:
                    rows = []
                    for fields, block in read_archive(source):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        rows.append(page(fields, block))
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    named = spark.read.parquet(f"{folder}/index").select("archive").distinct()
    # One task per archive, dealt in turn: the names alone would be too few bytes for more than one.
    return named.repartition(max(1, named.count())).mapInArrow(pages, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """The contract's rows: pages written to archives and read back from them."""
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write(pages, folder)
    kind = pages.schema["page_id"].dataType
    return read(pages.sparkSession, folder).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind), "intact")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p),
r AS (SELECT *, strlen(html) >= {REVISIT} AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS again FROM q)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to, true AS intact FROM r
"""
