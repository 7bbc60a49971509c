"""Web archive files: a writer, and a reader that salvages what is left of damaged files.

``write_archives`` gives each task's records their own gzip members in files of bounded size. A file's name holds the attempt,
and only files in the written manifest count, so a lost executor or a second attempt leaves nothing behind that is read.

``read_archives`` reads files in splits. A record is accepted only if its member inflates with a good checksum, its version
line and header are well formed, its block has the stated length and, for responses, the payload has the stated
digest. After a failed check the search goes on from the next byte for a gzip member or a version line
that passes all checks. Extents of accepted records are sorted per file and the bytes between them are the
quarantined gaps. Compressed files are searched from the start of each split; files of plain records are one split, since text
that looks like a record may stand inside of one.

Defined cases: a null payload is written as an empty one; rows with a null page_id are records without an id of their own (url
only) and never refer to others; repeated rows are repeated records; no rows give no files and no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.llm.tables import maybe_broadcast, written
from palaver.session import scratch_dir

#: Payloads of at least so many bytes are stored once; compressed bytes of a file; bytes of a split; bytes read at once.
REVISIT_BYTES, FILE_BYTES, SPLIT_BYTES, READ_BYTES = 1000, 64 << 20, 16 << 20, 1 << 20
#: Bytes first read of a plain record; longer headers and blocks are read on.
HEAD_BYTES = 1 << 16
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, length long, record_type string, page_id long, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to long, payload binary"
)


def _filesystem(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path else re.sub(r"^(file:)?/*", "file:///", path, count=1))


def record(kind: str, page_id, url, payload: bytes, digest: str, payload_bytes: int, refers_to) -> bytes:
    """The bytes of one record; a revisit has no block."""
    block = payload if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{url}/{digest}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"[\r\n]", "", url or "")),
        ("Content-Type", "text/html; charset=utf-8"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Bytes", payload_bytes),
        ("X-Page-ID", "" if page_id is None else page_id),
        ("X-Refers-To-Page-ID", "" if refers_to is None else refers_to),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, compress: bool):
    def run(batches):
        context = TaskContext.get()
        store, root = _filesystem(folder)
        store.create_dir(root, recursive=True)
        done, stream, name, count, size = [], None, None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                raw = record(row["kind"], row["page_id"], row["url"], row["payload"], row["digest"], row["bytes"], row["refers_to"])
                if compress:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    raw = packer.compress(raw) + packer.flush()
                if stream is None:
                    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{len(done):04d}.warc{'.gz' * compress}"
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                stream.write(raw)
                count, size = count + 1, size + len(raw)
                if size >= FILE_BYTES:
                    stream.close()
                    done.append((f"{folder}/{name}", count, size))
                    stream, count, size = None, 0, 0
        if stream is not None:
            stream.close()
            done.append((f"{folder}/{name}", count, size))
        kinds = (pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*done, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, folder: str | None = None, compress: bool = True, payload_col: str = "html") -> DataFrame:
    """Writes a record per row (page_id, url, payload) and returns the manifest: path, records, bytes."""
    folder = folder or scratch_dir(pages.sparkSession, "archives")
    payload = F.coalesce(F.encode(F.col(payload_col), "utf-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    large = rows.filter((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    shared = large.groupBy("digest", "bytes").agg(F.max("page_id").alias("last_id"), F.min("page_id").alias("first_id"))
    shared = written(shared.filter("last_id > first_id").select("digest", "bytes", "last_id"), "payload-classes")
    rows = rows.join(maybe_broadcast(shared, shared.count()), ["digest", "bytes"], "left")
    again = F.coalesce(F.col("page_id") < F.col("last_id"), F.lit(False))
    rows = rows.select(
        F.when(again, "revisit").otherwise("response").alias("kind"), "page_id", "url",
        F.when(~again, F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "digest", "bytes",
        F.when(again, F.col("last_id")).alias("refers_to"),
    )
    return written(rows.mapInArrow(_writer(folder, compress), MANIFEST), "manifest")


def _header(raw: bytes) -> tuple[dict | None, int]:
    """The fields of the header at the start of ``raw`` and where its block begins: None and 0 if it isn't well formed (a further version
    line has no colon, so it ends there), None and 1 if it goes on after ``raw``."""
    if not (version := VERSION.match(raw)):
        return None, 0
    fields, at = {}, version.end()
    while (end := raw.find(b"\r\n", at)) != at:
        if end < 0:
            return None, 1
        name, colon, value = raw[at:end].partition(b":")
        if not colon:
            return None, 0
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        at = end + 2
    return fields, at + 2


def _long(text: str | None) -> int | None:
    number = int(text) if re.fullmatch(r"-?[0-9]{1,19}", text or "") else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


def parse(raw: bytes) -> dict | None:
    """The record at the start of ``raw``, with its ``size``; None if a check fails."""
    fields, start = _header(raw)
    if fields is None:
        return None
    length = fields.get("content-length", "")
    if not re.fullmatch(r"[0-9]{1,15}", length) or "warc-type" not in fields:
        return None
    block = raw[start : start + int(length)]
    size = start + int(length) + 4
    if raw[size - 4 : size] != b"\r\n\r\n":
        return None
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and re.fullmatch("[0-9a-f]{40}", digest) and hashlib.sha1(block).hexdigest() != digest:
        return None
    return {
        "size": size, "record_type": kind, "page_id": _long(fields.get("x-page-id")), "target_uri": fields.get("warc-target-uri"),
        "payload_digest": digest or hashlib.sha1(block).hexdigest(),
        "payload_bytes": len(block) if kind == "response" else _long(fields.get("x-payload-bytes")),
        "refers_to": _long(fields.get("x-refers-to-page-id")), "payload": block,
    }


class _Window:
    """Bytes of a file from any offset, held as far as they are asked for."""

    def __init__(self, stream, size: int):
        self.stream, self.size, self.at, self.held = stream, size, 0, b""

    def need(self, offset: int, n: int) -> bytes:
        """At least n bytes from the offset, less at the end of the file."""
        if not self.at <= offset <= self.at + len(self.held):
            self.at, self.held = offset, b""
        elif offset - self.at > READ_BYTES:
            self.held, self.at = self.held[offset - self.at :], offset
        short = offset + n - self.at - len(self.held)
        if short > 0 and self.at + len(self.held) < self.size:
            self.stream.seek(self.at + len(self.held))
            self.held += self.stream.read(min(max(short, READ_BYTES), self.size - self.at - len(self.held)))
        return self.held[offset - self.at :]


def _member(window: _Window, offset: int) -> dict | None:
    """The record in the gzip member at the offset; ``size`` is that of the member."""
    inflate, out, at = zlib.decompressobj(31), [], offset
    try:
        while not inflate.eof:
            raw = window.need(at, 1 << 16)[: 1 << 16]
            if not raw:
                return None
            out.append(inflate.decompress(raw))
            at += len(raw)
            if len(out) == 1 and not (out[0][:5] == b"WARC/"[: len(out[0])]):
                return None
    except zlib.error:
        return None
    raw = b"".join(out)
    found = parse(raw)
    if found is None or found["size"] != len(raw):
        return None
    return found | {"size": at - len(inflate.unused_data) - offset}


def _plain(window: _Window, offset: int) -> dict | None:
    need = HEAD_BYTES
    while True:
        raw = window.need(offset, need)
        fields, start = _header(raw)
        if fields is None and (not start or len(raw) < need):
            return None
        if fields is None:
            need = 2 * len(raw)
            continue
        length = fields.get("content-length", "")
        total = start + int(length) + 4 if re.fullmatch(r"[0-9]{1,15}", length) else 0
        if total <= len(raw):
            return parse(raw)
        if total > window.size - offset:
            return None
        need = total


def _next_start(window: _Window, offset: int, compress: bool) -> int:
    """The next byte at or after the offset where a record may begin; the size of the file if there is none."""
    sign = b"\x1f\x8b\x08" if compress else b"WARC/1."
    while offset < window.size:
        raw = window.need(offset, READ_BYTES)
        at = raw.find(sign)
        if at >= 0:
            return offset + at
        offset += max(1, len(raw) - len(sign) + 1)
    return window.size


def _reader(batches):
    kinds = [("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    names = [n for n, _ in kinds]

    def out(rows):
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))

    for batch in batches:
        for split in batch.to_pylist():
            store, path = _filesystem(split["path"])
            compress = split["path"].endswith(".gz")
            with store.open_input_file(path) as stream:
                window, offset, rows, held = _Window(stream, split["size"]), split["start"], [], 0
                while (offset := _next_start(window, offset, compress)) < split["end"]:
                    found = _member(window, offset) if compress else _plain(window, offset)
                    if found is None:
                        offset += 1
                        continue
                    found |= {"path": split["path"], "offset": offset, "length": found["size"]}
                    rows.append({n: found[n] for n in names})
                    offset, held = offset + found["size"], held + len(found["payload"])
                    if held >= READ_BYTES or len(rows) >= 2000:
                        yield out(rows)
                        rows, held = [], 0
                yield out(rows)


def read_archives(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Accepted records of ``files`` (path, bytes): their extents, fields and payloads."""
    step = F.when(F.col("path").endswith(".gz"), F.lit(split_bytes)).otherwise(F.greatest("bytes", F.lit(1)))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), step.cast("long")))
    splits = files.select("path", F.col("bytes").cast("long").alias("size"), step.cast("long").alias("step"), starts.alias("start"))
    splits = splits.select("path", "size", "start", F.least(F.col("start") + F.col("step"), "size").alias("end"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return splits.repartition(partitions, "path", "start").mapInArrow(_reader, RECORDS)


def quarantined(files: DataFrame, records: DataFrame) -> DataFrame:
    """The byte gaps of each file that no accepted record covers: path, gap_start, gap_end."""
    from pyspark.sql import Window

    extents = records.select("path", "offset", (F.col("offset") + F.col("length")).alias("end"))
    marks = extents.unionByName(files.select("path", F.col("bytes").alias("offset"), F.col("bytes").alias("end")))
    before = F.max("end").over(Window.partitionBy("path").orderBy("offset", "end").rowsBetween(Window.unboundedPreceding, -1))
    gaps = marks.select("path", F.coalesce(before, F.lit(0)).alias("gap_start"), F.col("offset").alias("gap_end"))
    return gaps.filter("gap_end > gap_start")
