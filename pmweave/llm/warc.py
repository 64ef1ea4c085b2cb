"""WARC archives: one gzip member per record, written by tasks and read back in sequence.

The reader inflates a member piece by piece, frames the record by its Content-Length and checks
both digests while the bytes pass, so its memory is one piece (plus the payload where asked for).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.llm.workers import importable
from pmweave.session import shared_folder, stage

PIECE = 1 << 16
MAX_HEADER = 1 << 20
MEMBER = b"\x1f\x8b\x08"
ARCHIVE_BYTES = 1 << 29
MIN_REVISIT_BYTES = 100
RECORD = ("archive string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
          "payload_bytes long, payload_digest string, payload binary, error string")


class WarcError(ValueError):
    pass


# ---- writing

def _header(version: str, fields: list[tuple[str, str | None]]) -> bytes:
    lines = [version] + [f"{k}: {v}" for k, v in fields if v is not None]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")


def record_bytes(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit carries the HTTP header only; its digest and length are the payload's."""
    digest = hashlib.sha256(payload).hexdigest()
    block = _header("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    if refers_to is None:
        block += payload
    kind = "response" if refers_to is None else "revisit"
    uri = None if uri is None else uri.replace("\r", "%0D").replace("\n", "%0A")
    head = _header("WARC/1.1", [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
        ("WARC-Profile", None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", None if refers_to is None else f"<{refers_to}>"),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``(record_id, target_uri, payload string, refers_to)`` rows below ``folder``; one row per archive comes back.

    Every attempt of a task writes files of its own name, and only the committed attempt's names are
    in the returned (staged) list, so retries and speculation leave no record twice. A null payload
    is empty, a null uri is left out.
    """
    importable(records.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task, done, out, path = TaskContext.get(), [], None, ""
        for batch in batches:
            for rid, uri, payload, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path = f"{base}/{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz"
                    out, n = store.open_output_stream(path, compression=None), 0
                out.write(record_bytes(rid, uri, (payload or "").encode("utf-8", "surrogatepass"), refers))
                n += 1
                if out.tell() >= archive_bytes:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        prefix = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
        yield pa.RecordBatch.from_arrays([pa.array([prefix + p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["archive", "records"])

    columns = records.select("record_id", "target_uri", "payload", "refers_to")
    return stage(columns.mapInArrow(write, "archive string, records long"), "archives")


# ---- reading

class _Record:
    """Takes the inflated bytes of one member in any pieces; memory is one header and, where kept, the payload."""

    def __init__(self, keep: bool):
        self.keep, self.buffer, self.fields, self.left = keep, b"", None, 0
        self.block, self.body = hashlib.sha256(), hashlib.sha256()
        self.http, self.http_done, self.size, self.kept, self.tail = b"", False, 0, [], b""

    def feed(self, data: bytes) -> None:
        if self.fields is None:
            self.buffer += data
            at = self.buffer.find(b"\r\n\r\n")
            if at < 0:
                if len(self.buffer) > MAX_HEADER:
                    raise WarcError("header too long")
                return
            self.fields = _fields(self.buffer[:at], b"WARC/")
            try:
                self.left = int(self.fields["content-length"])
            except (KeyError, ValueError) as bad:
                raise WarcError("no content length") from bad
            self.http_done = not self.fields.get("content-type", "").startswith("application/http")
            data, self.buffer = self.buffer[at + 4:], b""
        block, rest = data[: self.left], data[self.left:]
        self.left -= len(block)
        if block:
            self.block.update(block)
            self._payload(block)
        self.tail += rest
        if len(self.tail) > 4:
            raise WarcError("bytes after the record")

    def _payload(self, data: bytes) -> None:
        if not self.http_done:
            self.http += data
            at = self.http.find(b"\r\n\r\n")
            if at < 0:
                if len(self.http) > MAX_HEADER:
                    raise WarcError("http header too long")
                return
            data, self.http, self.http_done = self.http[at + 4:], self.http[:at], True
        self.size += len(data)
        self.body.update(data)
        if self.keep:
            self.kept.append(data)

    def finish(self) -> dict:
        if self.fields is None or self.left or self.tail != b"\r\n\r\n":
            raise WarcError("record cut short")
        f = self.fields
        kind, digest, size = f.get("warc-type"), self.body.hexdigest(), self.size
        if f.get("warc-block-digest", f"sha256:{self.block.hexdigest()}") != f"sha256:{self.block.hexdigest()}":
            raise WarcError("block digest differs")
        declared = f.get("warc-payload-digest")
        if kind == "revisit":  # the payload is elsewhere: the record says what it is
            digest = declared.removeprefix("sha256:") if declared else None
            length = _fields(self.http, b"HTTP/").get("content-length") if self.http else None
            size = int(length) if length and length.isdigit() else None
        elif declared not in (None, f"sha256:{digest}"):
            raise WarcError("payload digest differs")
        bare = {k: f[k].strip("<>") if k in f else None for k in ("warc-record-id", "warc-refers-to")}
        return {"record_type": kind, "record_id": bare["warc-record-id"], "target_uri": f.get("warc-target-uri"), "refers_to": bare["warc-refers-to"],
                "payload_bytes": size, "payload_digest": digest, "payload": b"".join(self.kept) if self.keep else None, "error": None}


def _fields(header: bytes, version: bytes) -> dict[str, str]:
    first, *lines = header.split(b"\r\n")
    if not first.startswith(version):
        raise WarcError("no version line")
    pairs = (line.decode("utf-8", "surrogatepass").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records(source, keep_payload: bool = False) -> Iterator[dict]:
    """The records of a seekable binary file in order. Damage gives a row with ``error``; reading goes on at the next gzip member.

    What a member leaves of a piece begins the next, so every byte is read once; only damage seeks back. An empty file has no records.
    """
    at, held = 0, b""
    while raw := held or source.read(PIECE):
        inflate, record, taken = zlib.decompressobj(31), _Record(keep_payload), 0
        try:
            while True:
                taken += len(raw)
                record.feed(piece := inflate.decompress(raw, PIECE))
                while piece and not inflate.eof:  # a full piece may not be all that this input gives
                    record.feed(piece := inflate.decompress(inflate.unconsumed_tail, PIECE))
                if inflate.eof:
                    break
                raw = source.read(PIECE)
                if not raw:
                    record.feed(inflate.flush())
                    raise WarcError("member cut short")
            held = inflate.unused_data
            following = at + taken - len(held)
            found = record.finish()
        except (zlib.error, WarcError, UnicodeDecodeError) as bad:
            found, following, held = {"error": f"{type(bad).__name__}: {bad}"}, _next_member(source, at + 1), b""
            source.seek(following)
        yield {"offset": at, **found}
        at = following


def _next_member(source, at: int) -> int:
    while True:
        source.seek(at)
        piece = source.read(PIECE)
        found = piece.find(MEMBER)
        if found >= 0:
            return at + found
        if len(piece) < PIECE:
            return at + len(piece)
        at += len(piece) - len(MEMBER) + 1


def read_archives(archives: DataFrame, keep_payload: bool = False, rows_at_once: int = 256) -> DataFrame:
    """The records of the files named in ``archive``, schema ``RECORD``; one file is read by one task, front to back.

    Other columns are not looked at, a null path names no file, a path listed twice is read twice, no paths give no records.
    """
    importable(archives.sparkSession)
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = pafs.FileSystem.from_uri(path)
                rows = []
                with store.open_input_file(name) as source:
                    for row in records(source, keep_payload):
                        rows.append({"archive": path, **row})
                        if len(rows) == rows_at_once:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, archives.count())
    return archives.select("archive").where("archive is not null").repartition(n, "archive").mapInArrow(read, RECORD)


# ---- pages

def page_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``(record_id, target_uri, payload, refers_to)`` of ``(page_id, url, html)`` rows.

    Of pages of equal payloads of at least ``min_bytes``, those of the least page_id are responses and
    the others refer to it. Only ids and digests are grouped; the texts are shuffled once, by page.
    A null html is an empty payload. Rows that repeat the least page_id are responses too. A null
    page_id is written without a number and may only revisit, unless its whole group has none.
    """
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("digest")
    light = pages.select("page_id", digest, F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"))
    long = light.where(F.col("bytes") >= min_bytes).select("page_id", "digest")
    first = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    revisits = long.join(first, "digest").where("first is not null and (page_id is null or page_id <> first)").distinct()
    rows = pages.select("page_id", "url", "html", digest).alias("p")
    joined = rows.join(revisits.alias("r"), F.expr("p.page_id <=> r.page_id and p.digest = r.digest"), "left")
    urn = lambda c: F.concat(F.lit("urn:page:"), F.col(c).cast("string"))
    return joined.select(F.coalesce(urn("p.page_id"), F.lit("urn:page:")).alias("record_id"), F.col("p.url").alias("target_uri"),
                         F.col("p.html").alias("payload"), urn("r.first").alias("refers_to"))


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages as archives in the shared folder; gives the list of archives."""
    return write_archives(page_records(pages, min_bytes), shared_folder(pages.sparkSession, "warc"))
