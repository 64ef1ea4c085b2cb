"""Measurement documents: one row per file, ``pm_file (file_path, file_name, content)``.

``file_path`` identifies a document through every later step; ``file_name`` is its base name.
"""

from __future__ import annotations

import codecs
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.functions.names import base_name

XML_GLOB = "*.xml*"
# First bytes of gzip and zlib data, and an XML declaration.
COMPRESSED = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
UTF, LATIN = "UTF-8", "ISO8859-1"
DECLARED_ENCODING = re.compile(rb"""\s*<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)["']""")


def _path_of_file() -> Column:
    """The scanned file's path with URL escapes undone; ``+`` is a sign here, not a blank."""
    escaped = F.col("_metadata.file_path")
    return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def as_pm_file(frame: DataFrame) -> DataFrame:
    """Attach path and name to a scan of whole texts, batch or streaming."""
    return frame.select("*", _path_of_file().alias("file_path")).select(
        "file_path",
        base_name(F.col("file_path")).alias("file_name"),
        F.col("value").alias("content"),
        *[c for c in frame.columns if c != "value"],
    )


def read_pm_files(spark: SparkSession, path: str, glob: str = XML_GLOB, partitioned: bool = False) -> DataFrame:
    """A directory of plain or gzip XML, folders below it included. Spark inflates ``.gz`` by its suffix.

    Small files are packed into splits by ``spark.sql.files.maxPartitionBytes``, so no
    repartition follows. With ``partitioned`` the folders below are partition folders (``day=...``),
    which become columns and prune.
    """
    return as_pm_file(
        spark.read.option("wholetext", True).option("pathGlobFilter", glob)
        .option("recursiveFileLookup", not partitioned).format("text").load(path)
    )


def read_pm_sequence(spark: SparkSession, path: str) -> DataFrame:
    """SequenceFiles of (file name, XML as text, bytes or compressed bytes); one split per file block.

    The container for large backlogs: many documents per file, splittable, nothing to list. Python only inflates what is
    compressed and hands bytes over as they are; the JVM makes text of them.
    """
    raw = spark.sparkContext.sequenceFile(path).mapPartitions(handed_over)
    frame = spark.createDataFrame(raw, "file_path STRING, content STRING, body BINARY, latin BOOLEAN", verifySchema=False)
    decoded = F.when(F.col("latin"), F.decode("body", "ISO-8859-1")).otherwise(F.make_valid_utf8(F.col("body").cast("string")))
    return frame.select(
        "file_path", base_name(F.col("file_path")).alias("file_name"), F.coalesce("content", decoded).alias("content"))


def handed_over(pairs: Iterator[tuple]) -> Iterator[tuple[str, str | None, bytes | None, bool | None]]:
    """Documents of one split as (name, text, bytes, whether they are Latin-1): text only where it has no other way."""
    for name, body in pairs:
        if isinstance(body, str):
            yield str(name), body, None, None
            continue
        data = plain_bytes(body)
        charset = declared_charset(data)
        if charset in (UTF, LATIN):
            yield str(name), None, data, charset == LATIN
        else:
            yield str(name), text_of(data), None, None


def plain_bytes(body: bytes | bytearray) -> bytes:
    """Inflated when compressed; what is cut short stays as it is."""
    data = bytes(body)
    if data[:2] in COMPRESSED:
        try:
            return inflated(data)
        except zlib.error:
            return data
    return data


def declared_charset(data: bytes) -> str:
    """What the XML declaration says, under one name; UTF-8 where it says nothing that is known."""
    declared = DECLARED_ENCODING.match(data)
    try:
        return codecs.lookup(declared.group(1).decode()).name.upper() if declared else UTF
    except LookupError:
        return UTF


def inflated(data: bytes) -> bytes:
    """Everything compressed data holds: a gzip file may have several members, one after another."""
    out = []
    while data[:2] in COMPRESSED:
        inflate = zlib.decompressobj(zlib.MAX_WBITS | 32)
        out.append(inflate.decompress(data) + inflate.flush())
        if not inflate.eof:
            raise zlib.error("data cut short")
        data = inflate.unused_data
    return b"".join(out)


def text_of(body: str | bytes | bytearray) -> str:
    """A document's text: inflated when compressed, decoded as its declaration says, UTF-8 otherwise.

    Bytes that do not decode become replacement characters, so a damaged document reaches the
    parser and its issue instead of failing the job.
    """
    if isinstance(body, str):
        return body
    data = plain_bytes(body)
    return data.decode(declared_charset(data), "replace")
