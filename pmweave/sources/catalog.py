"""Counter catalogs: which counters each report table holds, in which order.

The definition file has a ``[General]`` section with ``Region``, ``Market``, report headers and so on and a
``[Table]`` section with one line per table, ``table=code:column,...`` for one vendor and
``table=counter:Single,counter:PDF[5],...`` for the other. Other sections are not looked at. Lines starting with ``;`` or
``#`` are comments, and so is what follows a ``;`` after a blank. Bring your own file: no counter list is built into this package.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pmweave.functions.arrays import SINGLE, counter_dim, counter_kind

# Sections, setting names in lower case as keys are compared, and the settings whose absence is an issue.
GENERAL, TABLE = "General", "Table"
RELATION_KEYS = {"ltecellheader": "ltecell", "umtscellheader": "umtscell", "gsmcellheader": "gsmcell"}
SETTING_KEYS = ["region", "market", "hl_market", "technology", "debugnothinguseinelement", "elementsnotused", "commonheader", *RELATION_KEYS]
EXPECTED = {"region": "Region", "market": "Market"}


@dataclass(frozen=True)
class Counter:
    """One catalog entry."""

    table: str
    ordinal: int
    code: str
    column: str
    kind: str = SINGLE
    dim: int = 1


@dataclass(frozen=True)
class Settings:
    """The ``[General]`` section. ``header`` and ``relation_headers`` are report labels by position, empty for the built-in ones."""

    region: str = ""
    market: str = ""
    hl_market: str = ""
    technology: str = "LTE"
    list_unused: bool = False
    list_not_used: bool = True
    header: tuple[str, ...] = ()
    relation_headers: tuple[tuple[str, tuple[str, ...]], ...] = ()
    absent: tuple[str, ...] = ()
    technology_named: bool = False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of one file or of each file of a folder as ``(line, section, text, key, value)``; comments dropped.

    A section goes on until the next one, so it is the running last header of the file. A definition file is
    small and read whole.
    """
    files = spark.read.option("wholetext", True).text(path).select("_metadata.file_path", "value")
    lines = files.select("file_path", F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("at", "text"))
    header = F.nullif(F.regexp_extract("text", r"^\[([^\]]+)\]", 1), F.lit(""))
    before = Window.partitionBy("file_path").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = lines.select("file_path", "at", "text", header.alias("header"), F.last(header, ignorenulls=True).over(before).alias("section"))
    rows = held.filter(F.col("header").isNull() & ~F.col("text").rlike(r"^\s*([;#]|$)"))
    pair = r"^\s*([^=:]*?)\s*[=:](.*)$"
    return rows.select(
        F.struct("file_path", "at").alias("line"), "section", "text",
        F.lower(F.nullif(F.regexp_extract("text", pair, 1), F.lit(""))).alias("key"),
        F.trim(F.regexp_replace(F.regexp_extract("text", pair, 2), r"\s;.*$", "")).alias("value"),
    )


def _last_of_key(lines: DataFrame) -> DataFrame:
    """A key given twice counts with its last line."""
    return lines.groupBy("key").agg(F.max_by("value", "line").alias("value"))


def catalog_rows(lines: DataFrame, vendor: str) -> DataFrame:
    """``(table_name, definition)`` rows to catalog entries.

    Ericsson entries are ``counter:kind`` and the column is named after the counter;
    Nokia entries are ``code:column``, always single values. An unknown kind leaves
    ``kind`` and ``dim`` null, and an entry that is no pair leaves them and ``column_name`` null;
    ``load_catalog`` refuses both. Nothing between two commas is no entry; a table without entries is one that is no pair.
    """
    entry = lines.select("table_name", "definition", F.posexplode(F.split("definition", ",")).alias("ordinal", "entry"))
    entry = entry.filter((F.trim("entry") != "") | (F.trim("definition") == ""))
    code, second = _pair(F.col("entry"))
    typed = vendor == "ericsson"
    is_pair = F.coalesce(second, F.lit("")) != ""
    return entry.select(
        F.lit(vendor).alias("vendor"),
        "table_name",
        "ordinal",
        code.alias("code"),
        F.when(is_pair, code if typed else second).alias("column_name"),
        F.when(is_pair, counter_kind(second) if typed else F.lit(SINGLE)).alias("kind"),
        F.when(is_pair, counter_dim(second) if typed else F.lit(1)).alias("dim"),
    )


def _pair(entry: Column) -> tuple[Column, Column]:
    parts = F.split(entry, ":")
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


def read_counter_catalog(spark: SparkSession, path: str, vendor: str) -> DataFrame:
    """``counter_catalog (vendor, table_name, ordinal, code, column_name, kind, dim)``; table names in lower case.

    The tables are the lines of ``[Table]``. A line there that is no ``key=value``, or one above all sections, comes as a row with
    the line as its ``code`` and nothing else, which ``load_catalog`` refuses.
    """
    lines = _lines(spark, path)
    tables = _last_of_key(lines.filter((F.col("section") == TABLE) & F.col("key").isNotNull()))
    rows = catalog_rows(tables.select(F.col("key").alias("table_name"), F.col("value").alias("definition")), vendor)
    bad = lines.filter(F.col("section").isNull() | ((F.col("section") == TABLE) & F.col("key").isNull()))
    return rows.unionByName(bad.select(
        F.lit(vendor).alias("vendor"), F.lit(None).cast("string").alias("table_name"), F.col("line.at").alias("ordinal"),
        F.trim("text").alias("code"), F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("kind"),
        F.lit(None).cast("int").alias("dim"),
    ))


def load_catalog(catalog: DataFrame) -> dict[str, list[Counter]]:
    """The catalog as ``table -> counters in order``, tables by name.

    A catalog becomes report columns, so the driver has to know it when a plan is built; it is as
    large as the definition file. Refuses entries that are no pair and array counters without a usable size.
    """
    rows = catalog.orderBy("table_name", "ordinal").collect()
    tables: dict[str, list[Counter]] = {}
    for r in rows:
        if r.table_name is None:
            raise ValueError(f"line {r.code!r} belongs to no table")
        if r.column_name is None:
            raise ValueError(f"entry {r.code!r} of table {r.table_name!r} is no pair")
        if not r.dim or r.dim < 1:
            raise ValueError(f"counter {r.code!r} of table {r.table_name!r} has no size")
        tables.setdefault(r.table_name, []).append(
            Counter(r.table_name, r.ordinal, r.code, r.column_name, r.kind, r.dim)
        )
    return tables


def load_settings(spark: SparkSession, path: str) -> Settings:
    """The ``[General]`` lines, a handful."""
    lines = _lines(spark, path).filter((F.col("section") == GENERAL) & F.col("key").isin(SETTING_KEYS))
    got = {r.key: r.value for r in _last_of_key(lines).collect()}
    labels = lambda key: tuple(x.strip() for x in got.get(key, "").split(",") if x.strip())
    return Settings(
        region=got.get("region", ""),
        market=got.get("market", ""),
        hl_market=got.get("hl_market", ""),
        technology=got.get("technology") or "LTE",
        list_unused=got.get("debugnothinguseinelement", "") in ("true", "1"),
        list_not_used=got.get("elementsnotused", "true") not in ("false", "0"),
        header=labels("commonheader"),
        relation_headers=tuple((table, labels(key)) for key, table in RELATION_KEYS.items() if labels(key)),
        absent=tuple(name for key, name in EXPECTED.items() if key not in got),
        technology_named=bool(got.get("technology")),
    )
