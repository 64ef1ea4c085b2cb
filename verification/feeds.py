"""Measurement feeds derived from the given tables.

The tables carry no XML, so documents are written out of ``events``: a document holds the
events of one run of 64 consecutive ids. ``event_id`` is unique, so no document can grow
with the data or with a hot user. Every event becomes one measured object.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pmweave.session import shared_folder

EVENTS_PER_DOCUMENT = 64
DOCUMENTS_PER_FOLDER = 1024

# Folders of documents already written, by session, table folder and kind.
_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, kind: str, documents: DataFrame, row_group: int | None = None) -> DataFrame:
    """Documents as a table in the shared folder, written once per session.

    Operators start from landed documents, so writing them is kept out of their plans. ``row_group`` is for documents
    of megabytes, which come in partitions of their own making: they are written as they come, and the writer looks after
    every one of them, not after a hundred, whether so many bytes are full. A reader holds a row group's texts at a time.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key in _landed:
        try:
            return spark.read.parquet(_landed[key])
        except AnalysisException:
            pass  # the shared folder was cleared since; land again
    folder = shared_folder(spark, f"documents-{kind}")
    if row_group:
        every_row = {f"parquet.{what}.size.row.check.{end}": 1 for what in ("page", "block") for end in ("min", "max")}
        documents.write.options(**{"parquet.block.size": row_group, **every_row}).parquet(folder)
    else:
        # a landing zone is many files, so reading it uses every core
        documents.repartition(spark.sparkContext.defaultParallelism).write.parquet(folder)
    _landed[key] = folder
    return spark.read.parquet(folder)


def once(spark: SparkSession, sf_dir: str, kind: str, write) -> str:
    """A folder in the shared one that ``write(spark, sf_dir, folder)`` has filled, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _landed:
        folder = shared_folder(spark, kind)
        write(spark, sf_dir, folder)
        _landed[key] = folder
    return _landed[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scaled(value: str) -> Column:
    return F.round(F.col(value) * 100).cast("bigint")


def text(*parts) -> Column:
    """Concatenate columns and literals as strings."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.expr(f"event_id div {EVENTS_PER_DOCUMENT}").alias("doc"),
        "event_id", "user_id", "event_type", scaled("value").alias("raw"),
    )


def eric_name(doc: Column) -> Column:
    clock = text(F.lpad((doc % 24).cast("string"), 2, "0"), F.lpad((doc % 4 * 15).cast("string"), 2, "0"))
    return text(
        "OSS", doc % 5, "_-0400_A20240101.", clock, "+0000-", clock, "+0000_SubNetwork=ROOT,SubNetwork=Area",
        doc % 7, ",MeContext=N", doc, "_statsfile.xml",
    )


def lte_moid() -> Column:
    """A cell, one of its relations, or an object of no cell."""
    cell = text("ManagedElement=1,ENodeBFunction=1,EUtranCellFDD=C", F.col("user_id") % 40)
    event = F.col("event_id")
    return (
        F.when(event % 10 == 9, F.lit("ManagedElement=1"))
        .when(event % 6 == 0, text(cell, ",EUtranFreqRelation=", event % 4, ",EUtranCellRelation=", event % 9))
        .otherwise(cell)
    )


def umts_moid() -> Column:
    cell = text("ManagedElement=1,RncFunction=1,UtranCell=U", F.col("user_id") % 40)
    event = F.col("event_id")
    return (
        F.when(event % 10 == 9, F.lit("ManagedElement=1"))
        .when(event % 12 == 0, text(cell, ",UtranFreqRelation=", event % 4, ",UtranCellRelation=", event % 9))
        .when(event % 12 == 4, text(cell, ",EUtranFreqRelation=", event % 4, ",EUtranCellRelation=", event % 9))
        .when(event % 12 == 8, text(cell, ",GeranFreqGroupRelation=", event % 4, ",GeranCellRelation=", event % 9))
        .otherwise(cell)
    )


def _gather(rows: DataFrame, name: Column, head: Column, tail: Column, block_open: Column, block_close: str) -> DataFrame:
    """One text per document: rows in (block, event_id) order, each block opened and closed once."""
    ordered = rows.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("block", "event_id", block_open.alias("open"), "body"))).alias("rows")
    )
    last = F.size("rows") - 1
    body = F.transform(
        "rows",
        lambda r, i: F.concat(
            F.when((i == 0) | (F.get("rows", i - 1)["block"] != r["block"]), r["open"]).otherwise(F.lit("")),
            r["body"],
            F.when((i == last) | (F.get("rows", i + 1)["block"] != r["block"]), F.lit(block_close)).otherwise(F.lit("")),
        ),
    )
    return ordered.select(
        "doc", name.alias("file_path"), name.alias("file_name"),
        F.concat(head, F.array_join(body, "\n"), tail).alias("content"),
    )


def mdc_documents(spark: SparkSession, sf_dir: str, technology: str = "LTE") -> DataFrame:
    """mdc documents, one ``md`` per event type.

    ``pm_<type>`` is the value; ``pmHist`` two numbers, empty when the value divides by 7
    and left out when it divides by 11.
    """
    raw, event = F.col("raw"), F.col("event_id")
    hist = (
        F.when(raw % 11 == 0, F.lit(""))
        .when(raw % 7 == 0, F.lit("<r/>"))
        .otherwise(text("<r>", event % 50, ",", raw % 9, "</r>"))
    )
    rows = event_rows(spark, sf_dir).select(
        "doc", "event_id", F.col("event_type").alias("block"),
        text("<mv><moid>", lte_moid() if technology == "LTE" else umts_moid(), "</moid><r>", raw, "</r>", hist, "</mv>").alias("body"),
    )
    return landed(spark, sf_dir, f"mdc-{technology}", _gather(
        rows, eric_name(F.col("doc")), F.lit("<mdc><mfh/>\n"), F.lit("\n</mdc>"),
        text("<md><mi><mt>pm_", F.col("block"), "</mt><mt>pmHist</mt>"), "</mi></md>",
    ))


def collec_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3GPP documents of the same events; values come in another order than names, one has no name."""
    raw, event = F.col("raw"), F.col("event_id")
    hist = (
        F.when(raw % 11 == 0, F.lit(""))
        .when(raw % 7 == 0, F.lit('<m:r p="2"/>'))
        .otherwise(text('<m:r p="2">', event % 50, ",", raw % 9, "</m:r>"))
    )
    rows = event_rows(spark, sf_dir).select(
        "doc", "event_id", F.col("event_type").alias("block"),
        text(
            '<m:measValue measObjLdn="', lte_moid(), '">', hist, '<m:r p="1">', raw,
            '</m:r><m:r p="9">5</m:r></m:measValue>',
        ).alias("body"),
    )
    return landed(spark, sf_dir, "3gpp", _gather(
        rows, eric_name(F.col("doc")),
        F.lit('<m:measCollecFile xmlns:m="urn:x"><m:fileHeader/><m:measData>\n'),
        F.lit("\n</m:measData></m:measCollecFile>"),
        text('<m:measInfo><m:measType p="1">pm_', F.col("block"), '</m:measType><m:measType p="2">pmHist</m:measType>'),
        "</m:measInfo>",
    ))


WIDE_COUNTERS, WIDE_CELLS = 535, 1000
WIDE_BYTES = 400 << 20  # what parsing one such document may take at a time
WIDE_AT_ONCE = 4  # documents that one task writes
WIDE_ROW_GROUP = 1 << 20  # compressed; one or two such documents
FIRST_BLOCK, SECOND_BLOCK = (0, 399), (300, WIDE_COUNTERS - 1)
WIDE_SQL = f"""
cell AS (SELECT c_custkey // {WIDE_CELLS} AS doc, c_custkey AS cell, abs(CAST(round(c_acctbal * 100) AS BIGINT)) AS raw FROM customer),
place AS (SELECT unnest(range({WIDE_COUNTERS})) AS j),
wide AS (SELECT doc, cell, j,
  j < {SECOND_BLOCK[0]} AND cell % 3 = 0 AS absent,
  CASE WHEN j < {SECOND_BLOCK[0]} AND cell % 3 = 0 THEN '0'
       WHEN j < {SECOND_BLOCK[0]} THEN CAST((raw + j * 7) % 1009 AS VARCHAR) ELSE CAST((raw + j * 11) % 997 AS VARCHAR) END AS shown
  FROM cell CROSS JOIN place)"""


def wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMTS documents of a thousand customers as cells and 535 counters, in two blocks that overlap.

    The first block leaves every third cell out; counters of both blocks have the value of the second.
    """
    def block(c: Column, first: int, last: int, factor: int, modulus: int, cells: Column) -> Column:
        values = F.transform(F.sequence(F.lit(first), F.lit(last)), lambda j: text("<r>", (c["raw"] + j * factor) % modulus, "</r>"))
        return F.when(cells, text("<mv><moid>ManagedElement=1,RncFunction=1,UtranCell=U", c["cell"], "</moid>", F.array_join(values, ""), "</mv>"))

    def blocks(c: Column) -> Column:
        return F.struct(
            c["cell"].alias("cell"), block(c, *FIRST_BLOCK, 7, 1009, c["cell"] % 3 != 0).alias("one"),
            block(c, *SECOND_BLOCK, 11, 997, F.lit(True)).alias("two"))

    def opened(first: int, last: int) -> str:
        return "<md><mi>" + "".join(f"<mt>pmW{j}</mt>" for j in range(first, last + 1))

    rows = table(spark, sf_dir, "customer").select(
        F.expr(f"c_custkey div {WIDE_CELLS}").alias("doc"), F.col("c_custkey").alias("cell"), F.abs(scaled("c_acctbal")).alias("raw"))
    # numbers are gathered, not texts; a task then writes the texts of its few documents one after another
    gathered = rows.repartition(_wide_files(spark, rows), "doc").groupBy("doc").agg(F.collect_list(F.struct("cell", "raw")).alias("cells"))
    written = gathered.select("doc", F.array_sort(F.transform("cells", blocks)).alias("cells"))
    name = eric_name(F.col("doc"))
    content = text(
        "<mdc>", opened(*FIRST_BLOCK), F.array_join(F.col("cells")["one"], "\n"), "</mi></md>",
        opened(*SECOND_BLOCK), F.array_join(F.col("cells")["two"], "\n"), "</mi></md></mdc>")
    documents = written.select("doc", name.alias("file_path"), name.alias("file_name"), content.alias("content"))
    return landed(spark, sf_dir, "wide", documents, WIDE_ROW_GROUP)


def _wide_files(spark: SparkSession, rows: DataFrame) -> int:
    """Files that wide documents land in: as many as it takes to have few documents in each.

    In a local session all of them are parsed in this process, so there are no more than its memory can have parsed at once.
    """
    context = spark.sparkContext
    if context.master == "local" or context.master.startswith("local["):
        return max(1, min(context.defaultParallelism, spark._jvm.java.lang.Runtime.getRuntime().maxMemory() // WIDE_BYTES))
    return max(context.defaultParallelism, -(-rows.count() // (WIDE_CELLS * WIDE_AT_ONCE)))


def nokia_name(doc: Column) -> Column:
    return text("in/OSS", doc % 5, "_PM_", doc, ".xml")


def _setup(rows: DataFrame) -> DataFrame:
    """One PMSetup per document; hour and minute of its start come from the document's number."""
    doc = F.col("doc")
    return _gather(
        rows, nokia_name(doc),
        text(
            '<OMeS xmlns="urn:x"><PMSetup startTime="2024-01-01T', F.lpad((doc % 24).cast("string"), 2, "0"), ":",
            F.lpad((doc % 4 * 15).cast("string"), 2, "0"), ':00.000-04:00" interval="15">\n',
        ),
        F.lit("\n</PMSetup></OMeS>"), F.lit(""), "",
    )


def lte_nokia_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LTE objects, one type per event type.

    view: neighbour type with a third managed object; click: availability, the cell given in
    two parts; purchase: throughput with one, two or three managed objects; signup: a type
    whose target is self-closing on every fourth event; error: an unconfigured type.
    """
    event, raw, user, kind = F.col("event_id"), F.col("raw"), F.col("user_id"), F.col("event_type")
    by_dn = text("<MO><DN>PLMN-PLMN/MRBTS-", user % 40, "/LNBTS-", user % 40, "/LNCEL-", event % 3, "</DN></MO>")
    by_parts = text(
        "<MO><baseId>NE-MRBTS-", user % 40, "</baseId><localMoid>DN:NE-LNBTS-", user % 40, "/LNCEL-", event % 3,
        "</localMoid></MO>",
    )
    plmn = text("<MO><DN>PLMN-PLMN/MCC-310/MNC-", user % 3 + 260, "</DN></MO>")
    third = text("<MO><DN>PLMN-PLMN/UTRAN-", event % 5, "</DN></MO>")

    def target(tag: str, meas_type: str, counters: Column) -> Column:
        return text(f'<{tag} measurementType="{meas_type}">', counters, f"</{tag}>")

    body = (
        F.when(kind == "view", text(by_dn, plmn, third, target(
            "PMTarget", "LTE_isys_ho_utran_nb",
            text("<M8017C7>", raw, "</M8017C7>",
                 F.when(event % 4 == 0, F.lit("")).otherwise(text("<M8017C9>", event % 100, "</M8017C9>"))))))
        .when(kind == "click", text(by_parts, plmn, target(
            "NE-LNBTS_1.0", "lte_cell_avail",
            text("<M8020C3>", raw, "</M8020C3><M8020C6>", event % 100, "</M8020C6><M8020C77>1</M8020C77>"))))
        .when(kind == "purchase", text(
            by_dn, F.when(event % 3 == 0, F.lit("")).otherwise(plmn),
            F.when(event % 3 == 1, third).otherwise(F.lit("")),
            target("PMTarget", "LTE_Cell_Throughput", text("<M8012C22>", raw, "</M8012C22>"))))
        .when(kind == "signup", text(by_dn, plmn, F.when(
            event % 4 == 0, F.lit('<PMTarget measurementType="lte_rrc"/>')
        ).otherwise(target("PMTarget", "lte_rrc", text("<M8008C1>", raw, "</M8008C1>")))))
        .otherwise(text(by_dn, plmn, target(
            "PMTarget", "lte_unlisted", text("<M9C1>", raw, "</M9C1><M9C", event % 3 + 2, ">", event % 3 + 2, "</M9C", event % 3 + 2, ">"))))
    )
    return landed(spark, sf_dir, "nokia-LTE", _setup(event_rows(spark, sf_dir).select(
        "doc", "event_id", F.lit("").alias("block"), text("<PMMOResult>", body, "</PMMOResult>").alias("body")
    )))


def umts_nokia_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMTS objects: radio-link counters for half of the event types, power counters for the others."""
    event, raw, user, kind = F.col("event_id"), F.col("raw"), F.col("user_id"), F.col("event_type")
    cell = text(
        "<MO><baseId>NE-RNC-", user % 10, "</baseId><localMoid>DN:NE-WBTS-", user % 40, "/WCEL-", event % 3,
        "</localMoid></MO>",
    )
    traffic = text("<MO><DN>PLMN-PLMN/TR_CLASS-", traffic_class(event), "/TR_SUBCLASS-", traffic_subclass(event), "</DN></MO>")
    channel = text("<MO><DN>PLMN-PLMN/ChType-", channel_type(event), "</DN></MO>")
    rlc = text(
        '<WCEL_Nokia1 measurementType="RCPM_RLC_wcel"><M1026C29>', raw, "</M1026C29><M1026C30>", event % 100,
        "</M1026C30><M1026C31>", raw % 1000, "</M1026C31>",
        F.when(event % 8 == 0, F.lit("")).otherwise(text("<m1026c33>", raw % 77, "</m1026c33>")), "</WCEL_Nokia1>",
    )
    olpc = text(
        '<x:WCEL_Nokia2 measurementType="rcpm_olpc_wcel" xmlns:x="urn:y"><M1024C4>', raw, "</M1024C4><M1024C5>",
        event % 100, "</M1024C5><M1024C15>", raw % 8, ".5</M1024C15><M1024C17>", event % 9,
        "</M1024C17></x:WCEL_Nokia2>",
    )
    is_rlc = kind.isin("view", "click", "error")
    return landed(spark, sf_dir, "nokia-UMTS", _setup(event_rows(spark, sf_dir).select(
        "doc", "event_id", F.lit("").alias("block"),
        text("<PMMOResult>", cell, traffic, channel, F.when(is_rlc, rlc).otherwise(olpc), "</PMMOResult>").alias("body"),
    )))


def pick(key: Column, *options: str) -> Column:
    """One of the options by ``key`` modulo their number."""
    return F.get(F.array(*[F.lit(o) for o in options]), (key % len(options)).cast("int"))


def traffic_class(key: Column) -> Column:
    return pick(key, "background", "interactive", "conversational")


def traffic_subclass(key: Column) -> Column:
    return pick(key, "PS_NRT_data", "CS_voice", "PS_RT_data", "PS_NRT_data", "other")


def channel_type(key: Column) -> Column:
    return pick(key, "DCH", "HSUPA", "HSDPA", "HSUPA")


def cut_short(documents: DataFrame) -> DataFrame:
    """Every tenth document loses its end."""
    cut = F.substr("content", F.lit(1), (F.length("content") - 10).cast("int"))
    return documents.withColumn("content", F.when(F.col("doc") % 10 == 7, cut).otherwise(F.col("content")))


def written_documents(spark: SparkSession, documents: DataFrame) -> str:
    """Documents as gzip files, one each, in the shared folder: ``block=<n>/doc=<n>.txt.gz``.

    Every file that Hadoop's local file system makes costs a process for its permissions, every folder another and a
    listing. So where the shared folder is a mounted one, tasks write the files themselves, a thousand to a folder;
    elsewhere Spark writes ``doc=<n>/part-....txt.gz``. ``doc_of_path`` reads both.
    """
    folder, rows = shared_folder(spark, "landing"), documents.select("doc", "content")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getScheme() != "file":
        rows.write.partitionBy("doc").option("compression", "gzip").text(folder)
        return folder
    root = path.toUri().getPath()
    os.makedirs(root)

    def write(some: Iterator[Row]) -> None:
        for doc, content in some:
            block = f"{root}/block={-1 if doc is None else doc // DOCUMENTS_PER_FOLDER}"
            os.makedirs(block, exist_ok=True)
            unfinished = f"{block}/.{uuid.uuid4().hex}"  # hidden; a task that is tried again writes the same files
            with open(unfinished, "wb") as file:
                file.write(gzip.compress(f"{content or ''}\n".encode()))
            os.replace(unfinished, f"{block}/doc={'none' if doc is None else doc}.txt.gz")

    rows.foreachPartition(write)
    return folder


def doc_of_path() -> Column:
    """The number of a written document, null where it has none."""
    return F.nullif(F.regexp_extract("file_path", "/doc=(-?[0-9]+)[./]", 1), F.lit("")).alias("doc")


def tall_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pm_long`` straight from ``events``: file = day, cell = user, counter = event type, order = id."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.substring(F.col("ts").cast("string"), 1, 10).alias("file_path"),
        text("C", F.col("user_id")).alias("cell_id"),
        F.col("event_type").alias("counter"),
        scaled("value").cast("string").alias("raw"),
        F.struct("event_id").alias("pos"),
    )


def class_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UMTS objects straight from ``lineitem``: cell = order, classes by line number and flags."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        text("S", F.col("l_suppkey") % 10).alias("file_path"),
        F.col("l_orderkey").alias("cell"),
        traffic_class(line).alias("tr_class"),
        F.when(F.col("l_linestatus") == "F", traffic_subclass(line)).otherwise("PS_NRT_data").alias("tr_subclass"),
        F.when(F.col("l_returnflag") == "A", "DCH").when(F.col("l_returnflag") == "R", "HSUPA")
        .otherwise("HSDPA").alias("ch_type"),
        _counters(
            m1026c29=F.col("l_partkey"), m1026c30=F.col("l_quantity").cast("bigint"), m1026c31=F.col("l_suppkey"),
            m1026c33=line, m1024c4=F.col("l_partkey"), m1024c5=F.col("l_quantity").cast("bigint"),
            m1024c15=text(F.col("l_quantity").cast("bigint"), ".5"), m1024c17=line,
        ).alias("counters"),
    )


def neighbour_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LTE neighbour objects straight from ``lineitem``: source = order, target = line; some counters absent."""
    line = F.col("l_linenumber")
    common = _counters(M8017C7=F.col("l_quantity").cast("bigint"), M8017C9=F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        text("S", F.col("l_suppkey") % 10).alias("file_path"),
        text("PLMN-PLMN/MRBTS-1/LNBTS-", F.col("l_orderkey"), "/LNCEL-1").alias("cell_id"),
        text("310260-", F.col("l_orderkey"), "-1").alias("cell_id_2"),
        text("N", line).alias("neighbour"),
        F.lit("lte_isys_ho_utran_nb").alias("meas_type"),
        F.when(line % 3 == 0, F.map_filter(common, lambda k, v: k != "M8017C9")).otherwise(common).alias("counters"),
    )


def _counters(**values: Column) -> Column:
    pairs = [x for code, value in values.items() for x in (F.lit(code), value.cast("string"))]
    return F.create_map(*pairs)
