"""Sources, sinks, shredders and whole reports, over documents written out of ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.operators import quality
from pmweave.operators.merge import merge_documents
from pmweave.operators.project import cell_grain_filter as grain_filter
from pmweave.operators.project import codes_of, with_relation
from pmweave.operators.shred import LTE_TARGET, parse_eric, parse_nokia, setups_as_rows, shred_eric
from pmweave.operators.shred import detect_eric_dialect as detect_dialect
from pmweave.operators.shred import explode_counters as explode
from pmweave.operators.shred import shred_3gpp as shred_collec
from pmweave.operators.shred import shred_mdc as shred_md
from pmweave.operators.shred import shred_nokia_lte as shred_lte
from pmweave.operators.shred import shred_nokia_umts as shred_umts
from pmweave.operators.shred import throughput_mo_filter as throughput_filter
from pmweave.plans import ericsson, nokia
from pmweave.session import shared_folder
from pmweave.sinks import read_pm_issues as read_issues
from pmweave.sinks import write_pm_issues as write_issues
from pmweave.sinks import write_pm_report as write_report
from pmweave.sinks import write_pm_summary as write_summary
from pmweave.sources import load_catalog, load_settings
from pmweave.sources import read_counter_catalog as read_catalog
from pmweave.sources import read_pm_files as read_files
from pmweave.sources import read_pm_sequence as read_sequence
from pmweave.sources.catalog import Counter, Settings
from pmweave.streaming import land_batches
from pmweave.streaming import stream_pm_files as stream_files

from verification import feeds
from verification.registry import check
from verification.sql import DOC_TIME, ERIC_FRONT, EVENTS, LTE_OBJECTS, UMTS_OBJECTS, olpc_sums, rlc_sums

SETTINGS = Settings(region="East", market="M1", hl_market="HM")
TYPES = ["click", "error", "purchase", "signup", "view"]
ERIC_ENTRIES = [
    *[Counter("tab1", i, f"pm_{t}", f"pm_{t}") for i, t in enumerate(TYPES)],
    Counter("tab1", 5, "pmHist", "pmHist", "PDF", 3),
    Counter("tab1", 6, "pmNever", "pmNever", "COMP", 2),
]
LTE_CATALOG = {
    "lte_cell_avail": [
        Counter("lte_cell_avail", 0, "M8020C3", "SAMPLES_CELL_AVAIL"), Counter("lte_cell_avail", 1, "M8020C6", "DENOM_CELL_AVAIL"),
    ],
    "lte_cell_throughput": [Counter("lte_cell_throughput", 0, "M8012C22", "PDCP_DATA_RATE_MAX_UL")],
    "lte_isys_ho_utran_nb": [
        Counter("lte_isys_ho_utran_nb", 0, "M8017C7", "ISYS_HO_UTRAN_ATT_NB"),
        Counter("lte_isys_ho_utran_nb", 1, "M8017C9", "ISYS_HO_UTRAN_FAIL_NB"),
    ],
    "lte_rrc": [Counter("lte_rrc", 0, "M8008C1", "RRC_PAGING_REQUESTS")],
}
IDENTITY = ["baseId:BASEID", "localMoid:LOCALMOID", "cell_id_1:CELL_ID_1", "cell_id_2:CELL_ID_2",
            "TR_CLASS:TR_CLASS", "TR_SUBCLASS:TR_SUBCLASS", "CHTYPE:CHTYPE"]
UMTS_CATALOG = {
    t: [Counter(t, i, *pair.split(":")) for i, pair in enumerate([*IDENTITY, *own])]
    for t, own in {
        "rcpm_rlc_wcel": ["m1026c29:rlc_am_dl_meas_time_w", "m1026c33:rlc_am_ul_meas_time_w"],
        "rcpm_olpc_wcel": ["M1024C4:ul_crc_oks_w"],
    }.items()
}

TALL_SQL = f"WITH {EVENTS} SELECT doc, moid, counter, raw FROM tall"


def _tall(objects: DataFrame) -> DataFrame:
    return explode(objects).select(F.col("doc").cast("bigint").alias("doc"), "moid", "counter", "raw")


@check(TALL_SQL)
def read_pm_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a SequenceFile."""
    folder = shared_folder(spark, "sequence")
    pairs = feeds.mdc_documents(spark, sf_dir).select("file_path", "content")
    pairs.rdd.map(tuple).saveAsSequenceFile(folder)
    files = read_sequence(spark, folder)
    node = F.regexp_extract("file_name", "MeContext=N([0-9]+)_", 1)
    return _tall(shred_md(files.withColumn("doc", node)))


@check(TALL_SQL)
def read_pm_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a folder of gzip files."""
    folder = feeds.written_documents(spark, feeds.mdc_documents(spark, sf_dir))
    return _tall(shred_md(read_files(spark, folder, "*.txt.gz", partitioned=True).withColumn("doc", feeds.doc_of_path())))


@check(TALL_SQL)
def stream_pm_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as a stream, a second run adding nothing."""
    folder = feeds.written_documents(spark, feeds.mdc_documents(spark, sf_dir))
    out, checkpoint = shared_folder(spark, "landed"), shared_folder(spark, "offsets")

    def job(files: DataFrame, batch: str) -> None:
        _tall(shred_md(files.withColumn("doc", feeds.doc_of_path()))).write.mode("overwrite").parquet(f"{out}/{batch}")

    for _ in range(2):
        land_batches(stream_files(spark, folder, "*.txt.gz"), checkpoint, job).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@check(f"WITH {EVENTS} SELECT doc, md, mv, moid, 'pm_' || event_type || ';pmHist' AS names, "
       "raw || CASE WHEN hist IS NULL THEN '' ELSE ';' || hist END AS raws FROM lte")
def shred_mdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shred_md(feeds.mdc_documents(spark, sf_dir))
    return rows.select(
        "doc", "md", "mv", "moid", F.array_join("names", ";").alias("names"), F.array_join("raws", ";").alias("raws")
    )


@check(f"WITH {EVENTS} SELECT doc, md, mv, moid, "
       "CASE WHEN hist IS NULL THEN '' ELSE 'pmHist;' END || 'pm_' || event_type || ';?' AS names, "
       "CASE WHEN hist IS NULL THEN '' ELSE hist || ';' END || raw || ';5' AS raws FROM lte")
def shred_3gpp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shred_collec(feeds.collec_documents(spark, sf_dir))
    return rows.select(
        "doc", "md", "mv", "moid", F.array_join("names", ";", "?").alias("names"), F.array_join("raws", ";").alias("raws")
    )


@check(f"WITH {EVENTS} SELECT doc, CASE WHEN doc % 2 = 0 THEN 'mdc' ELSE '3gpp' END AS dialect, moid, counter, raw FROM tall")
def detect_eric_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dialects in one folder, shredded in one pass."""
    even = feeds.mdc_documents(spark, sf_dir).filter(F.col("doc") % 2 == 0)
    odd = feeds.collec_documents(spark, sf_dir).filter(F.col("doc") % 2 == 1)
    files = detect_dialect(even.unionByName(odd))
    rows = shred_eric(files.withColumn("seen", F.col("dialect")))
    return explode(rows).select("doc", F.col("seen").alias("dialect"), "moid", "counter", "raw")


@check(f"WITH {EVENTS} SELECT doc, moid, counter, raw, md, mv, CAST(r AS INTEGER) AS r FROM tall")
def explode_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode(shred_md(feeds.mdc_documents(spark, sf_dir))).select("doc", "moid", "counter", "raw", "pos.*")


def _elements_joined(column: str) -> Column:
    pairs = F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")


@check(f"""WITH {LTE_OBJECTS}
SELECT n.doc, n.object_pos, n.meas_type, strftime(file_time, '%Y-%m-%dT%H:%M') || ':00.000-04:00' AS start_time,
       '15' AS interval_text, CAST(n_mo AS INTEGER) AS n_mo, coalesce(e.counters, '') AS counters
FROM nok2 n LEFT JOIN (SELECT doc, object_pos, string_agg(code || '=' || val, ';' ORDER BY code || '=' || val) AS counters
                       FROM elements GROUP BY doc, object_pos) e
  ON n.doc = e.doc AND n.object_pos = e.object_pos""")
def shred_nokia_lte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_lte(feeds.lte_nokia_documents(spark, sf_dir)).select(
        "doc", "object_pos", "meas_type", "start_time", F.col("interval").alias("interval_text"),
        F.size("mo").alias("n_mo"), _elements_joined("counters").alias("counters"),
    )


@check(f"""WITH {UMTS_OBJECTS}
SELECT doc, object_pos, meas_type, 3 AS n_mo,
  CASE WHEN meas_type = 'rcpm_rlc_wcel'
       THEN 'm1026c29=' || raw || ';m1026c30=' || (event_id % 100) || ';m1026c31=' || (raw % 1000)
            || CASE WHEN event_id % 8 = 0 THEN '' ELSE ';m1026c33=' || (raw % 77) END
       ELSE 'm1024c15=' || (raw % 8) || '.5;m1024c17=' || (event_id % 9) || ';m1024c4=' || raw || ';m1024c5=' || (event_id % 100)
  END AS counters FROM nok""")
def shred_nokia_umts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred_umts(feeds.umts_nokia_documents(spark, sf_dir)).select(
        "doc", "object_pos", "meas_type", F.size("mo").alias("n_mo"), _elements_joined("counters").alias("counters")
    )


@check(f"""WITH {LTE_OBJECTS}
SELECT doc, object_pos, CAST(n_mo AS INTEGER) AS n_mo, CASE WHEN n_mo = 2 THEN raw END AS kept
FROM nok2 WHERE event_type = 'purchase'""")
def throughput_mo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_nokia(feeds.lte_nokia_documents(spark, sf_dir), LTE_TARGET)
    rows = throughput_filter(setups_as_rows(parsed, lower_codes=False, keep_empty=False))
    return rows.filter(F.col("meas_type") == "lte_cell_throughput").select(
        "doc", "object_pos", F.size("mo").alias("n_mo"),
        F.try_element_at("counters", F.lit("M8012C22")).cast("bigint").alias("kept"),
    )


@check(f"WITH {EVENTS} SELECT doc, count(*) AS events, doc % 10 = 7 AS bad FROM obj GROUP BY doc")
def quarantine_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document is cut short: it yields one issue, all others all their objects."""
    files = feeds.cut_short(feeds.mdc_documents(spark, sf_dir))
    lengths = feeds.event_rows(spark, sf_dir).groupBy("doc").agg(F.count(F.lit(1)).alias("events"))
    parsed = parse_eric(files)
    bad = quality.quarantine_bad_files(parsed).select(
        F.regexp_extract("item", "MeContext=N([0-9]+)_", 1).cast("bigint").alias("doc"), F.lit(True).alias("bad")
    ).join(lengths, "doc")
    good = shred_eric(files).groupBy("doc").agg(F.count(F.lit(1)).alias("events")).withColumn("bad", F.lit(False))
    return good.unionByName(bad).select("doc", "events", "bad")


ERIC_COUNTERS_SQL = ", ".join(f"""coalesce({t}, '0') AS "pm_{t}" """ for t in TYPES) + """,
coalesce(split_part(hist, ',', 1), '0') AS "pmHist_0",
CASE WHEN contains(hist, ',') THEN split_part(hist, ',', 2) ELSE '0' END AS "pmHist_1", '0' AS "pmHist_2",
'0' AS "pmNever_0", '0' AS "pmNever_1" """


@check(f"""WITH {EVENTS}, cells AS (
  SELECT l.doc, l.cell_id, {", ".join(f"max(CASE WHEN m.counter = 'pm_{t}' THEN m.raw END) AS {t}" for t in TYPES)},
         max(CASE WHEN m.counter = 'pmHist' THEN m.raw END) AS hist
  FROM (SELECT DISTINCT doc, cell_id FROM lte WHERE cell_id IS NOT NULL) l
  JOIN merged m ON l.doc = m.doc AND l.cell_id = m.cell_id GROUP BY l.doc, l.cell_id),
 timed AS (SELECT *, {DOC_TIME} FROM cells)
SELECT 'run-1' AS "MGR_RUN_ID", {ERIC_FRONT}, cell_id AS "EUtranCellFDD", {ERIC_COUNTERS_SQL} FROM timed""")
def lte_ericsson_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole LTE job of this vendor: documents of both dialects to report rows, without a shuffle."""
    even = feeds.mdc_documents(spark, sf_dir).filter(F.col("doc") % 2 == 0)
    odd = feeds.collec_documents(spark, sf_dir).filter(F.col("doc") % 2 == 1)
    merged = ericsson.cells(even.unionByName(odd), ERIC_ENTRIES, "LTE")
    return ericsson.report(merged, ERIC_ENTRIES, SETTINGS, "LTE", "run-1")


UMTS_CELLS_SQL = f"""WITH {EVENTS}, utall AS (
  SELECT doc, md, mv, cell_id, rel_type, freq_rel, cell_rel, 'pm_' || event_type AS counter, CAST(raw AS VARCHAR) AS raw
  FROM umts WHERE cell_id IS NOT NULL
  UNION ALL
  SELECT u.doc, u.md, u.mv, u.cell_id, u.rel_type, u.freq_rel, u.cell_rel, 'pmHist', l.hist
  FROM umts u JOIN lte l ON u.event_id = l.event_id WHERE u.cell_id IS NOT NULL AND l.hist IS NOT NULL),
 umerged AS (
  SELECT doc, cell_id, rel_type, freq_rel, cell_rel, counter, arg_max(raw, md * 100 + mv) AS raw
  FROM utall GROUP BY ALL),
 cells AS (
  SELECT doc, cell_id, rel_type, freq_rel, cell_rel,
         {", ".join(f"max(CASE WHEN counter = 'pm_{t}' THEN raw END) AS {t}" for t in TYPES)},
         max(CASE WHEN counter = 'pmHist' THEN raw END) AS hist
  FROM umerged GROUP BY doc, cell_id, rel_type, freq_rel, cell_rel),
 timed AS (SELECT *, {DOC_TIME} FROM cells)"""


@check(f"""{UMTS_CELLS_SQL}
SELECT 'run-1' AS "MGR_RUNID", {ERIC_FRONT}, cell_id AS "UtranCell", {ERIC_COUNTERS_SQL} FROM timed WHERE rel_type IS NULL""")
def umts_ericsson_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole UMTS job of this vendor: relations kept apart, cells reported."""
    files = feeds.mdc_documents(spark, sf_dir, "UMTS")
    merged = ericsson.cells(files, ERIC_ENTRIES, "UMTS")
    return ericsson.report(merged, ERIC_ENTRIES, SETTINGS, "UMTS", "run-1")


@check(f"""{UMTS_CELLS_SQL}
SELECT doc % 5 AS oss, rel_type, cell_id, freq_rel, cell_rel, "PERIOD_START_TIME", pm_view, pm_click, node
FROM (SELECT doc, rel_type, cell_id, freq_rel, cell_rel, {ERIC_FRONT}, coalesce(view, '0') AS pm_view,
             coalesce(click, '0') AS pm_click, 'N' || doc AS node
      FROM timed WHERE rel_type IS NOT NULL)""")
def relation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of the three relation tables, put under each other to be compared at once."""
    tables = {t: [Counter(t, i, f"pm_{c}", f"pm_{c}") for i, c in enumerate(("view", "click"))] for t in ericsson.RELATION_HEADER}
    every = [e for t in tables.values() for e in t]
    staged = ericsson.stage_cells(spark, feeds.mdc_documents(spark, sf_dir, "UMTS"), every, "UMTS")
    rows = None
    for rel_type, report in ericsson.relation_reports(staged, tables, codes_of(every), SETTINGS, "r").items():
        one = report.select(
            F.substring("OSSName", 4, 9).cast("bigint").alias("oss"), F.lit(rel_type).alias("rel_type"), F.col("UtranCell").alias("cell_id"),
            *[F.col(label).alias(c) for label, c in zip(ericsson.RELATION_HEADER[rel_type], ericsson.RELATION_PARTS, strict=True)],
            "PERIOD_START_TIME", "pm_view", "pm_click", F.col("MeContext").alias("node"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


UMTS_DEFINITIONS = """[General]
Technology=UMTS
Region=East
Market=M1
HL_MARKET=HM
CommonHeader=MGR_RUNID,HL_DATE,HL_MARKET,Cntr,Region,Market,SubNetwork_2,PERIOD_START_TIME,PERIOD_DURATION,MeContext,OSSName,UtranCell
LTECellHeader=FREQ,NEXT
UMTSCellHeader=FREQ,NEXT
[Table]
Site=pm_view:Single,pmHist:PDF[3],pm_click:Single
LTECell=pm_view:Single,pm_error:Single
UMTSCell=pm_view:Single,pmHist:PDF[2]
GSMCell=pm_click:Single
"""


def _umts_run(spark: SparkSession, sf_dir: str) -> str:
    """The whole UMTS job out of a written definition file, once per session; the folder it published to."""
    return feeds.once(spark, sf_dir, "umts-run", _run_umts)


def _run_umts(spark: SparkSession, sf_dir: str, out: str) -> None:
    file = f"{out}-definitions"
    spark.createDataFrame([(UMTS_DEFINITIONS,)], "value string").coalesce(1).write.text(file)
    catalog, settings = load_catalog(read_catalog(spark, file, "ericsson")), load_settings(spark, file)
    ericsson.run(spark, feeds.mdc_documents(spark, sf_dir, "UMTS"), catalog, settings, settings.technology, out, "run-1")


@check(f"""{UMTS_CELLS_SQL},
 rel AS (SELECT doc, rel_type AS grain, cell_id, freq_rel, cell_rel, CASE rel_type
           WHEN 'ltecell' THEN coalesce(view, '0') || ',' || coalesce(error, '0')
           WHEN 'umtscell' THEN coalesce(view, '0') || ',' || coalesce(split_part(hist, ',', 1), '0') || ','
             || CASE WHEN contains(hist, ',') THEN split_part(hist, ',', 2) ELSE '0' END
           ELSE coalesce(click, '0') END AS shown FROM cells WHERE rel_type IS NOT NULL),
 parts AS (SELECT doc, grain, cell_id, row_number() OVER () AS r, unnest(string_split(shown, ',')) AS v, generate_subscripts(string_split(shown, ','), 1) AS i FROM rel),
 added AS (SELECT doc, grain, cell_id, i, CAST(sum(CAST(v AS BIGINT)) AS BIGINT) AS v FROM parts GROUP BY ALL),
 summed AS (SELECT doc, grain || '_sum' AS grain, cell_id, string_agg(v, ',' ORDER BY i) AS shown FROM added GROUP BY doc, grain, cell_id)
SELECT 'N' || doc AS node, 'report' AS grain, cell_id, '' AS freq_rel, '' AS cell_rel,
  coalesce(view, '0') || ',' || coalesce(split_part(hist, ',', 1), '0') || ',' || CASE WHEN contains(hist, ',') THEN split_part(hist, ',', 2) ELSE '0' END
  || ',0,' || coalesce(click, '0') AS shown FROM cells WHERE rel_type IS NULL
UNION ALL SELECT 'N' || doc, grain, cell_id, freq_rel, cell_rel, shown FROM rel
UNION ALL SELECT 'N' || doc, grain, cell_id, '', '', shown FROM summed""")
def umts_ericsson_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that the UMTS job publishes at cell and relation grain, read back and put under each other."""
    out, rows = _umts_run(spark, sf_dir), None
    for grain in ("report", *[t + s for t in ericsson.RELATION_HEADER for s in ("", "_sum")]):
        table = _read_back(spark, f"{out}/{grain}", ",")
        at = 12 if grain == "report" or grain.endswith("_sum") else 14
        parts = [F.lit(""), F.lit("")] if at == 12 else [F.col(c) for c in table.columns[12:14]]
        one = table.select(
            F.col("MeContext").alias("node"), F.lit(grain).alias("grain"), F.col("UtranCell").alias("cell_id"),
            parts[0].alias("freq_rel"), parts[1].alias("cell_rel"), F.concat_ws(",", *table.columns[at:]).alias("shown"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@check(f"""{UMTS_CELLS_SQL}
SELECT 'N' || doc AS node, 'missing' AS kind, item, 'IE:' || item || ' not found from xml input; set 0 instead' AS message
FROM (SELECT DISTINCT doc, unnest([CASE WHEN view IS NULL THEN 'pm_view' END, CASE WHEN hist IS NULL THEN 'pmHist' END,
        CASE WHEN click IS NULL THEN 'pm_click' END]) AS item FROM cells WHERE rel_type IS NULL) WHERE item IS NOT NULL
UNION ALL SELECT DISTINCT 'N' || doc, 'length', 'pmHist', 'IE:pmHist has less elemments than configured' FROM cells WHERE rel_type IS NULL AND hist IS NOT NULL""")
def umts_ericsson_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues that the UMTS job publishes, relations being in the feed: they lack nothing."""
    found = read_issues(spark, f"{_umts_run(spark, sf_dir)}/issues")
    return found.select(F.regexp_extract("file_path", "MeContext=(N[0-9]+)_", 1).alias("node"), "kind", "item", "message")


WIDE_CODES = [f"pmW{j}" for j in range(feeds.WIDE_COUNTERS)]
WIDE_ENTRIES = [Counter("site", j, c, c) for j, c in enumerate(WIDE_CODES)]


@check(f"""WITH {feeds.WIDE_SQL}
SELECT doc, 'U' || cell AS cell_id, md5(string_agg(shown, ',' ORDER BY j)) AS row_md5
FROM wide GROUP BY doc, cell""")
def umts_ericsson_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of 535 counters over documents of a thousand cells; a digest of each row."""
    merged = ericsson.cells(feeds.wide_documents(spark, sf_dir), WIDE_ENTRIES, "UMTS")
    report = ericsson.report(merged, WIDE_ENTRIES, SETTINGS, "UMTS", "run-1")
    return report.select(
        F.substring("MeContext", 2, 20).cast("bigint").alias("doc"), F.col("UtranCell").alias("cell_id"),
        # through a lambda, so that 535 expressions do not become one method that is too long to be compiled
        F.md5(F.array_join(F.transform(F.array(*WIDE_CODES), lambda v: v), ",")).alias("row_md5"))


@check(f"""WITH {feeds.WIDE_SQL}
SELECT DISTINCT doc, 'pmW' || j AS item FROM wide WHERE absent""")
def umts_ericsson_wide_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cells of the wide documents lack, found in the documents: no exchange."""
    merged = ericsson.cells(feeds.wide_documents(spark, sf_dir), WIDE_ENTRIES, "UMTS", keep_empty=True)
    node = F.regexp_extract("file_path", "MeContext=N([0-9]+)_", 1).cast("bigint")
    return quality.issues_of(merged, "missing").select(node.alias("doc"), "item")


@check(f"WITH {EVENTS} SELECT doc, cell_id, md, mv FROM umts WHERE cell_id IS NOT NULL AND rel_type IS NULL")
def cell_grain_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = with_relation(shred_md(feeds.mdc_documents(spark, sf_dir, "UMTS")))
    return grain_filter(objects).select("doc", "cell_id", "md", "mv")


NOKIA_FRONT = """'r' AS "MGR_RUN_ID", 'East' AS "Region", 'M1' AS "Market", 'OSS' || (doc % 5) AS "OSS",
strftime(period_start, '%Y-%m-%d %H:%M') AS "PERIOD_START_TIME", 15 AS "PERIOD_DURATION" """


def _val(code: str) -> str:
    return (f"coalesce((SELECT CAST(max(e.val) AS VARCHAR) FROM elements e WHERE e.event_id = n.event_id "
            f"AND e.code = '{code}'), '')")


@check(f"""WITH {LTE_OBJECTS}
SELECT {NOKIA_FRONT}, meas_type, cell AS "MO_DN", cell_2 AS "MO_DN2", CASE WHEN event_type = 'view' THEN neighbour ELSE '' END AS target,
  {_val('M8020C3')} || '|' || {_val('M8020C6')} || '|' || {_val('M8012C22')} || '|' || {_val('M8017C7')} || '|'
  || {_val('M8017C9')} || '|' || {_val('M8008C1')} AS shown
FROM nok2 n WHERE meas_type <> 'lte_unlisted'""")
def lte_nokia_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail reports of all LTE types of this vendor, put under each other to be compared at once."""
    staged = nokia.stage_objects(spark, feeds.lte_nokia_documents(spark, sf_dir), "LTE", LTE_CATALOG)
    rows = staged.filter(nokia.has_cell("LTE"))
    order = ["SAMPLES_CELL_AVAIL", "DENOM_CELL_AVAIL", "PDCP_DATA_RATE_MAX_UL", "ISYS_HO_UTRAN_ATT_NB",
             "ISYS_HO_UTRAN_FAIL_NB", "RRC_PAGING_REQUESTS"]
    result = None
    for meas_type, entries in LTE_CATALOG.items():
        report = nokia.lte_detail(rows, meas_type, entries, SETTINGS, "r")
        shown = F.concat_ws("|", *[F.col(c) if c in report.columns else F.lit("") for c in order])
        is_neighbour = "MO_DN_Source" in report.columns
        one = report.select(
            "MGR_RUN_ID", *nokia.COMMON_HEADER, F.lit(meas_type).alias("meas_type"),
            F.col("MO_DN_Source" if is_neighbour else "MO_DN").alias("MO_DN"), "MO_DN2",
            (F.col("MO_DN_Target") if is_neighbour else F.lit("")).alias("target"), shown.alias("shown"),
        )
        result = one if result is None else result.unionByName(one)
    return result


@check(f"""WITH {LTE_OBJECTS}
SELECT {NOKIA_FRONT}, cell_2 AS "MO_DN2", cell AS "MO_DN_Source", 'PLMN-PLMN/UTRAN-' || (event_id % 5) AS "MO_DN_Target",
  CAST(raw AS VARCHAR) AS "ISYS_HO_UTRAN_ATT_NB",
  CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(event_id % 100 AS VARCHAR) END AS "ISYS_HO_UTRAN_FAIL_NB"
FROM nok2 WHERE event_type = 'view'""")
def neighbour_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nokia.objects(feeds.lte_nokia_documents(spark, sf_dir), "LTE")
    t = "lte_isys_ho_utran_nb"
    return nokia.lte_detail(rows, t, LTE_CATALOG[t], SETTINGS, "r")


@check(f"""WITH {UMTS_OBJECTS}
SELECT {NOKIA_FRONT.replace("period_start", "file_time")}, meas_type, base_id AS "BASEID", local_moid AS "LOCALMOID",
  cell_id_1 AS "CELL_ID_1", cell_id_2 AS "CELL_ID_2", tr_class AS "TR_CLASS", tr_subclass AS "TR_SUBCLASS",
  ch_type AS "CHTYPE", CASE WHEN meas_type = 'rcpm_rlc_wcel'
    THEN raw || '|' || CASE WHEN event_id % 8 = 0 THEN '' ELSE CAST(raw % 77 AS VARCHAR) END ELSE CAST(raw AS VARCHAR) END AS shown
FROM nok""")
def umts_nokia_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail reports of all UMTS types of this vendor, put under each other to be compared at once."""
    rows = nokia.objects(feeds.umts_nokia_documents(spark, sf_dir), "UMTS").filter(nokia.has_cell("UMTS"))
    result = None
    for meas_type, entries in UMTS_CATALOG.items():
        report = nokia.umts_detail(rows, meas_type, entries, SETTINGS, "r")
        own = [e.column for e in entries[len(IDENTITY):]]
        kept = [c for c in report.columns if c not in own]
        one = report.select(*kept, F.lit(meas_type).alias("meas_type"), F.concat_ws("|", *own).alias("shown"))
        result = one if result is None else result.unionByName(one)
    return result


UMTS_SUM_KEYS = """base_id AS "BASEID", local_moid AS "LOCALMOID", cell_id_1 AS "CELL_ID_1", cell_id_2 AS "CELL_ID_2" """


UMTS_SUM_GROUPS = "doc, file_time, base_id, local_moid, cell_id_1, cell_id_2"


@check(f"""WITH {UMTS_OBJECTS},
 olpc AS (SELECT {UMTS_SUM_GROUPS}, {olpc_sums("raw", "event_id % 100", "(raw % 8 + 0.5)", "event_id % 9")}
          FROM nok WHERE meas_type = 'rcpm_olpc_wcel' GROUP BY {UMTS_SUM_GROUPS}),
 rlc AS (SELECT {UMTS_SUM_GROUPS}, {rlc_sums("raw", "event_id % 100", "raw % 1000", "CASE WHEN event_id % 8 <> 0 THEN raw % 77 END")}
         FROM nok WHERE meas_type = 'rcpm_rlc_wcel' GROUP BY {UMTS_SUM_GROUPS}),
 both_types AS (SELECT * FROM olpc UNION ALL BY NAME SELECT * FROM rlc)
SELECT {NOKIA_FRONT.replace("period_start", "file_time")}, {UMTS_SUM_KEYS}, * EXCLUDE ({UMTS_SUM_GROUPS}) FROM both_types""")
def umts_nokia_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic-class sums of both summed types per document and cell, from documents, under each other."""
    rows = nokia.objects(feeds.umts_nokia_documents(spark, sf_dir), "UMTS")
    olpc, rlc = (nokia.umts_class_summary(rows, t, None, SETTINGS, "r") for t in ("rcpm_olpc_wcel", "rcpm_rlc_wcel"))
    return olpc.unionByName(rlc, allowMissingColumns=True)


@check(f"""WITH {LTE_OBJECTS}
SELECT {NOKIA_FRONT}, cell_2 AS "MO_DN2", cell AS "MO_DN_Source",
  CAST(sum(raw) AS BIGINT) AS "ISYS_HO_UTRAN_ATT_NB",
  CAST(sum(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 100 END) AS BIGINT) AS "ISYS_HO_UTRAN_FAIL_NB"
FROM nok2 WHERE event_type = 'view' GROUP BY doc, period_start, cell, cell_2""")
def write_pm_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour sums written in the ``_sum`` layout and read back."""
    rows = nokia.objects(feeds.lte_nokia_documents(spark, sf_dir), "LTE")
    t = "lte_isys_ho_utran_nb"
    folder = shared_folder(spark, t)
    write_summary(nokia.lte_neighbour_summary(rows, t, LTE_CATALOG[t], SETTINGS, "r"), folder)
    return _read_back(spark, f"{folder}_sum", "|").selectExpr(
        "MGR_RUN_ID", "Region", "Market", "OSS", "PERIOD_START_TIME", "cast(PERIOD_DURATION as int) PERIOD_DURATION",
        "MO_DN2", "MO_DN_Source", "cast(ISYS_HO_UTRAN_ATT_NB as bigint) ISYS_HO_UTRAN_ATT_NB",
        "cast(ISYS_HO_UTRAN_FAIL_NB as bigint) ISYS_HO_UTRAN_FAIL_NB",
    )


def _read_back(spark: SparkSession, folder: str, sep: str) -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).option("nullValue", "\0").csv(folder)


@check(f"""WITH {LTE_OBJECTS}
SELECT {NOKIA_FRONT.replace("15 AS", "'15' AS")}, meas_type, cell AS "MO_DN", cell_2 AS "MO_DN2",
  CASE WHEN event_type = 'view' THEN neighbour ELSE '' END AS target,
  CASE meas_type WHEN 'lte_cell_avail' THEN {_val('M8020C3')} || '|' || {_val('M8020C6')} WHEN 'lte_cell_throughput' THEN {_val('M8012C22')}
    WHEN 'lte_isys_ho_utran_nb' THEN {_val('M8017C7')} || '|' || {_val('M8017C9')} ELSE {_val('M8008C1')} END AS shown
FROM nok2 n WHERE meas_type <> 'lte_unlisted'""")
def write_pm_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipe reports of all types, written, read back and put under each other."""
    staged = nokia.stage_objects(spark, feeds.lte_nokia_documents(spark, sf_dir), "LTE", LTE_CATALOG)
    rows, result = staged.filter(nokia.has_cell("LTE")), None
    for t, entries in LTE_CATALOG.items():
        folder = shared_folder(spark, t)
        write_report(nokia.lte_detail(rows, t, entries, SETTINGS, "r"), folder, "|")
        back = _read_back(spark, folder, "|")
        neighbour = "MO_DN_Source" in back.columns
        one = back.select(
            "MGR_RUN_ID", *nokia.COMMON_HEADER, F.lit(t).alias("meas_type"), F.col("MO_DN_Source" if neighbour else "MO_DN").alias("MO_DN"), "MO_DN2",
            (F.col("MO_DN_Target") if neighbour else F.lit("")).alias("target"), F.concat_ws("|", *[F.coalesce(e.column, F.lit("")) for e in entries]).alias("shown"))
        result = one if result is None else result.unionByName(one)
    return result


WANTED_SQL = """wanted AS (SELECT * FROM (VALUES ('lte_cell_avail', 0, 'M8020C3'), ('lte_cell_avail', 1, 'M8020C6'),
   ('lte_cell_throughput', 0, 'M8012C22'), ('lte_isys_ho_utran_nb', 0, 'M8017C7'),
   ('lte_isys_ho_utran_nb', 1, 'M8017C9'), ('lte_rrc', 0, 'M8008C1'), ('lte_rrc', 1, 'M8008C4')) w(meas_type, ordinal, code)),
 lacking AS (SELECT DISTINCT n.doc, n.meas_type, w.ordinal, w.code FROM nok2 n JOIN wanted w ON w.meas_type = n.meas_type
             LEFT JOIN elements e ON e.doc = n.doc AND e.object_pos = n.object_pos AND e.code = w.code WHERE e.code IS NULL),
 missing AS (SELECT doc, meas_type, string_agg(code, ',' ORDER BY ordinal) AS item FROM lacking GROUP BY doc, meas_type),
 beyond AS (SELECT DISTINCT doc, meas_type, code AS item FROM elements
            WHERE meas_type <> 'lte_unlisted' AND (meas_type, code) NOT IN (SELECT (meas_type, code) FROM wanted)),
 unlisted AS (SELECT doc, meas_type, string_agg(code, ',' ORDER BY code) AS item
              FROM (SELECT DISTINCT doc, meas_type, code FROM elements WHERE meas_type = 'lte_unlisted') GROUP BY doc, meas_type)"""
NOKIA_FILE = "'OSS' || (doc % 5) || '_PM_' || doc || '.xml'"
RRC_CATALOG = {**LTE_CATALOG, "lte_rrc": [*LTE_CATALOG["lte_rrc"], Counter("lte_rrc", 1, "M8008C4", "X")]}


def _lte_findings(spark: SparkSession, documents: DataFrame, catalog: dict[str, list[Counter]] = RRC_CATALOG) -> DataFrame:
    """All findings of LTE documents, unconfigured types listed."""
    return nokia.objects(documents, "LTE", True, catalog, Settings(list_unused=True))


@check(f"""WITH {LTE_OBJECTS}, {WANTED_SQL}, found AS (
  SELECT doc, meas_type, 'missing' AS kind, item, {NOKIA_FILE} || ': ElementsNotInXML=' || item AS message FROM missing
  UNION ALL SELECT doc, meas_type, 'not_used', item, item FROM beyond
  UNION ALL SELECT doc, meas_type, 'nothing_used', item, {NOKIA_FILE} || '=' || meas_type || ': ElementsNothingUse=' || item FROM unlisted
  UNION ALL SELECT doc, NULL, 'no_cell', CAST(count(*) AS VARCHAR), 'objects without a readable cell name' FROM nok2 WHERE cell_2 IS NULL GROUP BY doc)
SELECT * FROM found WHERE doc % 10 <> 7
UNION ALL SELECT DISTINCT doc, NULL, 'bad_file', {NOKIA_FILE}, 'document is not well-formed XML' FROM obj WHERE doc % 10 = 7
UNION ALL SELECT -1, NULL, 'settings', 'Market', 'Ini file Market option error.'""")
def write_pm_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of every kind, every tenth document being cut short, written by kind and read back."""
    documents = feeds.cut_short(feeds.lte_nokia_documents(spark, sf_dir))
    found = quality.issues_of(_lte_findings(spark, documents)).unionByName(quality.settings_issues(spark, Settings(absent=("Market",))))
    folder = shared_folder(spark, "issues")
    write_issues(found, folder)
    doc = F.coalesce(F.regexp_extract("file_path", "_PM_([0-9]+)", 1).try_cast("bigint"), F.lit(-1).cast("bigint"))
    return read_issues(spark, folder).select(doc.alias("doc"), "meas_type", "kind", "item", "message")


@check(f"""WITH {LTE_OBJECTS}, {WANTED_SQL}
SELECT doc, meas_type, item, {NOKIA_FILE} || ': ElementsNotInXML=' || item AS message FROM missing""")
def missing_counters_nokia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all objects of a document."""
    found = quality.issues_of(_lte_findings(spark, feeds.lte_nokia_documents(spark, sf_dir)), "missing")
    return found.select(_nokia_doc(), "meas_type", "item", "message")


def _nokia_doc() -> Column:
    return F.regexp_extract("file_path", "_PM_([0-9]+)", 1).cast("bigint").alias("doc")


@check(f"""WITH {LTE_OBJECTS}
SELECT DISTINCT doc, meas_type, code AS item FROM elements WHERE code IN ('M8020C77', 'M8017C9')""")
def elements_not_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all objects of a document; the neighbour type has its first counter configured only, so its second is not used."""
    catalog = {**LTE_CATALOG, "lte_isys_ho_utran_nb": LTE_CATALOG["lte_isys_ho_utran_nb"][:1]}
    found = quality.issues_of(_lte_findings(spark, feeds.lte_nokia_documents(spark, sf_dir), catalog), "not_used")
    return found.select(_nokia_doc(), "meas_type", "item")


@check(f"""WITH {LTE_OBJECTS}, {WANTED_SQL}
SELECT doc, meas_type, item, {NOKIA_FILE} || '=lte_unlisted: ElementsNothingUse=' || item AS message FROM unlisted""")
def unused_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all objects of a document."""
    found = quality.issues_of(_lte_findings(spark, feeds.lte_nokia_documents(spark, sf_dir)), "nothing_used")
    return found.select(_nokia_doc(), "meas_type", "item", "message")
