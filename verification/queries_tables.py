"""Names, identity, arrays, merging, sums and checks, straight over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.functions import arrays, identity, names
from pmweave.operators import quality, sums
from pmweave.operators.merge import merge_last as merge
from pmweave.operators.merge import widen
from pmweave.operators.project import project_configured as project
from pmweave.operators.project import report_column_rows
from pmweave.plans import ericsson, nokia
from pmweave.session import shared_folder
from pmweave.sources import read_counter_catalog as read_catalog
from pmweave.sources.catalog import Counter, Settings

from verification import feeds
from verification.feeds import text
from verification.registry import check
from verification.sql import CHANNEL_TYPE, TRAFFIC_CLASS, TRAFFIC_SUBCLASS, olpc_sums, pick, rlc_sums

SETTINGS = Settings(region="East", market="M1", hl_market="HM")

# ---- file names and periods, from orders ------------------------------------------------


def _padded(key, n: int = 2):
    return F.lpad(key.cast("string"), n, "0")


def _day(name: str):
    return F.substring(F.col(name).cast("string"), 1, 10)


def named_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a measurement file name each; every tenth prefix is empty."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    sign = F.when(key % 2 == 0, "-").otherwise("+")
    file_sign = F.when(key % 3 == 0, "-").otherwise("+")
    clock = text(_padded(key % 24), _padded(key % 4 * 15))
    name = text(
        F.when(cust % 10 == 0, "").otherwise(text("OSS", cust % 5)), "_", sign, _padded(key % 12), "30_A",
        F.translate(_day("o_orderdate"), "-", ""), ".", clock, file_sign, _padded(key % 5), "00-", clock, file_sign,
        _padded(key % 5), "00_SubNetwork=ROOT,SubNetwork=Area ", cust, ",MeContext=N", key, "_statsfile.xml",
    )
    orders = feeds.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", text("/landing/day/", name).alias("file_path"))


NAMED_SQL = """named AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_custkey % 10 = 0 THEN 'Unknown' ELSE 'OSS' || (o_custkey % 5) END AS oss,
         'Area ' || o_custkey AS sub_network, 'N' || o_orderkey AS me_context,
         CASE WHEN o_orderkey % 2 = 0 THEN -(o_orderkey % 12) ELSE o_orderkey % 12 END AS own,
         CASE WHEN o_orderkey % 3 = 0 THEN -(o_orderkey % 5) ELSE o_orderkey % 5 END AS file_off,
         date_trunc('day', o_orderdate) + to_minutes(CAST(o_orderkey % 24 * 60 + o_orderkey % 4 * 15 AS INTEGER)) AS file_time
  FROM orders),
local AS (SELECT *, file_time + to_hours(CAST(own - file_off AS INTEGER)) AS period_start FROM named)"""


@check(f"WITH {NAMED_SQL} SELECT o_orderkey, oss, sub_network, me_context, CAST(own AS INTEGER) AS own_offset, "
       "CAST(file_off AS INTEGER) AS file_offset, CAST(file_time AS TIMESTAMP) AS file_time FROM local")
def eric_file_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("file_path")
    return named_orders(spark, sf_dir).select(
        "o_orderkey", names.eric_oss(path).alias("oss"), names.eric_sub_network(path).alias("sub_network"),
        names.eric_me_context(path).alias("me_context"), names.eric_own_offset(path).alias("own_offset"),
        names.eric_file_offset(path).alias("file_offset"), names.eric_file_time(path).alias("file_time"),
    )


@check(f"WITH {NAMED_SQL} SELECT o_orderkey, CAST(period_start AS TIMESTAMP) AS period_start FROM local")
def period_to_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ericsson.eric_file_fields(named_orders(spark, sf_dir)).select("o_orderkey", "period_start")


@check(f"WITH {NAMED_SQL} SELECT o_orderkey, CAST(date_trunc('hour', period_start) AS TIMESTAMP) AS hour_start FROM local")
def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ericsson.eric_file_fields(named_orders(spark, sf_dir)).select("o_orderkey", "hour_start")


@check(f"""WITH {NAMED_SQL}
SELECT o_orderkey, strftime(date_trunc('hour', period_start), '%Y-%m-%d %H:%M') AS "HL_DATE", 'HM' AS "HL_MARKET", '1' AS "Cntr",
  'East' AS "Region", 'M1' AS "Market", sub_network AS "SubNetwork_2",
  strftime(period_start, '%Y-%m-%d %H:%M') AS "PERIOD_START_TIME", '15' AS "PERIOD_DURATION", me_context AS "MeContext",
  oss AS "OSSName" FROM local""")
def common_columns_eric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ericsson.eric_file_fields(named_orders(spark, sf_dir))
    return rows.select("o_orderkey", *ericsson.common_columns_eric(SETTINGS))


@check("SELECT o_orderkey, 'OSS' || (o_custkey % 5) AS oss FROM orders")
def nokia_file_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    slash = F.when(key % 2 == 0, "/").otherwise("\\")
    files = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", text("in", slash, "day_1", slash, "OSS", cust % 5, "_PM_", key, ".xml").alias("file_path")
    )
    return nokia.nokia_file_fields(files).select("o_orderkey", "oss")


def _headed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the header attributes of a document; some intervals are not numbers."""
    key = F.col("o_orderkey")
    return feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text(_day("o_orderdate"), "T", _padded(key % 24), ":", _padded(key % 4 * 15),
             F.when(key % 3 == 0, "").otherwise(":00.000-04:00")).alias("start_time"),
        F.when(key % 7 == 0, "hourly").otherwise((key % 4 * 15).cast("string")).alias("interval"),
        text("OSS", key % 3).alias("oss"),
    )


HEADED_SQL = """headed AS (
  SELECT o_orderkey, 'OSS' || (o_orderkey % 3) AS oss,
         date_trunc('day', o_orderdate) + to_minutes(CAST(o_orderkey % 24 * 60 + o_orderkey % 4 * 15 AS INTEGER)) AS period_start,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 4 * 15 AS INTEGER) END AS duration_min
  FROM orders)"""


@check(f"WITH {HEADED_SQL} SELECT o_orderkey, CAST(period_start AS TIMESTAMP) AS period_start, duration_min FROM headed")
def nokia_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nokia.nokia_period(_headed_orders(spark, sf_dir)).select("o_orderkey", "period_start", "duration_min")


@check(f"""WITH {HEADED_SQL}
SELECT o_orderkey, 'East' AS "Region", 'M1' AS "Market", oss AS "OSS",
  strftime(period_start, '%Y-%m-%d %H:%M') AS "PERIOD_START_TIME", duration_min AS "PERIOD_DURATION" FROM headed""")
def common_columns_nokia(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = nokia.nokia_period(_headed_orders(spark, sf_dir))
    return rows.select("o_orderkey", *nokia.common_columns_nokia(SETTINGS))


@check("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Reg' || event_type ELSE 'm' || event_id || 'c' || (event_id % 50) END AS code,
  'lte_' || event_type AS meas_type FROM events""")
def canonical_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    code = (
        F.when(event % 3 == 0, text("Reg", F.col("event_type")))
        .when(event % 3 == 1, text("M", event, "C", event % 50)).otherwise(text("m", event, "c", event % 50))
    )
    return feeds.table(spark, sf_dir, "events").select(
        "event_id", names.canonical_counter(code).alias("code"),
        names.canonical_type(text("LTE_", F.initcap("event_type"))).alias("meas_type"),
    )


# ---- object identity, from customer and orders --------------------------------------------


def _moids(spark: SparkSession, sf_dir: str, keyword: str) -> DataFrame:
    """Object names: a cell at the end, in the middle, before a blank, or none."""
    key = F.col("c_custkey")
    front = text("SubNetwork=", F.col("c_nationkey"), ",ManagedElement=1,")
    cell = text(front, keyword, "=", F.col("c_name"))
    moid = (
        F.when(key % 5 == 0, front).when(key % 5 == 1, cell).when(key % 5 == 2, text(cell, " rest"))
        .when(key % 5 == 3, text(cell, ",Sector=", key)).otherwise(text(keyword, "=", F.col("c_name"), ",X=1"))
    )
    return feeds.table(spark, sf_dir, "customer").select("c_custkey", moid.alias("moid"))


CELL_SQL = "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS cell_id FROM customer"


@check(CELL_SQL)
def eric_cell_id_lte(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moids(spark, sf_dir, "EUtranCellFDD").select(
        "c_custkey", identity.eric_cell_id_lte(F.col("moid")).alias("cell_id"))


@check("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS cell_id, "
       "CAST(NULL AS VARCHAR) AS other_keyword FROM customer")
def eric_cell_id_umts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword of one technology does not match inside the other's."""
    moid, lte_moid = F.col("moid"), F.replace(F.col("moid"), F.lit("UtranCell="), F.lit("EUtranCellFDD="))
    return _moids(spark, sf_dir, "UtranCell").select(
        "c_custkey", identity.eric_cell_id_umts(moid).alias("cell_id"),
        identity.eric_cell_id_umts(lte_moid).alias("other_keyword"),
    )


@check("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN 'ltecell' WHEN 2 THEN 'umtscell' WHEN 3 THEN 'gsmcell' END AS rel_type,
  CASE WHEN o_orderkey % 6 IN (1, 2, 3) THEN CAST(o_custkey AS VARCHAR) END AS freq_rel,
  CASE WHEN o_orderkey % 6 IN (1, 2, 3) THEN 'R' || o_orderkey END AS cell_rel FROM orders""")
def eric_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three relation tables; a frequency part alone, no relation and no cell give none."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cell = text("RncFunction=1,UtranCell=U", key)

    def below(freq: str, relation: str):
        return text(cell, f",{freq}=", cust, f",{relation}=R", key, ",X=1")

    moid = (
        F.when(key % 6 == 0, cell)
        .when(key % 6 == 1, below("EUtranFreqRelation", "EUtranCellRelation"))
        .when(key % 6 == 2, below("UtranFreqRelation", "UtranCellRelation"))
        .when(key % 6 == 3, below("GeranFreqGroupRelation", "GeranCellRelation"))
        .when(key % 6 == 4, text(cell, ",UtranFreqRelation=", cust))
        .otherwise(text("RncFunction=1,UtranFreqRelation=", cust, ",UtranCellRelation=", key))
    )
    relation = identity.eric_relation(moid)
    return feeds.table(spark, sf_dir, "orders").select("o_orderkey", relation.alias("r")).select("o_orderkey", "r.*")


def _managed(dn=None, base=None, local=None):
    none = F.lit(None).cast("string")
    return F.struct(
        (none if dn is None else dn).alias("DN"), (none if base is None else base).alias("baseId"),
        (none if local is None else local).alias("localMoid"),
    )


def _lte_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as LTE objects: the cell by DN, by two parts, or unreadable; every third has a neighbour."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    cell = (
        F.when(key % 4 < 2, _managed(dn=text("PLMN-PLMN/MRBTS-", cust, "/LNBTS-", cust, "/LNCEL-", key % 9)))
        .when(key % 4 == 2, _managed(base=text("NE-MRBTS-", cust), local=text("DN:NE-LNBTS-", cust, "/LNCEL-", key % 9)))
        .otherwise(_managed(dn=text("PLMN-PLMN/MRBTS-", cust)))
    )
    plmn = _managed(dn=text("PLMN-PLMN/MCC-310/MNC-", key % 3 + 260))
    third = F.when(key % 2 == 0, _managed(dn=text("PLMN-PLMN/N-", key))).otherwise(_managed(local=text("L-", key)))
    mo = F.when(key % 3 == 0, F.array(cell, plmn, third)).when(key % 3 == 1, F.array(cell, plmn)).otherwise(F.array(cell))
    return feeds.table(spark, sf_dir, "orders").select("o_orderkey", mo.alias("mo"))


@check("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'PLMN-PLMN/MRBTS-' || o_custkey
  ELSE 'PLMN-PLMN/MRBTS-' || o_custkey || '/LNBTS-' || o_custkey || '/LNCEL-' || (o_orderkey % 9) END AS cell_id FROM orders""")
def nokia_lte_cell_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lte_objects(spark, sf_dir).select("o_orderkey", identity.nokia_lte_cell_id(F.col("mo")).alias("cell_id"))


@check("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE '310' || (o_orderkey % 3 + 260) END AS plmn FROM orders")
def nokia_lte_plmn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lte_objects(spark, sf_dir).select("o_orderkey", identity.nokia_lte_plmn(F.col("mo")).alias("plmn"))


@check("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL
  ELSE CASE WHEN o_orderkey % 3 = 2 THEN '' ELSE '310' || (o_orderkey % 3 + 260) END || '-' || o_custkey || '-' || (o_orderkey % 9)
  END AS cell_id_2 FROM orders""")
def nokia_lte_cell_id_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mo = F.col("mo")
    cell_2 = identity.nokia_lte_cell_id_2(identity.nokia_lte_plmn(mo), identity.nokia_lte_cell_id(mo))
    return _lte_objects(spark, sf_dir).select("o_orderkey", cell_2.alias("cell_id_2"))


@check("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'PLMN-PLMN/N-' || o_orderkey
  ELSE 'L-' || o_orderkey END AS neighbour FROM orders""")
def nokia_neighbour_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lte_objects(spark, sf_dir).select(
        "o_orderkey", identity.nokia_neighbour_target(F.col("mo")).alias("neighbour"))


@check("""SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 2 THEN 'WBTS' ELSE 'NE-WBTS-' || o_custkey || '/WCEL-' || (o_orderkey % 9) END AS local_moid,
  CASE o_orderkey % 3 WHEN 0 THEN 'PLMN-PLMN/RNC-' || (o_custkey % 50) || '/WBTS-' || o_custkey || '/WCEL-' || (o_orderkey % 9)
       WHEN 1 THEN '' ELSE 'PLMN-PLMN/RNC-' || (o_custkey % 50) || '/WBTS' END AS cell_id_1,
  CASE o_orderkey % 3 WHEN 0 THEN (o_custkey % 50) || '-' || o_custkey || '-' || (o_orderkey % 9)
       WHEN 1 THEN 'NE-WBTS-' || o_custkey || '/WCEL-' || (o_orderkey % 9) ELSE 'WBTS' END AS cell_id_2 FROM orders""")
def nokia_umts_cell_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several managed objects the last with a name counts; a missing base or a short name falls back."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    base, full = text("NE-RNC-", cust % 50), text("DN:NE-WBTS-", cust, "/WCEL-", key % 9)
    mo = (
        F.when(key % 3 == 0, F.array(_managed(base=F.lit("NE-RNC-0"), local=F.lit("DN:NE-X-1/Y-2")), _managed(base=base, local=full),
                                     _managed(dn=F.lit("PLMN-PLMN/Z-1"))))
        .when(key % 3 == 1, F.array(_managed(local=full)))
        .otherwise(F.array(_managed(base=base, local=F.lit("WBTS"))))
    )
    named = feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", identity.nokia_base_id(mo).alias("b"), identity.nokia_local_moid(mo).alias("local_moid"))
    b, m = F.col("b"), F.col("local_moid")
    return named.select(
        "o_orderkey", "local_moid", identity.nokia_umts_cell_id_1(b, m).alias("cell_id_1"),
        identity.nokia_umts_cell_id_2(b, m).alias("cell_id_2"))


@check(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE {pick('o_orderkey', *TRAFFIC_CLASS)} END AS tr_class,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE {pick('o_orderkey', *TRAFFIC_SUBCLASS)} END AS tr_subclass,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE {pick('o_orderkey', *CHANNEL_TYPE)} END AS ch_type FROM orders""")
def nokia_traffic_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    traffic = text(
        "PLMN-PLMN/TR_CLASS-", feeds.traffic_class(key), "/TR_SUBCLASS-", feeds.traffic_subclass(key))
    channel = text("PLMN-PLMN/ChType-", feeds.channel_type(key))
    mo = F.array(
        _managed(base=F.lit("NE-RNC-1"), local=F.lit("DN:NE-WBTS-1/WCEL-1")),
        F.when(key % 4 == 0, _managed(dn=F.lit("PLMN-PLMN/A-1"))).otherwise(_managed(dn=traffic)),
        F.when(key % 5 == 0, _managed(dn=F.lit("PLMN-PLMN/B-1"))).otherwise(_managed(dn=channel)),
    )
    return feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", identity.nokia_traffic_class(mo).alias("c")).select("o_orderkey", "c.*")


# ---- counter kinds and arrays, from orders ---------------------------------------------------

KIND_SQL = "CASE o_orderkey % 5 WHEN 0 THEN 'Single' WHEN 1 THEN 'PDF' WHEN 2 THEN 'COMP' WHEN 3 THEN 'SPECIAL' END"
DIM_SQL = ("CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN o_custkey % 40 + 2 WHEN 2 THEN o_custkey % 40 + 2 "
           "WHEN 3 THEN 10 END")


def _spec(other: str):
    key, size = F.col("o_orderkey"), F.col("o_custkey") % 40 + 2
    return (
        F.when(key % 5 == 0, "Single").when(key % 5 == 1, text("PDF[", size, "]"))
        .when(key % 5 == 2, text("COMP[", size, "]")).when(key % 5 == 3, "SPECIAL").otherwise(other)
    )


@check(f"SELECT o_orderkey, {KIND_SQL} AS kind, CAST({DIM_SQL} AS INTEGER) AS dim FROM orders")
def counter_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec("FOO")
    return feeds.table(spark, sf_dir, "orders").select(
        "o_orderkey", arrays.counter_kind(spec).alias("kind"), arrays.counter_dim(spec).alias("dim"))


def _catalog_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of catalog files written out of orders: a table line per 20 order keys. A list below another section is no table."""
    key = F.col("o_orderkey")
    entries = feeds.table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey div 20").alias("bucket"), key.alias("at"), text("pmC", key, ":", _spec("Single")).alias("entry"))
    lines = entries.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("at", "entry"))).alias("e"))
    folder = shared_folder(spark, "catalog")
    lines.select(F.explode(F.array(
        F.lit("[General]"), F.lit("; a comment = x:Single"), F.lit("Region=East"), F.lit("Other=a:Single,b:Single"), F.lit("[Table]"),
        text("TAB", F.col("bucket"), "=", F.array_join(F.col("e")["entry"], ",")),
    )).alias("value")).write.text(folder)
    return folder


@check(f"""SELECT 'tab' || (o_orderkey // 20) AS table_name,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) - 1 AS INTEGER) AS ordinal,
  'pmC' || o_orderkey AS code, coalesce({KIND_SQL}, 'Single') AS kind, CAST(coalesce({DIM_SQL}, 1) AS INTEGER) AS dim FROM orders""")
def read_counter_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = read_catalog(spark, _catalog_folder(spark, sf_dir), "ericsson")
    return catalog.select("table_name", "ordinal", "code", "kind", "dim")


def _values_sql(n: int, value: str, prefix: str = "v") -> str:
    return ", ".join(f"{value.format(i=i)} AS {prefix}{i}" for i in range(n))


def _spread(frame: DataFrame, column, n: int) -> DataFrame:
    return frame.select("o_orderkey", column.alias("v")).select(
        "o_orderkey", *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(n)])


def _listed(key, n):
    """Values key, key+1, ... of an n-long list; the second is blank on every third order."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), n - 1),
            lambda i: F.when((i == 1) & (key % 3 == 0), F.lit("")).otherwise((key + i).cast("string")),
        ), ",")


@check("SELECT o_orderkey, " + _values_sql(
    4, "CASE WHEN {i} > o_custkey % 6 OR ({i} = 1 AND o_orderkey % 3 = 0) THEN '0' ELSE CAST(o_orderkey + {i} AS VARCHAR) END"
) + " FROM orders")
def expand_pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of one to six values to four columns."""
    raw = _listed(F.col("o_orderkey"), F.col("o_custkey") % 6 + 1)
    return _spread(feeds.table(spark, sf_dir, "orders"), arrays.expand_pdf(raw, 4), 4)


@check("SELECT o_orderkey, " + _values_sql(
    10, "CASE WHEN {i} > o_custkey % 15 THEN '0' WHEN {i} = 1 AND o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey + {i} AS VARCHAR) END"
) + " FROM orders")
def expand_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of one to fifteen values to the fixed ten."""
    raw = _listed(F.col("o_orderkey"), F.col("o_custkey") % 15 + 1)
    return _spread(feeds.table(spark, sf_dir, "orders"), arrays.expand_special(raw), 10)


@check("SELECT o_orderkey, " + _values_sql(10, """CASE o_orderkey % 4 WHEN 0 THEN '0'
  WHEN 1 THEN CASE WHEN {i} = o_custkey % 13 THEN CAST(o_orderkey AS VARCHAR) ELSE '0' END
  WHEN 2 THEN CASE WHEN {i} = o_custkey % 10 THEN 'b' || o_custkey ELSE '0' END
  ELSE CASE WHEN {i} = 2 THEN 'x' WHEN {i} = 7 THEN 'y' ELSE '0' END END""") + " FROM orders")
def expand_comp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty, single (index may be too large), repeated and short sparse lists."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    raw = (
        F.when(key % 4 == 0, F.lit("0"))
        .when(key % 4 == 1, text("1,", cust % 13, ",", key))
        .when(key % 4 == 2, text("2,", cust % 10, ",a,", cust % 10, ",b", cust))
        .otherwise("5,2,x,7,y")
    )
    return _spread(feeds.table(spark, sf_dir, "orders"), arrays.expand_comp(raw, 10), 10)


LENGTH_ENTRIES = [
    Counter("t", 0, "pmFixed", "pmFixed", "PDF", 3), Counter("t", 1, "pmScalar", "pmScalar"),
    Counter("t", 2, "pmSparse", "pmSparse", "COMP", 4),
]


@check("""SELECT DISTINCT 'F' || o_custkey AS file_path, item, message FROM (
  SELECT o_custkey, 'pmFixed' AS item, 'IE:pmFixed has more elemments than configured' AS message FROM orders
  WHERE o_orderkey % 3 = 0 AND o_custkey % 6 + 1 > 3
  UNION ALL SELECT o_custkey, 'pmFixed', 'IE:pmFixed has less elemments than configured' FROM orders
  WHERE o_orderkey % 3 = 0 AND o_custkey % 6 + 1 < 3
  UNION ALL SELECT o_custkey, 'pmScalar', 'IE:pmScalar has more elemments than configured' FROM orders
  WHERE o_orderkey % 3 = 1 AND o_custkey % 6 + 1 > 1
  UNION ALL SELECT o_custkey, 'pmSparse', 'IE:pmSparse has less elemments than configured' FROM orders
  WHERE o_orderkey % 3 = 2 AND 2 * (o_orderkey) + 1 > o_custkey % 6 + 1
  UNION ALL SELECT o_custkey, 'pmSparse', 'IE:pmSparse has more elemments than configured' FROM orders
  WHERE o_orderkey % 3 = 2 AND 2 * o_orderkey + 1 <= o_custkey % 6 + 1
    AND (2 * o_orderkey + 1 < o_custkey % 6 + 1 OR 3 * o_orderkey - 1 > 3))""")
def array_length_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    raw = F.array_join(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("o_custkey") % 6), lambda i: (key + i).cast("string")), ",")
    pm_long = feeds.table(spark, sf_dir, "orders").select(
        text("F", F.col("o_custkey")).alias("file_path"),
        feeds.pick(key, "pmFixed", "pmScalar", "pmSparse").alias("counter"), raw.alias("raw"))
    return quality.array_length_issues(pm_long, LENGTH_ENTRIES).select("file_path", "item", "message")


# ---- merging and projection, from events --------------------------------------------------------

TYPES = ["click", "error", "purchase", "signup", "view"]
TALL_SQL = """tall AS (
  SELECT strftime(ts, '%Y-%m-%d') AS file_path, 'C' || user_id AS cell_id, event_type AS counter, event_id,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS raw FROM events),
merged AS (SELECT file_path, cell_id, counter, arg_max(raw, event_id) AS raw FROM tall GROUP BY ALL)"""
KEYS = ["file_path", "cell_id"]


@check(f"WITH {TALL_SQL} SELECT file_path, cell_id, counter, raw FROM merged")
def merge_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge(feeds.tall_events(spark, sf_dir), KEYS)


SHOWN = [Counter("t", i, c, f"n_{c}") for i, c in enumerate(["view", "click", "error", "never"])]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen(merge_last(spark, sf_dir), KEYS, [e.code for e in SHOWN])


@check(f"""WITH {TALL_SQL} SELECT file_path, cell_id,
  coalesce(max(CASE WHEN counter = 'view' THEN raw END), '0') AS n_view,
  coalesce(max(CASE WHEN counter = 'click' THEN raw END), '0') AS n_click,
  coalesce(max(CASE WHEN counter = 'error' THEN raw END), '0') AS n_error, '0' AS n_never
FROM merged GROUP BY file_path, cell_id""")
def project_configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_wide(spark, sf_dir), SHOWN, KEYS, absent="0")


@check(f"""WITH c AS (SELECT o_orderkey, 'tab' || (o_orderkey // 20) AS table_name,
    CAST(row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) - 1 AS INTEGER) AS ordinal,
    CAST(coalesce({DIM_SQL}, 1) AS INTEGER) AS dim FROM orders),
  e AS (SELECT *, unnest(range(0, dim)) AS element FROM c)
SELECT table_name, ordinal, CAST(element AS INTEGER) AS element,
  'pmC' || o_orderkey || CASE WHEN dim = 1 THEN '' ELSE '_' || element END AS column_name FROM e""")
def report_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of every table of a written catalog, as rows; the list form of the same rule names the reports' columns."""
    return report_column_rows(read_catalog(spark, _catalog_folder(spark, sf_dir), "ericsson"))


@check(f"""WITH {TALL_SQL}, cells AS (SELECT DISTINCT file_path, cell_id FROM merged)
SELECT DISTINCT c.file_path, w.code AS item, 'IE:' || w.code || ' not found from xml input; set 0 instead' AS message
FROM cells c CROSS JOIN (VALUES ('view'), ('click'), ('error'), ('never')) w(code)
LEFT JOIN merged m ON m.file_path = c.file_path AND m.cell_id = c.cell_id AND m.counter = w.code WHERE m.raw IS NULL""")
def missing_counters_eric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_counters_eric(_wide(spark, sf_dir), SHOWN).select("file_path", "item", "message")


@check(f"""WITH {TALL_SQL}, cells AS (SELECT DISTINCT file_path, cell_id FROM merged)
SELECT 'IE:' || w.code || ' not found from xml input; set 0 instead' AS message, min(c.file_path) AS file_path
FROM cells c CROSS JOIN (VALUES ('view'), ('click'), ('error'), ('never')) w(code)
LEFT JOIN merged m ON m.file_path = c.file_path AND m.cell_id = c.cell_id AND m.counter = w.code WHERE m.raw IS NULL GROUP BY w.code""")
def dedupe_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedupe_issues(quality.missing_counters_eric(_wide(spark, sf_dir), SHOWN))


@check(f"WITH {TALL_SQL} SELECT counter AS meas_type, file_path, count(*) AS n, CAST(sum(CAST(raw AS BIGINT)) AS BIGINT) AS total "
       "FROM tall GROUP BY counter, file_path")
def split_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type in one partitioned table; each type's frame prunes to its own folder."""
    folder = shared_folder(spark, "types")
    rows = feeds.tall_events(spark, sf_dir).withColumnRenamed("counter", "meas_type").drop("pos")
    rows.hint("rebalance", "meas_type").write.partitionBy("meas_type").parquet(folder)
    staged = spark.read.schema(rows.schema).parquet(folder)
    result = None
    for frame in sums.split_by_type(staged, TYPES).values():
        one = frame.groupBy("meas_type", "file_path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("raw").cast("bigint")).alias("total"))
        result = one if result is None else result.unionByName(one)
    return result


# ---- sums, from lineitem ---------------------------------------------------------------------------

NEIGHBOUR_ENTRIES = [
    Counter("nb", 0, "M8017C7", "ISYS_HO_UTRAN_ATT_NB"), Counter("nb", 1, "M8017C9", "ISYS_HO_UTRAN_FAIL_NB"),
    Counter("nb", 2, "M8017C11", "ISYS_HO_UTRAN_SRVCC_ATT_NB"),
]


@check("""SELECT 'S' || (l_suppkey % 10) AS file_path, 'PLMN-PLMN/MRBTS-1/LNBTS-' || l_orderkey || '/LNCEL-1' AS cell_id,
  '310260-' || l_orderkey || '-1' AS cell_id_2, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS "ISYS_HO_UTRAN_ATT_NB",
  CAST(sum(CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_partkey END) AS BIGINT) AS "ISYS_HO_UTRAN_FAIL_NB",
  CAST(0 AS BIGINT) AS "ISYS_HO_UTRAN_SRVCC_ATT_NB" FROM lineitem GROUP BY l_suppkey % 10, l_orderkey""")
def neighbour_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sums.only_neighbour_types(feeds.neighbour_objects(spark, sf_dir))
    return sums.neighbour_sum(rows, NEIGHBOUR_ENTRIES, ["file_path", "cell_id", "cell_id_2"])


CLASS_SQL = f"""cls AS (
  SELECT 'S' || (l_suppkey % 10) AS file_path, l_orderkey AS cell, l_partkey, l_suppkey, l_linenumber,
         CAST(l_quantity AS BIGINT) AS qty, {pick('l_linenumber', *TRAFFIC_CLASS)} AS tr_class,
         CASE WHEN l_linestatus = 'F' THEN {pick('l_linenumber', *TRAFFIC_SUBCLASS)} ELSE 'PS_NRT_data' END AS tr_subclass,
         CASE l_returnflag WHEN 'A' THEN 'DCH' WHEN 'R' THEN 'HSUPA' ELSE 'HSDPA' END AS ch_type
  FROM lineitem)"""


@check(f"WITH {CLASS_SQL} SELECT file_path, cell, {rlc_sums('l_partkey', 'qty', 'l_suppkey', 'l_linenumber')} "
       "FROM cls GROUP BY file_path, cell")
def rlc_class_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sums.rlc_class_sum(feeds.class_objects(spark, sf_dir), ["file_path", "cell"])


@check(f"WITH {CLASS_SQL} SELECT file_path, cell, {olpc_sums('l_partkey', 'qty', '(qty + 0.5)', 'l_linenumber')} "
       "FROM cls GROUP BY file_path, cell")
def olpc_class_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sums.olpc_class_sum(feeds.class_objects(spark, sf_dir), ["file_path", "cell"])


RELATION_ENTRIES = [Counter("r", 0, "pmA", "pmA"), Counter("r", 1, "pmB", "pmB", "PDF", 2)]


@check(f"""SELECT {pick('l_linenumber', 'ltecell', 'umtscell', 'gsmcell')} AS rel_type, l_orderkey AS cell_id,
  CAST(sum(l_partkey) AS BIGINT) AS "pmA", CAST(sum(l_suppkey) AS BIGINT) AS "pmB_0", CAST(sum(l_linenumber) AS BIGINT) AS "pmB_1"
FROM lineitem GROUP BY 1, 2""")
def relation_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    relations = feeds.table(spark, sf_dir, "lineitem").select(
        feeds.pick(line, "ltecell", "umtscell", "gsmcell").alias("rel_type"), F.col("l_orderkey").alias("cell_id"),
        F.create_map(
            F.lit("pmA"), F.col("l_partkey").cast("string"), F.lit("pmB"), text(F.col("l_suppkey"), ",", line)
        ).alias("counters"))
    rows = project(relations, RELATION_ENTRIES, ["rel_type", "cell_id"], absent="0")
    return sums.relation_sum(rows, RELATION_ENTRIES, ["rel_type", "cell_id"])
