"""Nokia jobs: one pipe report per measurement type, plus neighbour or traffic-class sums.

Objects are shredded and named once. What is wrong with a document is found where it is parsed, and of its
objects only configured types with configured values go on to the table partitioned by ``meas_type``, of
which every report reads its own partition.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.functions import identity, names
from pmweave.operators import quality, sums
from pmweave.operators.project import NEIGHBOUR_TYPES, neighbour_columns, project_configured
from pmweave.operators.shred import shred_nokia_lte, shred_nokia_umts
from pmweave.session import shared_folder
from pmweave.sinks import publication, with_run_id, write_pm_issues, write_pm_report, write_pm_summary
from pmweave.sinks.reports import NOKIA_SEP, RUN_ID
from pmweave.sources.catalog import Counter, Settings

# Report header in front of the counters.
COMMON_HEADER = ["Region", "Market", "OSS", "PERIOD_START_TIME", "PERIOD_DURATION"]
SUM_SUFFIX = "sum"
SUM_IDENTITY = {"base_id": "BASEID", "local_moid": "LOCALMOID", "cell_id_1": "CELL_ID_1", "cell_id_2": "CELL_ID_2"}
TRAFFIC_FIELDS = ("tr_class", "tr_subclass", "ch_type")
FILE_KEYS = ["file_path", "oss", "period_start", "duration_min"]


def nokia_file_fields(files: DataFrame) -> DataFrame:
    return files.select("*", names.nokia_oss(F.col("file_path")).alias("oss"))


def nokia_period(objects: DataFrame) -> DataFrame:
    """Replace the header attributes by ``period_start`` and ``duration_min``."""
    kept = [c for c in objects.columns if c not in ("start_time", "interval")]
    return objects.select(
        *kept,
        names.nokia_start(F.col("start_time")).alias("period_start"),
        names.nokia_duration(F.col("interval")).alias("duration_min"),
    )


def common_columns_nokia(settings: Settings) -> list[Column]:
    values = [
        F.lit(settings.region), F.lit(settings.market), F.col("oss"),
        names.minute_text(F.col("period_start")), F.col("duration_min"),
    ]
    return [v.alias(n) for v, n in zip(values, COMMON_HEADER, strict=True)]


def lte_identity(mo: Column) -> dict[str, Column]:
    """Identity columns of a managed object: ``cell_id, plmn, neighbour, cell_id_2``."""
    cell_id, plmn = identity.nokia_lte_cell_id(mo), identity.nokia_lte_plmn(mo)
    return {
        "cell_id": cell_id, "plmn": plmn, "neighbour": identity.nokia_neighbour_target(mo),
        "cell_id_2": identity.nokia_lte_cell_id_2(plmn, cell_id),
    }


def umts_identity(mo: Column) -> dict[str, Column]:
    """Identity columns of a managed object: ``base_id, local_moid, cell_id_1, cell_id_2`` and the traffic class."""
    base_id, local_moid, traffic = identity.nokia_base_id(mo), identity.nokia_local_moid(mo), identity.nokia_traffic_class(mo)
    return {
        "base_id": base_id, "local_moid": local_moid,
        "cell_id_1": identity.nokia_umts_cell_id_1(base_id, local_moid), "cell_id_2": identity.nokia_umts_cell_id_2(base_id, local_moid),
        **{name: traffic[name] for name in TRAFFIC_FIELDS},
    }


def canonical_entries(entries: list[Counter]) -> list[Counter]:
    """UMTS catalog entries with their codes as documents' codes are compared."""
    return [replace(e, code=names.canonical_code(e.code)) for e in entries]


def catalog_of(catalog: dict[str, list[Counter]], technology: str) -> dict[str, list[Counter]]:
    return {t: canonical_entries(entries) for t, entries in catalog.items()} if technology == "UMTS" else catalog


def wanted_counters(catalog: dict[str, list[Counter]]) -> dict[str, list[str]]:
    """Per configured type the codes that its reports and sums read."""
    return {t: list(dict.fromkeys([*(e.code for e in entries), *sums.SUMMED_CODES.get(t, ())])) for t, entries in catalog.items()}


def objects(
    files: DataFrame, technology: str, keep_empty: bool = False, catalog: dict[str, list[Counter]] | None = None,
    settings: Settings | None = None, **limits,
) -> DataFrame:
    """Named objects of every document, counters as a map.

    With ``catalog`` (and ``keep_empty``) a document's first row holds its ``findings``, ``limits`` going to
    ``quality.nokia_findings``; objects keep configured counters only, and those of other types are left out but for first rows.
    """
    umts = technology == "UMTS"
    identify, shred = (umts_identity, shred_nokia_umts) if umts else (lte_identity, shred_nokia_lte)
    findings = None
    if catalog is not None:
        settings, catalog = settings or Settings(), catalog_of(catalog, technology)
        findings = quality.nokia_findings(
            catalog, identify, cell_column(technology), names.nokia_start, settings.list_not_used, settings.list_unused, **limits)
    rows = nokia_period(shred(nokia_file_fields(files), keep_empty, findings))
    if catalog is not None:
        rows = _configured_only(rows, wanted_counters(catalog))
    kept = [c for c in rows.columns if c not in ("mo", "findings")]
    found = [F.when(F.col("findings").isNotNull(), F.concat(
        "findings", quality.if_so(F.col("corrupt"), quality.bad_file(F.col("file_path"))))).alias("findings")] if findings else []
    return rows.select(*kept, *[c.alias(n) for n, c in identify(F.col("mo")).items()], *found)


def _configured_only(rows: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    chosen = F
    for table, codes in wanted.items():
        chosen = chosen.when(F.col("meas_type") == table, F.array(*[F.lit(c) for c in codes]))
    codes = chosen if wanted else F.lit(None).cast("array<string>")
    listed = F.map_filter("counters", lambda k, v: F.coalesce(F.array_contains(codes, k), F.lit(False)))
    needed = F.col("meas_type").isin(*wanted) | F.col("findings").isNotNull()
    return rows.filter(needed).withColumn("counters", listed)


def cell_column(technology: str) -> str:
    """The identity column that is null where an object names no cell."""
    return "local_moid" if technology == "UMTS" else "cell_id_2"


def has_cell(technology: str) -> Column:
    return F.col(cell_column(technology)).isNotNull()


def lte_detail(rows: DataFrame, table: str, entries: list[Counter], settings: Settings, run_id: str) -> DataFrame:
    """Detail report of one LTE type. Neighbour tables carry source and target cell."""
    of_type = rows.filter(F.col("meas_type") == table)
    common = common_columns_nokia(settings)
    if table in NEIGHBOUR_TYPES:
        shaped = neighbour_columns(
            of_type.select(
                *common, F.col("cell_id_2").alias("MO_DN2"), F.col("cell_id").alias("MO_DN"),
                F.coalesce("neighbour", F.lit("")).alias("neighbour"), "counters",
            )
        )
        kept = [*COMMON_HEADER, "MO_DN2", "MO_DN_Source", "MO_DN_Target"]
    else:
        shaped = of_type.select(
            *common, F.col("cell_id").alias("MO_DN"), F.col("cell_id_2").alias("MO_DN2"), "counters"
        )
        kept = [*COMMON_HEADER, "MO_DN", "MO_DN2"]
    return with_run_id(project_configured(shaped, entries, kept, absent=""), run_id)


def lte_neighbour_summary(
    rows: DataFrame, table: str, entries: list[Counter], settings: Settings, run_id: str
) -> DataFrame:
    """Neighbour sums of one LTE type per document and source cell."""
    keys = [*FILE_KEYS, "cell_id", "cell_id_2"]
    summed = sums.neighbour_sum(rows.filter(F.col("meas_type") == table), entries, keys)
    body = summed.select(
        *common_columns_nokia(settings), F.col("cell_id_2").alias("MO_DN2"),
        F.col("cell_id").alias("MO_DN_Source"), *[e.column for e in entries],
    )
    return with_run_id(body, run_id)


def umts_detail(rows: DataFrame, table: str, entries: list[Counter], settings: Settings, run_id: str) -> DataFrame:
    """Detail report of one UMTS type; identity columns are part of the table's layout."""
    carried = ["base_id", "local_moid", "cell_id_1", "cell_id_2", "tr_class", "tr_subclass", "ch_type", "counters"]
    shaped = rows.filter(F.col("meas_type") == table).select(*common_columns_nokia(settings), *carried)
    return with_run_id(project_configured(shaped, canonical_entries(entries), COMMON_HEADER, absent=""), run_id)


def umts_class_summary(
    rows: DataFrame, table: str, labels: list[str] | None, settings: Settings, run_id: str
) -> DataFrame:
    """Traffic-class sums of one UMTS type per document and cell.

    ``labels`` renames the sums by position, as the ``<table>sum`` layout of a catalog asks.
    """
    keys = [*FILE_KEYS, *SUM_IDENTITY]
    of_type = rows.filter(F.col("meas_type") == table)
    summed = (sums.rlc_class_sum if table == sums.RLC_TYPE else sums.olpc_class_sum)(of_type, keys)
    sum_names = [c for c in summed.columns if c not in keys]
    shown = labels or sum_names
    if len(shown) != len(sum_names):
        raise ValueError(f"layout of {table}{SUM_SUFFIX} has {len(shown)} sums, expected {len(sum_names)}")
    body = summed.select(
        *common_columns_nokia(settings),
        *[F.col(c).alias(label) for c, label in SUM_IDENTITY.items()],
        *[F.col(c).alias(label) for c, label in zip(sum_names, shown, strict=True)],
    )
    return with_run_id(body, run_id)


def sum_labels(catalog: dict[str, list[Counter]], table: str) -> list[str] | None:
    """The sum columns a catalog names for a type, identity columns left out."""
    layout = catalog.get(table + SUM_SUFFIX)
    return [e.column for e in layout if e.column not in SUM_IDENTITY.values()] if layout else None


def issues(staged: DataFrame) -> DataFrame:
    """All findings of a staged table of objects, exploded from one scan."""
    return quality.issues_of(staged)


def stage_objects(
    spark: SparkSession, files: DataFrame, technology: str, catalog: dict[str, list[Counter]], settings: Settings | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Named objects and document findings, written once to ``folder``, by default a shared one, and read from there.

    The table is partitioned and rebalanced by type: adaptive execution splits a type that holds
    most rows and joins small ones, so folders get well-sized files however types are spread. Only
    configured values take part.
    """
    folder = folder or shared_folder(spark, "objects")
    parsed = objects(files, technology, True, catalog, settings)
    parsed.hint("rebalance", "meas_type").write.partitionBy("meas_type").parquet(folder)
    return spark.read.schema(parsed.schema).parquet(folder)


def _labelled(body: DataFrame, settings: Settings) -> DataFrame:
    """``body`` with the labels that the definition file gives the first columns; those beyond the period are a cell type's own."""
    front = [RUN_ID, *COMMON_HEADER]
    if not settings.header:
        return body
    if len(settings.header) < len(front):
        raise ValueError(f"the header of the definition file has {len(settings.header)} columns, reports have {len(front)} in front of the cell")
    return body.withColumnsRenamed(dict(zip(front, settings.header, strict=False)))


def reports(
    rows: DataFrame, table: str, catalog: dict[str, list[Counter]], settings: Settings, technology: str, run_id: str
) -> dict[str, DataFrame]:
    """The detail report of a type under ``detail`` and, for types that have one, its sums under ``summary``."""
    entries = catalog[table]
    if technology == "UMTS":
        made = {"detail": umts_detail(rows, table, entries, settings, run_id)}
        if table in (sums.RLC_TYPE, sums.OLPC_TYPE):
            made["summary"] = umts_class_summary(rows, table, sum_labels(catalog, table), settings, run_id)
    else:
        made = {"detail": lte_detail(rows, table, entries, settings, run_id)}
        if table in NEIGHBOUR_TYPES:
            made["summary"] = lte_neighbour_summary(rows, table, entries, settings, run_id)
    return {kind: _labelled(frame, settings) for kind, frame in made.items()}


def run(
    spark: SparkSession, files: DataFrame, catalog: dict[str, list[Counter]], settings: Settings,
    technology: str, out: str, run_id: str,
) -> None:
    """Write ``out/<table>``, ``out/<table>_sum`` and ``out/issues``, published when all of it is there."""
    with publication(spark, out, run_id) as folder:
        staged = stage_objects(spark, files, technology, catalog, settings, f"{folder}/_work/objects")
        rows = staged.filter(has_cell(technology) & F.col("period_start").isNotNull())
        found = {
            r.meas_type
            for r in rows.filter(F.col("meas_type").isin(*catalog)).select("meas_type").distinct().collect()
        }
        for table in sorted(found):
            made = reports(rows, table, catalog, settings, technology, run_id)
            write_pm_report(made["detail"], f"{folder}/{table}", NOKIA_SEP)
            if "summary" in made:
                write_pm_summary(made["summary"], f"{folder}/{table}")
        write_pm_issues(issues(staged).unionByName(quality.settings_issues(spark, settings)), f"{folder}/issues")
