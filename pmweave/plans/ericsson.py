"""Ericsson jobs: one comma report at cell grain, LTE and UMTS.

Documents are merged where they are parsed, so the way from scan to report has no
exchange. ``run`` stages the merged cells once; report, relation reports, sums and issues
read that table with their own columns and grain instead of parsing the XML again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.functions import names
from pmweave.functions.arrays import bind
from pmweave.functions.identity import eric_cell_id_lte, eric_cell_id_umts, eric_relation
from pmweave.operators import quality, sums
from pmweave.operators.merge import merge_documents
from pmweave.operators.project import cell_grain_filter, codes_of, project_configured, relation_report
from pmweave.operators.shred import parse_eric
from pmweave.session import shared_folder
from pmweave.sinks import publication, read_pm_issues, with_run_id, write_pm_issues, write_pm_report, write_pm_summary
from pmweave.sinks.reports import ERIC_SEP, RUN_ID, RUN_ID_UMTS_ERIC
from pmweave.sources.catalog import Counter, Settings

# Report header in front of the counters, and the constants in it.
COMMON_HEADER = [
    "HL_DATE", "HL_MARKET", "Cntr", "Region", "Market", "SubNetwork_2",
    "PERIOD_START_TIME", "PERIOD_DURATION", "MeContext", "OSSName",
]
CELL_LABEL = {"LTE": "EUtranCellFDD", "UMTS": "UtranCell"}
RELATION_HEADER = {
    "ltecell": ["EUtranFreqRelation", "EUtranCellRelation"],
    "umtscell": ["UtranFreqRelation", "UtranCellRelation"],
    "gsmcell": ["GeranFreqGroupRelation", "GeranCellRelation"],
}
CELL_COUNT = "1"
RELATION_PARTS = ("freq_rel", "cell_rel")
DURATION = "15"
UMTS_TABLE = "site"


def eric_file_fields(files: DataFrame) -> DataFrame:
    """Add what the file name tells: oss, sub_network, me_context, period_start, hour_start."""
    path = F.col("file_path")
    start = names.period_to_local(
        names.eric_file_time(path), names.eric_file_offset(path), names.eric_own_offset(path)
    )
    return files.select(
        "*",
        names.eric_oss(path).alias("oss"),
        names.eric_sub_network(path).alias("sub_network"),
        names.eric_me_context(path).alias("me_context"),
        start.alias("period_start"),
        names.hour_bucket(start).alias("hour_start"),
    )


def common_columns_eric(settings: Settings) -> list[Column]:
    """The report columns in front of the cell, in header order."""
    values = [
        names.minute_text(F.col("hour_start")), F.lit(settings.hl_market), F.lit(CELL_COUNT),
        F.lit(settings.region), F.lit(settings.market), F.col("sub_network"),
        names.minute_text(F.col("period_start")), F.lit(DURATION), F.col("me_context"), F.col("oss"),
    ]
    return [v.alias(n) for v, n in zip(values, COMMON_HEADER, strict=True)]


def lte_identity(moid: Column) -> Column:
    return F.struct(eric_cell_id_lte(moid).alias("cell_id"))


def umts_identity(moid: Column) -> Column:
    return bind(
        eric_relation(moid),
        lambda relation: F.struct(
            eric_cell_id_umts(moid).alias("cell_id"), relation["rel_type"].alias("rel_type"),
            relation["freq_rel"].alias("freq_rel"), relation["cell_rel"].alias("cell_rel"),
        ),
    )


def report_entries(catalog: dict[str, list[Counter]], technology: str) -> list[Counter]:
    """LTE reports all tables by name, UMTS the site table."""
    if technology == "UMTS" and UMTS_TABLE not in catalog:
        raise ValueError(f"a UMTS report needs a table named {UMTS_TABLE!r} in the catalog; it has {sorted(catalog)}")
    tables = [UMTS_TABLE] if technology == "UMTS" else sorted(catalog)
    return [e for t in tables for e in catalog[t]]


def cells(
    files: DataFrame, entries: list[Counter], technology: str,
    names_scope: str = "md", keep_empty: bool = False, others: Sequence[Counter] = (),
) -> DataFrame:
    """Merged cells: file fields, identity, ``values`` by place among the codes of ``entries`` and then ``others``.

    LTE folds the objects below a cell into the cell, UMTS keeps relations apart. With ``keep_empty`` also what is
    wrong with each document, ``findings`` about the counters of ``entries`` being on its first row.
    """
    umts = technology == "UMTS"
    codes = codes_of([*entries, *others])
    # the name is parsed once per document, before its cells multiply
    parsed = parse_eric(eric_file_fields(files), names_scope, codes)
    findings = quality.document_findings(entries, codes, relations=umts) if keep_empty else None
    merged = merge_documents(parsed, umts_identity if umts else lte_identity, keep_empty, findings)
    return _with_file_findings(merged) if keep_empty else merged


def _with_file_findings(merged: DataFrame) -> DataFrame:
    """What is wrong with a document as a whole joins ``findings`` on its first row."""
    path, nameless = F.col("file_path"), F.col("nameless")
    kept = [c for c in merged.columns if c not in ("findings", "nameless", "corrupt")]
    all_of = F.concat(
        "findings", quality.if_so(F.col("corrupt"), quality.bad_file(path)),
        quality.if_so(F.col("period_start").isNull(), quality.bad_name(path)),
        quality.if_so(nameless > 0, quality.finding("no_name", nameless.cast("string"), F.lit("objects without a name"))),
    )
    return merged.select(*kept, F.when(F.col("findings").isNotNull(), all_of).alias("findings"))


def _front_labels(settings: Settings, technology: str) -> list[str]:
    """Names of the run id, the common columns and the cell; those of the definition file if it has any."""
    built_in = [RUN_ID_UMTS_ERIC if technology == "UMTS" else RUN_ID, *COMMON_HEADER, CELL_LABEL[technology]]
    if settings.header and len(settings.header) != len(built_in):
        raise ValueError(f"the header of the definition file has {len(settings.header)} columns, the report has {len(built_in)} in front of the counters")
    return list(settings.header) or built_in


def _labelled(body: DataFrame, front: list[str]) -> DataFrame:
    """``body`` with its first columns renamed."""
    return body.toDF(*front, *body.columns[len(front):])


def report(
    merged: DataFrame, entries: list[Counter], settings: Settings, technology: str, run_id: str, others: Sequence[Counter] = ()
) -> DataFrame:
    """One row per cell; ``entries`` and ``others`` as in ``cells``."""
    if technology == "UMTS":
        merged = cell_grain_filter(merged)
    rows = merged.select(*common_columns_eric(settings), "cell_id", "values")
    body = project_configured(rows, entries, [*COMMON_HEADER, "cell_id"], "0", codes_of([*entries, *others]))
    return _labelled(with_run_id(body, run_id), _front_labels(settings, technology))


def stage_cells(
    spark: SparkSession, files: DataFrame, entries: list[Counter], technology: str, names_scope: str = "md",
    others: Sequence[Counter] = (), folder: str | None = None,
) -> DataFrame:
    """Merged cells and document findings, written once to ``folder``, by default a shared one, and read from there."""
    folder = folder or shared_folder(spark, "cells")
    cells(files, entries, technology, names_scope, True, others).write.parquet(folder)
    return spark.read.parquet(folder)


def relation_entries(catalog: dict[str, list[Counter]]) -> dict[str, list[Counter]]:
    return {t: catalog[t] for t in RELATION_HEADER if t in catalog}


def relation_reports(
    merged: DataFrame, tables: dict[str, list[Counter]], codes: list[str], settings: Settings, run_id: str
) -> dict[str, DataFrame]:
    """One report per relation table: the report's front, both relation parts, the table's counters. ``codes`` is the order of ``values``."""
    rows = merged.filter(F.col("rel_type").isNotNull()).select(
        *common_columns_eric(settings), "cell_id", "rel_type", *RELATION_PARTS, "values")
    labels = {**RELATION_HEADER, **{t: list(names) for t, names in settings.relation_headers}}
    front = _front_labels(settings, "UMTS")
    return {
        t: _labelled(with_run_id(relation_report(rows, t, entries, COMMON_HEADER, codes), run_id), [*front, *labels[t]])
        for t, entries in tables.items()
    }


def relation_sums(reports: dict[str, DataFrame], tables: dict[str, list[Counter]]) -> dict[str, DataFrame]:
    """Per relation table the counters summed over the relations of a cell in a document; keys are the report's front."""
    front = len(COMMON_HEADER) + 2
    return {t: sums.relation_sum(r, tables[t], r.columns[:front]) for t, r in reports.items()}


def issues(merged: DataFrame) -> DataFrame:
    """All findings of a staged table of merged cells (``keep_empty=True``)."""
    return quality.issues_of(merged)


def run(
    spark: SparkSession, files: DataFrame, catalog: dict[str, list[Counter]], settings: Settings,
    technology: str, out: str, run_id: str, names_scope: str = "md",
) -> None:
    """Write ``out/report``, ``out/issues`` and ``out/issue_messages``, for UMTS also ``out/<relation table>`` and
    ``out/<relation table>_sum``. All of it is published when all of it is there."""
    entries = report_entries(catalog, technology)
    tables = relation_entries(catalog) if technology == "UMTS" else {}
    others = [e for t in tables.values() for e in t]
    with publication(spark, out, run_id) as folder:
        staged = stage_cells(spark, files, entries, technology, names_scope, others, f"{folder}/_work/cells")
        # a file whose name gives no time is an issue, not rows
        good = staged.filter(F.col("cell_id").isNotNull() & F.col("period_start").isNotNull())
        write_pm_report(report(good, entries, settings, technology, run_id, others), f"{folder}/report", ERIC_SEP)
        reports = relation_reports(good, tables, codes_of([*entries, *others]), settings, run_id) if tables else {}
        for table, rows in reports.items():
            write_pm_report(rows, f"{folder}/{table}", ERIC_SEP)
        for table, rows in relation_sums(reports, tables).items():
            write_pm_summary(rows, f"{folder}/{table}", ERIC_SEP)
        found = issues(staged).unionByName(quality.settings_issues(spark, settings))
        write_pm_issues(found, f"{folder}/issues")
        # messages come from the issues just written instead of working them out again
        written = read_pm_issues(spark, f"{folder}/issues")
        quality.dedupe_issues(written).write.mode("overwrite").option("header", True).csv(f"{folder}/issue_messages")
