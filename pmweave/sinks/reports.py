"""Delimited reports.

Executors write; the driver only commits. Spark publishes a folder by its commit protocol
and marks it ``_SUCCESS``, so readers never see half a report. Writing the same run again
overwrites its own folder and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Delimiters and the name of the first column.
NOKIA_SEP, ERIC_SEP = "|", ","
RUN_ID = "MGR_RUN_ID"
RUN_ID_UMTS_ERIC = "MGR_RUNID"


def with_run_id(report: DataFrame, run_id: str, label: str = RUN_ID) -> DataFrame:
    """The job's one run id in front of every row. It is passed in, so a rerun repeats it."""
    return report.select(F.lit(run_id).alias(label), *report.columns)


def write_pm_report(
    report: DataFrame, path: str, sep: str, partition_by: list[str] | None = None, gzip: bool = False
) -> None:
    """One delimited folder with a header line per part; absent values are empty, nothing is trimmed."""
    writer = (
        report.write.mode("overwrite")
        .option("sep", sep).option("header", True)
        .option("emptyValue", "").option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    if gzip:
        writer = writer.option("compression", "gzip")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_pm_summary(summary: DataFrame, path: str, sep: str = NOKIA_SEP, gzip: bool = False) -> None:
    """The ``_sum`` layout, next to its detail report as ``<path>_sum``."""
    write_pm_report(summary, f"{path}_sum", sep, gzip=gzip)


def write_pm_issues(issues: DataFrame, path: str) -> None:
    """Issue rows in one folder per kind.

    Each task finds few of each kind, so rows are rebalanced by kind first; a kind that holds
    most of them is split.
    """
    issues.hint("rebalance", "kind").write.mode("overwrite").partitionBy("kind").option("header", True).csv(path)


def read_pm_issues(spark: SparkSession, path: str) -> DataFrame:
    schema = "file_path STRING, meas_type STRING, item STRING, message STRING, kind STRING"
    return spark.read.schema(schema).option("header", True).csv(path)
