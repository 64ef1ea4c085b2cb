"""Sums over neighbours, relations and traffic classes.

All are plain grouped sums of fixed-width numbers: partial sums are formed before the
exchange, so neither a hot cell nor a hot file reaches one task row by row. An absent or
unreadable counter adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.operators.project import NEIGHBOUR_TYPES, report_columns
from pmweave.sources.catalog import Counter

# The traffic classes, channel types and counter codes the class sums are about.
CS_VOICE = "CS_voice"
NRT_DATA = "PS_NRT_data"
RT_DATA = "PS_RT_data"
BACKGROUND, INTERACTIVE = "background", "interactive"
DCH, HSUPA = "DCH", "HSUPA"
RLC_TYPE, OLPC_TYPE = "rcpm_rlc_wcel", "rcpm_olpc_wcel"
DL_VOLUME, DL_TIME, UL_VOLUME, UL_TIME = "m1026c31", "m1026c29", "m1026c30", "m1026c33"
CRC_OK, CRC_NOT_OK, POWER_SUM, POWER_SAMPLES = "m1024c4", "m1024c5", "m1024c15", "m1024c17"
SUMMED_CODES = {RLC_TYPE: (DL_VOLUME, DL_TIME, UL_VOLUME, UL_TIME), OLPC_TYPE: (CRC_OK, CRC_NOT_OK, POWER_SUM, POWER_SAMPLES)}


def _number(code: str, type_name: str = "bigint") -> Column:
    return F.trim(F.try_element_at("counters", F.lit(code))).try_cast(type_name)


def _sum_where(predicate: str, value: str) -> Column:
    """Sum of one prepared column over the rows of one prepared predicate; nothing adds zero."""
    return F.coalesce(F.sum(F.when(F.col(predicate), F.col(value))), F.lit(0))


def neighbour_sum(objects: DataFrame, entries: list[Counter], keys: list[str]) -> DataFrame:
    """Each configured counter summed over all neighbours of a source cell, per document."""
    return objects.groupBy(*keys).agg(
        *[F.coalesce(F.sum(_number(e.code)), F.lit(0)).cast("bigint").alias(e.column) for e in entries]
    )


def only_neighbour_types(objects: DataFrame) -> DataFrame:
    return objects.filter(F.col("meas_type").isin(*NEIGHBOUR_TYPES))


def rlc_class_sum(objects: DataFrame, keys: list[str]) -> DataFrame:
    """Eight sums of volumes and times by channel type, in report order.

    Columns are named after their predicates; a report may relabel them by position. Numbers and
    predicates are worked out once per row before the sums share them.
    """
    packet = F.col("tr_subclass").isin(NRT_DATA, RT_DATA)
    dch, hsupa = F.col("ch_type") == DCH, F.col("ch_type") == HSUPA
    rows = objects.select(
        *keys,
        (packet & dch).alias("_dch"), (packet & ~dch).alias("_non_dch"),
        (packet & ~hsupa).alias("_non_hsupa"), hsupa.alias("_hsupa"),
        *[_number(c).alias(c) for c in (DL_VOLUME, DL_TIME, UL_VOLUME, UL_TIME)],
    )
    layout = [
        ("dl_vol_dch", "_dch", DL_VOLUME), ("dl_vol_non_dch", "_non_dch", DL_VOLUME),
        ("dl_time_dch", "_dch", DL_TIME), ("dl_time_non_dch", "_non_dch", DL_TIME),
        ("ul_vol_non_hsupa", "_non_hsupa", UL_VOLUME), ("ul_vol_hsupa", "_hsupa", UL_VOLUME),
        ("ul_time_non_hsupa", "_non_hsupa", UL_TIME), ("ul_time_hsupa", "_hsupa", UL_TIME),
    ]
    return rows.groupBy(*keys).agg(*[_sum_where(p, v).alias(name) for name, p, v in layout])


def olpc_class_sum(objects: DataFrame, keys: list[str]) -> DataFrame:
    """Twelve sums of checked blocks and radio-link power by traffic class, in report order."""
    sub, cls, ch = F.col("tr_subclass"), F.col("tr_class"), F.col("ch_type")
    rows = objects.select(
        *keys,
        (sub == CS_VOICE).alias("_cs"),
        ((sub == NRT_DATA) & cls.isin(BACKGROUND, INTERACTIVE)).alias("_ps"),
        (sub.isin(NRT_DATA, RT_DATA) & (ch == HSUPA)).alias("_hsupa"),
        *[_number(c).alias(c) for c in (CRC_OK, CRC_NOT_OK)],
        _number(POWER_SUM, "double").alias(POWER_SUM),
        # samples may be written as decimals; each counts with its whole part
        _number(POWER_SAMPLES, "double").cast("bigint").alias(POWER_SAMPLES),
    )
    groups = ("cs", "ps", "hsupa")
    blocks = [
        _sum_where(f"_{g}", code).alias(f"{label}_{g}")
        for g in groups for code, label in ((CRC_NOT_OK, "crc_nok"), (CRC_OK, "crc_ok"))
    ]
    power = [
        _sum_where(f"_{g}", code).alias(f"{label}_{g}")
        for g in groups for code, label in ((POWER_SUM, "pwr_sum"), (POWER_SAMPLES, "pwr_samples"))
    ]
    return rows.groupBy(*keys).agg(*blocks, *power)


def relation_sum(relations: DataFrame, entries: list[Counter], keys: list[str]) -> DataFrame:
    """Element-wise sums of projected relation rows per relation table and source cell."""
    return relations.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.trim(name).try_cast("bigint")), F.lit(0)).cast("bigint").alias(name)
            for name in report_columns(entries)
        ]
    )


def split_by_type(objects: DataFrame, meas_types: list[str]) -> dict[str, DataFrame]:
    """One frame per measurement type, over all files.

    Read back from a table partitioned by ``meas_type`` each frame prunes to its own folder.
    """
    return {t: objects.filter(F.col("meas_type") == t) for t in meas_types}
