"""Report columns: configured counters in catalog order, arrays spread over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pmweave.functions.arrays import SINGLE, expand, expand_single
from pmweave.functions.identity import eric_cell_id_umts, eric_relation
from pmweave.sources.catalog import Counter

# The two types with a neighbour object, and the element names that are
# configured like counters but come from the object's identity.
NEIGHBOUR_TYPES = ("lte_isys_ho_utran_nb", "lte_isys_ho_gsm_nb")
IDENTITY_ELEMENTS = {
    "baseId": "base_id",
    "localMoid": "local_moid",
    "cell_id_1": "cell_id_1",
    "cell_id_2": "cell_id_2",
    "TR_CLASS": "tr_class",
    "TR_SUBCLASS": "tr_subclass",
    "CHTYPE": "ch_type",
}


def report_columns(entries: list[Counter]) -> list[str]:
    """Output column names: scalars as they are, arrays as ``name_0 ... name_{n-1}``."""
    names: list[str] = []
    for e in entries:
        names += [e.column] if e.dim == 1 else [f"{e.column}_{i}" for i in range(e.dim)]
    return names


def report_column_rows(catalog: DataFrame) -> DataFrame:
    """The same names as rows of a catalog table: ``(table_name, ordinal, element, column_name)``; counters without a usable size have none."""
    element = F.explode(F.sequence(F.lit(0), F.col("dim") - 1)).alias("element")
    spread = catalog.filter(F.col("dim") >= 1).select("table_name", "ordinal", "column_name", "dim", element)
    name = F.when(F.col("dim") == 1, F.col("column_name")).otherwise(F.concat_ws("_", "column_name", F.col("element").cast("string")))
    return spread.select("table_name", "ordinal", "element", name.alias("column_name"))


def codes_of(entries: list[Counter]) -> list[str]:
    """Distinct codes in catalog order: a merged cell's ``values`` are in this order."""
    return list(dict.fromkeys(e.code for e in entries))


def _reader(frame: DataFrame, codes: list[str]):
    """How to get the raw value of an entry from this frame's representation."""
    if "values" in frame.columns:
        at = {code: i for i, code in enumerate(codes)}
        return lambda e: F.get("values", F.lit(at[e.code]))
    if not isinstance(frame.schema["counters"].dataType, T.MapType):
        raise TypeError("counters must be a map")

    def read(e: Counter) -> Column:
        named = IDENTITY_ELEMENTS.get(e.code)
        if named in frame.columns:
            return F.col(named).cast("string")
        return F.try_element_at("counters", F.lit(e.code))

    return read


def project_configured(
    frame: DataFrame, entries: list[Counter], kept: list[str], absent: str, codes: list[str] | None = None
) -> DataFrame:
    """``kept`` columns followed by one column per configured value.

    ``codes`` is what a ``values`` array holds in order, by default the codes of ``entries``; it is read by index,
    while a ``counters`` map has to be searched.

    ``absent`` is what a scalar column holds when the cell lacks the counter: ``"0"`` in
    Ericsson reports, ``""`` in Nokia reports. Arrays are expanded once each and then
    spread, in two selects; a catalog of hundreds of counters is still a single stage.
    """
    read = _reader(frame, codes or codes_of(entries))
    arrays = [(i, e) for i, e in enumerate(entries) if e.kind != SINGLE]
    scalar = {
        i: (expand_single(read(e)) if absent == "0" else F.coalesce(read(e), F.lit(absent)))
        for i, e in enumerate(entries) if e.kind == SINGLE
    }
    if not arrays:
        return frame.select(*kept, *[scalar[i].alias(e.column) for i, e in enumerate(entries)])
    staged = frame.select(
        *kept,
        *[scalar[i].alias(f"_s{i}") for i in scalar],
        *[expand(read(e), e.kind, e.dim).alias(f"_a{i}") for i, e in arrays],
    )
    spread: list[Column] = []
    for i, e in enumerate(entries):
        if e.kind == SINGLE:
            spread.append(F.col(f"_s{i}").alias(e.column))
        elif e.dim == 1:
            spread.append(F.get(f"_a{i}", F.lit(0)).alias(e.column))
        else:
            spread += [F.get(f"_a{i}", F.lit(j)).alias(f"{e.column}_{j}") for j in range(e.dim)]
    return staged.select(*kept, *spread)


def neighbour_columns(detail: DataFrame) -> DataFrame:
    """Neighbour tables name the cell ``MO_DN_Source`` and add ``MO_DN_Target``, after ``MO_DN2``."""
    return detail.withColumnsRenamed({"MO_DN": "MO_DN_Source", "neighbour": "MO_DN_Target"})


def cell_grain_filter(objects: DataFrame) -> DataFrame:
    """Objects that are a cell themselves, not one of its relations."""
    return objects.filter(F.col("rel_type").isNull())


def with_relation(objects: DataFrame, technology: str = "UMTS") -> DataFrame:
    """Identity columns of ``moid``: ``cell_id, rel_type, freq_rel, cell_rel``; nameless objects are left out."""
    return (
        objects.select(
            "*", eric_cell_id_umts(F.col("moid"), technology).alias("cell_id"),
            eric_relation(F.col("moid"), technology).alias("_rel"),
        )
        .filter(F.col("cell_id").isNotNull())
        .select(*objects.columns, "cell_id", "_rel.rel_type", "_rel.freq_rel", "_rel.cell_rel")
    )


def relation_report(
    cells: DataFrame, rel_type: str, entries: list[Counter], kept: list[str], codes: list[str] | None = None
) -> DataFrame:
    """Rows of one relation table: ``kept``, the cell, both relation parts, the table's counters."""
    rows = cells.filter(F.col("rel_type") == rel_type)
    return project_configured(rows, entries, [*kept, "cell_id", "freq_rel", "cell_rel"], "0", codes)
