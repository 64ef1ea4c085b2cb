"""One row per cell out of its measurement blocks; of a repeated counter the latest value counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.functions.arrays import bind
from pmweave.operators.shred import held


def merge_last(pm_long: DataFrame, keys: list[str]) -> DataFrame:
    """For tall tables: the value with the highest ``pos`` per key and counter.

    ``max_by`` combines before the exchange, so a hot cell leaves each task as one row
    per counter however many rows it has.
    """
    return pm_long.groupBy(*keys, "counter").agg(F.max_by("raw", "pos").alias("raw"))


def widen(merged: DataFrame, keys: list[str], codes: list[str]) -> DataFrame:
    """Merged tall rows to one ``counters MAP`` per key, also for keys that hold no configured code.

    Only configured codes are gathered and each is there once, so a group never
    holds more entries than the catalog.
    """
    entry = F.when(F.col("counter").isin(codes), F.struct("counter", "raw"))
    return merged.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("counters"))


def _starts_of_runs(rows: Column, key) -> Column:
    """Indexes at which ``key`` of a sorted array changes."""
    last = F.size(rows) - 1
    indexes = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(
        indexes, lambda i: (i == 0) | ~key(F.get(rows, i)).eqNullSafe(key(F.get(rows, i - 1)))
    )


def _later_wins(objects: Column) -> Column:
    """Of several objects' values, by place among the codes, the last that is there; empty where no object has any."""

    def over(earlier: Column, later: Column) -> Column:
        return bind(held(later["raws"], later["places"]), lambda values: (
            F.when(F.size(values) == 0, earlier).when(F.size(earlier) == 0, values)
            .otherwise(F.zip_with(earlier, values, lambda a, b: F.coalesce(b, a)))
        ))

    return F.reduce(objects, F.array().cast("array<string>"), over)


def merge_documents(parsed: DataFrame, identity, keep_empty: bool = False, findings=None) -> DataFrame:
    """Cells of every parsed document, merged inside the document: no exchange at all.

    ``parsed`` comes from ``parse_eric`` with codes. ``identity(moid)`` gives the struct an object
    belongs to; a null ``cell_id`` in it leaves the object out. The result has the identity's
    fields and ``values ARRAY<STRING>``, one entry per code, null where the cell lacks it; empty where it lacks all.

    Objects are sorted by identity and document order and cut into runs, one per cell. That
    keeps the work near-linear for controllers with thousands of cells in one document. All of it is one expression over
    objects whose values are still the parser's compact arrays: a column for each step, or a string for each value of an
    object, would be copies of the whole document that a task holds next to each other.

    With ``keep_empty`` a document without cells keeps one row with a null identity, next to
    ``corrupt`` and ``nameless`` (objects that carry no name), so that one staged table serves
    reports and issues alike. ``findings(cells)``, an array made of the document's cells
    ``ARRAY<STRUCT<who, values>>``, comes as a column of that name on the document's first row.
    """
    kept = [c for c in parsed.columns if c not in ("objects", "corrupt", "dialect")]

    def ordered(objects: Column) -> Column:
        named = F.transform(
            objects,
            lambda o: F.struct(
                identity(o["moid"]).alias("who"), o["md"].alias("md"), o["mv"].alias("mv"),
                o["raws"].alias("raws"), o["places"].alias("places"),
            ),
        )
        return F.sort_array(F.filter(named, lambda o: o["who"]["cell_id"].isNotNull()))

    def merged(rows: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, k: F.struct(
                F.get(rows, s)["who"].alias("who"),
                _later_wins(F.slice(rows, s + 1, F.coalesce(F.get(starts, k + 1), F.size(rows)) - s)).alias("values"),
            ),
        )

    def cells_of(objects: Column) -> Column:
        return bind(ordered(objects), lambda rows: bind(
            _starts_of_runs(rows, lambda e: e["who"]), lambda starts: merged(rows, starts)))

    def with_document(objects: Column, cells: Column) -> Column:
        nameless = F.coalesce(F.size(F.filter(objects, lambda o: o["moid"].isNull())), F.lit(0))
        told = [nameless.alias("nameless"), F.col("corrupt").isNotNull().alias("corrupt")]
        return F.struct(cells.alias("cells"), *told, *([findings(cells).alias("findings")] if findings else []))

    found = []
    if keep_empty:
        document = bind(F.col("objects"), lambda objects: bind(cells_of(objects), lambda cells: with_document(objects, cells)))
        documents = parsed.select(*kept, document.alias("_document")).select(*kept, "_document.*")
        kept += ["nameless", "corrupt"]
        if findings:
            found = [F.when(F.coalesce("nth", F.lit(0)) == 0, F.col("findings")).alias("findings")]
    else:
        documents = parsed.select(*kept, cells_of(F.col("objects")).alias("cells"))
    # outer also where empty documents go: an inner one lets the optimizer test the array below the projection that parses it
    cells = documents.select(*kept, *(["findings"] if found else []), F.posexplode_outer("cells").alias("nth", "cell"))
    if not keep_empty:
        cells = cells.filter(F.col("nth").isNotNull())
    return cells.select(*kept, "cell.who.*", "cell.values", *found)
