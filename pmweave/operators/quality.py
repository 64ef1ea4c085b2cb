"""Data-quality findings: ``pm_issues (file_path, meas_type, kind, item, message)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.functions.arrays import COMP, PDF, SINGLE, SPECIAL, SPECIAL_DIM, bind, comp_is_long, comp_is_short, values_of
from pmweave.functions.names import base_name
from pmweave.operators.project import IDENTITY_ELEMENTS, codes_of
from pmweave.sources.catalog import Counter, Settings

# Message texts, and for parity the scan depth of the unused-element listing.
NOT_FOUND = "IE:%s not found from xml input; set 0 instead"
TOO_LONG = "IE:%s has more elemments than configured"
TOO_SHORT = "IE:%s has less elemments than configured"
NO_OPTION = "Ini file %s option error."
NOT_IN_XML = "ElementsNotInXML="
NOTHING_USED = "ElementsNothingUse="
UNUSED_SCAN_OBJECTS = 11
WORD_BITS = 64


def _issue(kind: str, item: Column, message: Column, meas_type: Column | None = None) -> list[Column]:
    return [
        F.col("file_path"),
        (F.lit(None).cast("string") if meas_type is None else meas_type).alias("meas_type"),
        F.lit(kind).alias("kind"),
        item.alias("item"),
        message.alias("message"),
    ]


def missing_counters_eric(cells: DataFrame, entries: list[Counter]) -> DataFrame:
    """Configured counters some cell of a file lacks, once per file and counter.

    ``cells`` has ``values`` by place in the catalog or a ``counters`` map. What a row lacks is a bit set of places,
    64 to a number, and a file's is their union: a partial ``bit_or`` leaves each task one short row per file,
    however many cells lack however many counters. For staged documents see ``document_findings``, which needs no exchange.
    """
    codes = codes_of(entries)
    named = F.array(*[F.lit(c) for c in codes])
    places = F.sequence(F.lit(0), F.lit(len(codes) - 1))
    if "values" in cells.columns:
        lacking = F.filter(places, lambda at: F.get("values", at).isNull())
    else:
        lacking = F.transform(F.array_except(named, F.map_keys("counters")), lambda c: (F.array_position(named, c) - 1).cast("int"))
    words = range(-(-len(codes) // WORD_BITS))

    def word(k: int) -> Column:
        mine = F.filter("lacking", lambda at: (at >= k * WORD_BITS) & (at < (k + 1) * WORD_BITS))
        bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % WORD_BITS).cast("int"))
        return F.reduce(mine, F.lit(0).cast("bigint"), lambda bits, at: bits.bitwiseOR(bit(at)))

    rows = cells.select("file_path", lacking.alias("lacking")).select("file_path", *[word(k).alias(f"w{k}") for k in words])
    files = rows.groupBy("file_path").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in words])
    bits = F.array(*[F.col(f"w{k}") for k in words])
    set_ = F.filter(places, lambda at: F.call_function("getbit", F.get(bits, F.floor(at / WORD_BITS).cast("int")), (at % WORD_BITS).cast("int")) == 1)
    found = files.select("file_path", F.explode(F.transform(set_, lambda at: F.get(named, at))).alias("item"))
    return found.select(*_issue("missing", F.col("item"), F.format_string(NOT_FOUND, "item")))


def _length_text(kind: Column, dim: Column, raw: Column) -> Column:
    """The message template of a value of another length than its counter's shape, null where it fits."""
    n = F.size(values_of(raw))
    return (
        F.when((kind == PDF) & (n > dim), F.lit(TOO_LONG))
        .when((kind == PDF) & (n < dim), F.lit(TOO_SHORT))
        .when((kind == SPECIAL) & (n > SPECIAL_DIM), F.lit(TOO_LONG))
        .when((kind == SPECIAL) & (n < SPECIAL_DIM), F.lit(TOO_SHORT))
        .when((kind == COMP) & comp_is_short(raw), F.lit(TOO_SHORT))
        .when((kind == COMP) & comp_is_long(raw, dim), F.lit(TOO_LONG))
        .when((kind == SINGLE) & F.contains(raw, F.lit(",")), F.lit(TOO_LONG))
    )


def array_length_issues(pm_long: DataFrame, entries: list[Counter]) -> DataFrame:
    """Array counters with another length than configured, once per file, counter and message.

    Also scalars that hold a list, of which only the first value is reported, and sparse lists that hold fewer pairs than
    they announce, or more, or an index that has no column. Shapes come from the catalog; Spark broadcasts them
    where their size allows.
    """
    shapes = pm_long.sparkSession.createDataFrame(
        sorted({(e.code, e.kind, e.dim) for e in entries}), "code STRING, kind STRING, dim INT"
    )
    found = (
        pm_long.join(shapes, F.col("counter") == F.col("code"))
        .select("file_path", F.col("code").alias("item"), _length_text(F.col("kind"), F.col("dim"), F.col("raw")).alias("text"))
        .filter(F.col("text").isNotNull())
        .distinct()
    )
    return found.select(*_issue("length", F.col("item"), F.replace("text", F.lit("%s"), F.col("item"))))


def document_findings(entries: list[Counter], codes: list[str], relations: bool = False):
    """What is wrong with the counters of a document, as a function of its cells ``ARRAY<STRUCT<who, values>>``.

    ``values`` are in the order of ``codes``, ``entries`` those of the report. A counter that some cell lacks and a
    message about its length come once per document, so they are found where the document is and need no exchange.
    With ``relations`` some of the cells are relations, told by ``who.rel_type``; they lack nothing.
    """
    place = {code: i for i, code in enumerate(codes)}
    wanted = [code in {e.code for e in entries} for code in codes]
    named = F.array(*[F.lit(c) for c in codes])
    shapes = sorted({(e.code, e.kind, e.dim) for e in entries})

    def listed(some: list[tuple[str, str, int]]) -> Column:
        return F.array(*[
            F.struct(F.lit(place[code]).alias("at"), F.lit(code).alias("code"), F.lit(kind).alias("kind"), F.lit(dim).alias("dim"))
            for code, kind, dim in some
        ])

    scalars, arrays = ([x for x in shapes if (x[1] == SINGLE) == single] for single in (True, False))

    def lengths(values: Column, some: list[tuple[str, str, int]]) -> Column:
        def one(shape: Column) -> Column:
            text = _length_text(shape["kind"], shape["dim"], F.get(values, shape["at"]))
            return F.struct(shape["code"].alias("item"), F.replace(text, F.lit("%s"), shape["code"]).alias("message"))

        return F.filter(F.transform(listed(some), one), lambda found: found["message"].isNotNull())

    def odd_lengths(cells: Column) -> Column:
        found = []
        if arrays:
            found.append(F.transform(cells, lambda c: lengths(c["values"], arrays)))
        if scalars:  # nearly no cell has a scalar that holds a list
            listing = F.filter(cells, lambda c: F.exists(c["values"], lambda v: F.contains(v, F.lit(","))))
            found.append(F.transform(listing, lambda c: lengths(c["values"], scalars)))
        return F.array_distinct(F.flatten(F.concat(*found)))

    def findings(cells: Column) -> Column:
        own = F.filter(cells, lambda c: c["who"]["rel_type"].isNull()) if relations else cells
        asked = F.array(*[F.lit(w) for w in wanted])
        # most cells lack nothing
        short = F.filter(own, lambda c: (F.size(c["values"]) == 0) | F.exists(c["values"], lambda v: v.isNull()))
        lacks = lambda seen, c: F.when(F.size(c["values"]) == 0, asked).otherwise(
            F.zip_with(seen, c["values"], lambda lacking, value: lacking | value.isNull()))
        lacking = F.zip_with(F.reduce(short, F.array_repeat(F.lit(False), len(codes)), lacks), asked, lambda x, y: x & y)
        items = F.array_compact(F.transform(lacking, lambda x, i: F.when(x, F.get(named, i))))
        missing = F.transform(items, lambda item: finding("missing", item, F.replace(F.lit(NOT_FOUND), F.lit("%s"), item)))
        length = F.transform(odd_lengths(own), lambda found: finding("length", found["item"], found["message"]))
        return F.concat(missing, length)

    return findings


def finding(kind: str, item: Column, message: Column, meas_type: Column | None = None) -> Column:
    """One entry of a ``findings`` array."""
    typed = F.lit(None).cast("string") if meas_type is None else meas_type
    return F.struct(typed.alias("meas_type"), F.lit(kind).alias("kind"), item.alias("item"), message.alias("message"))


def if_so(condition: Column, entry: Column) -> Column:
    """An array of the one entry where the condition holds, else of none."""
    return F.filter(F.array(entry), lambda _: F.coalesce(condition, F.lit(False)))


def bad_file(file_path: Column) -> Column:
    return finding("bad_file", base_name(file_path), F.lit("document is not well-formed XML"))


def bad_name(file_path: Column) -> Column:
    return finding("bad_name", base_name(file_path), F.lit("no period start"))


def issues_of(staged: DataFrame, *kinds: str) -> DataFrame:
    """Findings of staged documents as issue rows, of all kinds or some: one scan of one column, no exchange."""
    # outer: where the findings are not staged, an inner one would test them below the projection that finds them, and find them twice
    rows = staged.select("file_path", F.explode_outer("findings").alias("f")).filter(F.col("f").isNotNull())
    found = rows.select("file_path", "f.meas_type", "f.kind", "f.item", "f.message")
    return found.filter(F.col("kind").isin(*kinds)) if kinds else found


def settings_issues(spark: SparkSession, settings: Settings, source: str = "settings") -> DataFrame:
    """Settings that the definition file should give and does not."""
    rows = [(source, None, "settings", name, NO_OPTION.replace("%s", name)) for name in settings.absent]
    return spark.createDataFrame(rows, "file_path STRING, meas_type STRING, kind STRING, item STRING, message STRING")


def _configured(catalog: dict[str, list[Counter]], meas_type: Column) -> Column:
    """The catalog's codes of a type, null for an unconfigured type."""
    chosen = F
    for table, entries in catalog.items():
        chosen = chosen.when(meas_type == table, F.array(*[F.lit(e.code) for e in entries]))
    return chosen if catalog else F.lit(None).cast("array<string>")


def nokia_findings(
    catalog: dict[str, list[Counter]], identify, named: str, start, list_not_used: bool = True, list_unused: bool = True,
    last_only: bool = False, first_objects: int | None = None,
):
    """What is wrong with a document, as a function of its objects ``ARRAY<STRUCT<start_time, interval, meas_type, mo, counters>>``.

    Every object leaves a short summary - elements that its type asks for and it lacks, elements beyond them - and
    the summaries of a type are united where the document is:

    * ``missing``: per configured type, the elements that some object lacks, in catalog order;
    * ``not_used``: elements of configured types that are not configured;
    * ``nothing_used``: per unconfigured type, all its elements, a hint at what a new table could hold;
    * ``bad_name`` and ``no_cell``: no start of the period, and objects that name no cell.

    ``identify(mo)`` gives the identity columns of an object, the one called ``named`` being null where it has no cell, and ``start`` reads a period's
    start. ``last_only`` restricts ``missing`` to the last object, ``first_objects`` restricts ``nothing_used`` to the first.
    """

    def summary(o: Column) -> Column:
        wanted = _configured(catalog, o["meas_type"])
        who = identify(o["mo"])
        spoken = [
            F.when(F.coalesce(who[column].cast("string"), F.lit("")) != "", F.lit(element))
            for element, column in IDENTITY_ELEMENTS.items() if column in who
        ]
        own = F.map_keys(o["counters"])
        present = F.concat(own, F.array_compact(F.array(*spoken))) if spoken else own
        return F.struct(
            o["meas_type"].alias("meas_type"), F.array_except(wanted, present).alias("lacking"), F.array_except(own, wanted).alias("beyond"),
            F.when(wanted.isNull(), own).alias("unlisted"), who[named].isNull().alias("nameless"), start(o["start_time"]).isNull().alias("undated"),
        )

    def united(summaries: Column) -> Column:
        def every(some: Column, field: str) -> Column:
            return F.array_distinct(F.flatten(F.filter(some[field], lambda x: x.isNotNull())))

        def of_type(meas_type: Column) -> Column:
            mine = F.filter(summaries, lambda s: s["meas_type"] == meas_type)
            asked = F.filter(F.slice(summaries, -1, 1) if last_only else summaries, lambda s: s["meas_type"] == meas_type)
            seen = F.filter(F.slice(summaries, 1, first_objects) if first_objects else summaries, lambda s: s["meas_type"] == meas_type)
            lacking = bind(every(asked, "lacking"), lambda some: F.array_join(
                F.filter(_configured(catalog, meas_type), lambda code: F.array_contains(some, code)), ","))
            unlisted = F.array_join(F.array_sort(every(seen, "unlisted")), ",")
            name = base_name(F.col("file_path"))
            parts = [bind(lacking, lambda item: if_so(item != "", finding(
                "missing", item, F.concat(name, F.lit(": " + NOT_IN_XML), item), meas_type)))]
            if list_not_used:
                parts.append(F.transform(every(mine, "beyond"), lambda item: finding("not_used", item, item, meas_type)))
            if list_unused:
                parts.append(bind(unlisted, lambda item: if_so(item != "", finding(
                    "nothing_used", item, F.concat(name, F.lit("="), meas_type, F.lit(": " + NOTHING_USED), item), meas_type))))
            return F.concat(*parts)

        types = F.filter(F.array_distinct(summaries["meas_type"]), lambda t: t.isNotNull())
        nameless = F.size(F.filter(summaries, lambda s: s["nameless"]))
        return F.concat(
            F.flatten(F.transform(types, of_type)),
            if_so(F.exists(summaries, lambda s: s["undated"]), bad_name(F.col("file_path"))),
            if_so(nameless > 0, finding("no_cell", nameless.cast("string"), F.lit("objects without a readable cell name"))),
        )

    return lambda objects: bind(F.transform(objects, summary), united)


def quarantine_bad_files(parsed: DataFrame) -> DataFrame:
    """One issue per document whose text is not well-formed; the others are not affected."""
    return parsed.filter(F.col("corrupt").isNotNull()).select("file_path", bad_file(F.col("file_path")).alias("f")).select(
        "file_path", "f.meas_type", "f.kind", "f.item", "f.message")


def dedupe_issues(issues: DataFrame) -> DataFrame:
    """One line per distinct message over the whole job, under the first file that has it.

    Messages come from the catalog, so the partial minimum leaves a few rows per task.
    """
    return issues.groupBy("message").agg(F.min("file_path").alias("file_path"))
