"""Nested XML to rows, with Spark's own ``from_xml`` and explicit schemas.

A document is one row, so everything that happens inside one document -- pairing
counter names with values, merging the blocks of a cell -- is done on that row's arrays
and needs no shuffle. Schemas name only the fields that are used; the rest of a
document is skipped while parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.functions.arrays import ZERO, bind
from pmweave.functions.names import canonical_counter, canonical_type

MDC_SCHEMA = (
    "md ARRAY<STRUCT<mi: ARRAY<STRUCT<mt: ARRAY<STRING>, "
    "mv: ARRAY<STRUCT<moid: STRING, r: ARRAY<STRING>>>>>>>, _corrupt_record STRING"
)
COLLEC_SCHEMA = (
    "measData ARRAY<STRUCT<measInfo: ARRAY<STRUCT<"
    "measType: ARRAY<STRUCT<_p: STRING, _VALUE: STRING>>, "
    "measValue: ARRAY<STRUCT<_measObjLdn: STRING, r: ARRAY<STRUCT<_p: STRING, _VALUE: STRING>>>>>>>>, "
    "_corrupt_record STRING"
)
SETUP_SCHEMA = (
    "PMSetup ARRAY<STRUCT<_startTime: STRING, _interval: STRING, PMMOResult: ARRAY<STRUCT<"
    "MO: ARRAY<STRUCT<DN: STRING, baseId: STRING, localMoid: STRING>>, "
    "PMTarget: MAP<STRING, STRING>>>>>, _corrupt_record STRING"
)
XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true"}

# How the root of the second Ericsson dialect and the counter-holding
# elements of the two Nokia dialects are told, and the one type with a rule of its own.
BEFORE_ROOT = r"\A\x{FEFF}?(?:\s++|<\?(?s:.*?)\?>|<!--(?s:.*?)-->|<!DOCTYPE[^>\[]*(?:\[[^\]]*\])?[^>]*>)*+"
COLLEC_ROOT = BEFORE_ROOT + r"<(?:[A-Za-z0-9_.-]+:)?measCollecFile[\s>]"
LTE_TARGET = r"(?:PMTarget|NE-LNBTS_)"
UMTS_TARGET = r"_Nokia"
THROUGHPUT_TYPE = "lte_cell_throughput"
THROUGHPUT_OBJECTS = 2


def detect_eric_dialect(files: DataFrame) -> DataFrame:
    """Add ``dialect``: ``3gpp`` for a measCollecFile document, else ``mdc``."""
    is_3gpp = F.regexp_like("content", F.lit(COLLEC_ROOT))
    return files.withColumn("dialect", F.when(is_3gpp, "3gpp").otherwise("mdc"))


def _or_empty(array: Column) -> Column:
    return F.coalesce(array, F.array())


def _concat_all(arrays: Column) -> Column:
    """flatten() that leaves out null members instead of turning null itself."""
    return F.flatten(F.filter(arrays, lambda a: a.isNotNull()))


def _zero_if_blank(raw: Column) -> Column:
    # from_xml has trimmed already
    return F.when(raw == "", F.lit(ZERO)).otherwise(raw)


def _mdc_blocks(doc: Column, names_scope: str) -> Column:
    """Blocks ``STRUCT<mt, mv>`` within which names pair with values by position.

    A block is an ``md``; with ``names_scope='mi'`` every ``mi`` is one. Blocks without names hold nothing.
    """
    if names_scope == "mi":
        blocks = _concat_all(doc["md"]["mi"])
    else:
        blocks = F.transform(
            doc["md"],
            lambda md: F.struct(_concat_all(md["mi"]["mt"]).alias("mt"), _concat_all(md["mi"]["mv"]).alias("mv")),
        )
    return F.filter(blocks, lambda block: F.size(block["mt"]) > 0)


def _mdc_objects(doc: Column, names_scope: str) -> Column:
    """All ``mv`` of a document as ``STRUCT<moid, md, mv, names, raws>``; empty values stay in place as zero."""
    return F.flatten(
        F.transform(
            _mdc_blocks(doc, names_scope),
            lambda block, md: F.transform(
                _or_empty(block["mv"]),
                lambda mv, at: F.struct(
                    mv["moid"].alias("moid"), md.alias("md"), at.alias("mv"), block["mt"].alias("names"),
                    F.transform(_or_empty(mv["r"]), _zero_if_blank).alias("raws"),
                ),
            ),
        )
    )


def _places(names: Column, wanted: Column) -> Column:
    """For each wanted code its last index among ``names``, null where it has none; empty if none has one."""

    def looked_up(reverse: Column) -> Column:
        last = F.size(reverse)
        return F.transform(wanted, lambda code: (last - F.nullif(F.array_position(reverse, code), F.lit(0))).cast("int"))

    found = bind(F.reverse(names), looked_up)
    return bind(found, lambda at: F.when(F.exists(at, lambda i: i.isNotNull()), at).otherwise(F.array().cast("array<int>")))


def held(raws: Column, places: Column) -> Column:
    """The values at ``places``: one per wanted code, null where the object lacks it."""
    return F.transform(places, lambda i: F.when(i.isNotNull(), _zero_if_blank(F.coalesce(F.get(raws, i), F.lit("")))))


def _mdc_configured(doc: Column, names_scope: str, wanted: Column) -> Column:
    """As ``_mdc_objects``, with the places of configured counters: ``STRUCT<moid, md, mv, raws, places>``.

    ``places`` has one index among ``raws`` per code of ``wanted``, or none at all. Where a code's value stands is looked
    up once per block, not per object, and ``raws`` are as they were parsed: ``held`` reads them when the object's turn
    comes. An object with fewer values than its block has names is looked up for itself.
    """
    blocks = F.transform(
        _mdc_blocks(doc, names_scope),
        lambda block: F.struct(
            block["mt"].alias("mt"), _places(block["mt"], wanted).alias("places"), _or_empty(block["mv"]).alias("mv")
        ),
    )

    def per_block(block: Column, md: Column) -> Column:
        def per_mv(mv: Column, at: Column) -> Column:
            n = F.coalesce(F.size(mv["r"]), F.lit(0))
            short = _places(F.slice(block["mt"], F.lit(1), n), wanted)
            places = F.when((n >= F.size(block["mt"])) | (F.size(block["places"]) == 0), block["places"]).otherwise(short)
            return F.struct(
                mv["moid"].alias("moid"), md.alias("md"), at.alias("mv"), mv["r"].alias("raws"), places.alias("places"))

        return F.transform(block["mv"], per_mv)

    return F.flatten(F.transform(blocks, per_block))


def _collec_blocks(doc: Column, label) -> Column:
    """``measInfo`` of every ``measData`` as ``STRUCT<p, names, mv>``.

    Values refer to names by ``p``. Declarations are kept in reverse, so that the first match of a
    ``p`` declared twice is its last name. ``label`` turns a name into what values are given.
    """
    infos = F.filter(_concat_all(doc["measData"]["measInfo"]), lambda info: F.size(info["measType"]) > 0)
    return F.transform(
        infos,
        lambda info: F.struct(
            F.reverse(info["measType"]["_p"]).alias("p"),
            F.transform(F.reverse(info["measType"]["_VALUE"]), label).alias("names"),
            _or_empty(info["measValue"]).alias("mv"),
        ),
    )


def _declared(block: Column, p: Column) -> Column:
    return F.get(block["names"], F.array_position(block["p"], p).cast("int") - 1)


def _text_of(r: Column) -> Column:
    return _zero_if_blank(F.coalesce(r["_VALUE"], F.lit("")))


def _collec_objects(doc: Column) -> Column:
    """All ``measValue`` in the shape of ``_mdc_objects``; a value with an undeclared ``p`` has a null name."""
    return F.flatten(
        F.transform(
            _collec_blocks(doc, lambda name: name),
            lambda block, md: F.transform(
                block["mv"],
                lambda value, at: F.struct(
                    value["_measObjLdn"].alias("moid"), md.alias("md"), at.alias("mv"),
                    F.transform(_or_empty(value["r"]), lambda r: _declared(block, r["_p"])).alias("names"),
                    F.transform(_or_empty(value["r"]), _text_of).alias("raws"),
                ),
            ),
        )
    )


def _collec_configured(doc: Column, wanted: Column) -> Column:
    """All ``measValue`` in the shape of ``_mdc_configured``.

    Values mostly come in the order of the names they refer to; then they are read by the block's places. Others
    are looked up one by one.
    """
    none = F.array().cast("array<string>")

    def by_reference(value: Column, block: Column) -> Column:
        pairs = F.filter(
            F.transform(
                _or_empty(value["r"]),
                lambda r: F.struct(_declared(block, r["_p"]).alias("at"), _text_of(r).alias("raw")),
            ),
            lambda pair: pair["at"] > 0,
        )
        return bind(pairs, lambda held: F.when(F.size(held) == 0, none).otherwise(F.transform(
            wanted,
            lambda _, i: F.try_element_at(F.filter(held, lambda pair: pair["at"] == i + 1), F.lit(-1))["raw"],
        )))

    def placed(values: Column) -> Column:
        return F.struct(values.alias("raws"), F.transform(values, lambda v, i: F.when(v.isNotNull(), i)).alias("places"))

    def one(value: Column, at: Column, md: Column, block: Column) -> Column:
        in_order = block["plain"] & (value["r"]["_p"] == block["order"])
        found = F.when(F.coalesce(in_order, F.lit(False)), F.struct(
            value["r"]["_VALUE"].alias("raws"), block["places"].alias("places"))).otherwise(bind(by_reference(value, block), placed))
        return bind(found, lambda f: F.struct(
            value["_measObjLdn"].alias("moid"), md.alias("md"), at.alias("mv"), f["raws"].alias("raws"), f["places"].alias("places")))

    blocks = F.transform(
        _collec_blocks(doc, lambda name: name),
        lambda block: F.struct(
            block["p"].alias("p"), F.reverse(block["p"]).alias("order"), block["mv"].alias("mv"),
            (F.size(F.array_distinct(block["p"])) == F.size(block["p"])).alias("plain"),
            _places(F.reverse(block["names"]), wanted).alias("places"),
            F.transform(block["names"], lambda name: F.array_position(wanted, name).cast("int")).alias("names"),
        ),
    )
    return F.flatten(
        F.transform(
            blocks, lambda block, md: F.transform(block["mv"], lambda value, at: one(value, at, md, block)),
        )
    )


def parse_eric(files: DataFrame, names_scope: str = "md", codes: list[str] | None = None) -> DataFrame:
    """One row per document with its ``objects`` array; ``corrupt`` holds an unreadable text.

    Both dialects in one pass over the input; a row is parsed with its own schema only. Objects
    are ``STRUCT<moid, md, mv, names, raws>``; with ``codes`` they tell only of these counters, as
    ``STRUCT<moid, md, mv, raws, places>``: ``held(raws, places)`` gives one value per code in this order, null where the
    object lacks it, and is empty where it lacks all.
    """
    kept = [c for c in files.columns if c not in ("content", "dialect")]
    typed = files if "dialect" in files.columns else detect_eric_dialect(files)
    is_mdc = F.col("dialect") == "mdc"
    if codes is None:
        mdc, collec = _mdc_objects(F.col("_mdc"), names_scope), _collec_objects(F.col("_collec"))
    else:
        wanted = F.array(*[F.lit(c) for c in codes])
        mdc = _mdc_configured(F.col("_mdc"), names_scope, wanted)
        collec = _collec_configured(F.col("_collec"), wanted)
    return (
        typed.select(
            *kept, "dialect",
            F.when(is_mdc, F.from_xml("content", MDC_SCHEMA, XML_OPTIONS)).alias("_mdc"),
            F.when(~is_mdc, F.from_xml("content", COLLEC_SCHEMA, XML_OPTIONS)).alias("_collec"),
        )
        .select(
            *kept, "dialect",
            F.when(is_mdc, mdc).otherwise(collec).alias("objects"),
            F.coalesce("_mdc._corrupt_record", "_collec._corrupt_record").alias("corrupt"),
        )
    )


def _objects_as_rows(parsed: DataFrame) -> DataFrame:
    kept = [c for c in parsed.columns if c not in ("objects", "corrupt", "dialect")]
    # An inner explode lets the optimizer test the array for emptiness below the projection that
    # parses it, which would parse every document twice; the outer one does not.
    rows = parsed.select(*kept, F.explode_outer("objects").alias("_o")).filter(F.col("_o").isNotNull())
    return rows.select(*kept, "_o.*")


def shred_mdc(files: DataFrame, names_scope: str = "md") -> DataFrame:
    """One row per ``mv``: file columns, ``moid, md, mv, names, raws``."""
    return _objects_as_rows(parse_eric(files.withColumn("dialect", F.lit("mdc")), names_scope))


def shred_3gpp(files: DataFrame) -> DataFrame:
    """One row per ``measValue``: file columns, ``moid, md, mv, names, raws``."""
    return _objects_as_rows(parse_eric(files.withColumn("dialect", F.lit("3gpp"))))


def shred_eric(files: DataFrame, names_scope: str = "md") -> DataFrame:
    """Both Ericsson dialects, told by the root element."""
    return _objects_as_rows(parse_eric(files, names_scope))


def _rename_targets(content: Column, mark: str) -> Column:
    """Give every counter-holding element the one tag ``PMTarget``.

    A self-closing one gets a child: with attributes alone it would parse to null and
    lose its measurement type, while an object without counters still is an object.
    """
    name = rf"[^\s<>/]*{mark}[^\s<>/]*"
    opened = F.when(
        F.contains(content, F.lit("/>")),
        F.regexp_replace(content, rf"<{name}(\s[^<>]*)?/>", "<PMTarget$1><_none/></PMTarget>"),
    ).otherwise(content)
    return F.regexp_replace(opened, rf"<(/?){name}", "<$1PMTarget")


def parse_nokia(files: DataFrame, target: str) -> DataFrame:
    """One row per document with its ``PMSetup`` array; ``corrupt`` holds an unreadable text."""
    kept = [c for c in files.columns if c != "content"]
    text = _rename_targets(F.col("content"), target)
    return files.select(*kept, F.from_xml(text, SETUP_SCHEMA, XML_OPTIONS).alias("_doc")).select(
        *kept, F.col("_doc.PMSetup").alias("setups"), F.col("_doc._corrupt_record").alias("corrupt")
    )


def setups_as_rows(parsed: DataFrame, lower_codes: bool, keep_empty: bool, rule=None, findings=None) -> DataFrame:
    """One row per ``PMMOResult``, numbered through its document in ``object_pos`` of ``object_count``.

    ``counters`` holds the element texts below the target; attributes are taken out. ``rule(meas_type, mo, counters)``
    may replace them. With ``keep_empty`` a document without objects keeps one row, and ``corrupt`` tells why.
    ``findings(objects)``, an array made of the document's objects, comes as a column of that name on its first row.
    """
    kept = [c for c in parsed.columns if c not in ("setups", "corrupt")]
    if keep_empty:
        parsed = parsed.withColumn("corrupt", F.col("corrupt").isNotNull())
        kept.append("corrupt")
    numbered = F.flatten(
        F.transform(
            "setups",
            lambda s: F.transform(
                _or_empty(s["PMMOResult"]),
                lambda r: F.struct(
                    s["_startTime"].alias("start_time"),
                    s["_interval"].alias("interval"),
                    canonical_type(F.try_element_at(r["PMTarget"], F.lit("_measurementType"))).alias("meas_type"),
                    _or_empty(r["MO"]).alias("mo"),
                    F.map_filter(r["PMTarget"], lambda k, v: ~k.startswith("_")).alias("counters"),
                ),
            ),
        )
    )

    def finished(o: Column) -> Column:
        counters = F.coalesce(lower_counter_codes(o["counters"]) if lower_codes else o["counters"], F.create_map().cast("map<string,string>"))
        return F.struct(
            o["start_time"].alias("start_time"), o["interval"].alias("interval"), o["meas_type"].alias("meas_type"), o["mo"].alias("mo"),
            (rule(o["meas_type"], o["mo"], counters) if rule else counters).alias("counters"),
        )

    documents = parsed.select(*kept, F.transform(numbered, finished).alias("_objects"))
    if findings:
        documents = documents.select(*kept, "_objects", findings(F.coalesce("_objects", F.array())).alias("findings"))
    rows = documents.select(
        *kept, *(["findings"] if findings else []), F.size("_objects").alias("object_count"),
        # outer for the reason given in _objects_as_rows
        F.posexplode_outer("_objects").alias("object_pos", "_o"),
    )
    if not keep_empty:
        rows = rows.filter(F.col("object_pos").isNotNull())
    found = [F.when(F.coalesce("object_pos", F.lit(0)) == 0, F.col("findings")).alias("findings")] if findings else []
    return rows.select(*kept, "object_pos", "object_count", "_o.*", *found)


def lower_counter_codes(counters: Column) -> Column:
    """Canonical codes as map keys; of two spellings of one code the later value counts."""

    def last_spelling(entries: Column) -> Column:
        return F.filter(
            entries,
            lambda e, at: ~F.exists(
                F.slice(entries, at + 2, F.size(entries)),
                lambda later: canonical_counter(later["key"]) == canonical_counter(e["key"]),
            ),
        )

    keys = F.transform(F.map_keys(counters), canonical_counter)
    clash = F.size(F.array_distinct(keys)) < F.size(keys)
    unique = F.when(
        clash, F.map_from_entries(bind(F.map_entries(counters), last_spelling))
    ).otherwise(counters)
    return F.transform_keys(unique, lambda k, v: canonical_counter(k))


def shred_nokia_lte(files: DataFrame, keep_empty: bool = False, findings=None) -> DataFrame:
    """One row per ``PMMOResult`` of LTE documents, the throughput rule applied."""
    return setups_as_rows(parse_nokia(files, LTE_TARGET), False, keep_empty, throughput_counters, findings)


def shred_nokia_umts(files: DataFrame, keep_empty: bool = False, findings=None) -> DataFrame:
    """One row per ``PMMOResult`` of UMTS documents, counter codes in lower case."""
    return setups_as_rows(parse_nokia(files, UMTS_TARGET), True, keep_empty, findings=findings)


def throughput_counters(meas_type: Column, mo: Column, counters: Column) -> Column:
    """Counters of the throughput type count only below exactly two managed objects, those of any other LTE type below at least one."""
    drop = F.when(meas_type == THROUGHPUT_TYPE, F.size(mo) != THROUGHPUT_OBJECTS).otherwise(F.size(mo) == 0)
    return F.when(drop, F.create_map().cast("map<string,string>")).otherwise(counters)


def throughput_mo_filter(objects: DataFrame) -> DataFrame:
    """``throughput_counters`` over rows of objects."""
    return objects.withColumn("counters", throughput_counters(F.col("meas_type"), F.col("mo"), F.col("counters")))


def explode_counters(objects: DataFrame) -> DataFrame:
    """``pm_long``: one row per counter, ``counter STRING, raw STRING, pos STRUCT<...>``.

    Works on objects with ``names``/``raws`` arrays and on objects with a ``counters`` map.
    """
    if "names" in objects.columns:
        kept = [c for c in objects.columns if c not in ("names", "raws", "md", "mv")]
        paired = F.zip_with("names", "raws", lambda n, v: F.struct(n.alias("counter"), v.alias("raw")))
        return (
            objects.select(*kept, "md", "mv", F.posexplode(paired).alias("r", "_c"))
            .filter(F.col("_c.counter").isNotNull() & F.col("_c.raw").isNotNull())
            .select(*kept, "_c.counter", "_c.raw", F.struct("md", "mv", "r").alias("pos"))
        )
    kept = [c for c in objects.columns if c not in ("counters", "object_pos", "object_count", "mo")]
    return objects.select(
        *kept, "object_pos", F.explode("counters").alias("counter", "raw")
    ).select(*kept, "counter", "raw", F.struct("object_pos").alias("pos"))
