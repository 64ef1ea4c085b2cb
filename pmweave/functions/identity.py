"""Object identity: cells, relations, neighbours and traffic classes out of object names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pmweave.functions.arrays import bind

# Keywords inside object names.
LTE_CELL_KEY = "EUtranCellFDD"
UMTS_CELL_KEY = "UtranCell"
RELATION_KEYS = {
    # relation table: (frequency part, cell part); tried in this order
    "ltecell": ("EUtranFreqRelation", "EUtranCellRelation"),
    "umtscell": ("UtranFreqRelation", "UtranCellRelation"),
    "gsmcell": ("GeranFreqGroupRelation", "GeranCellRelation"),
}
PLMN_ROOT = "PLMN-PLMN/"
TRAFFIC_CLASS_MARK = "TR_CLASS"
CHANNEL_TYPE_MARK = "ChType-"


def _tail(text: Column, key: str) -> Column:
    """Everything after the first ``key=``; null without one."""
    at = F.instr(text, f"{key}=")
    return F.when(at > 0, F.substr(text, at + F.lit(len(key) + 1)))


def _part_tail(text: Column, key: str) -> Column:
    """As ``_tail``, for a key that starts the name or follows a comma."""
    return F.when(F.startswith(text, F.lit(f"{key}=")), F.substr(text, F.lit(len(key) + 2))).otherwise(
        _tail(text, f",{key}")
    )


def _below_cell(moid: Column, technology: str) -> Column:
    """What follows the cell keyword. The short UMTS keyword must be a whole part of the name."""
    return _part_tail(moid, UMTS_CELL_KEY) if technology == "UMTS" else _tail(moid, LTE_CELL_KEY)


def _value(tail: Column) -> Column:
    """Up to the next comma; without a comma, up to a blank; else to the end."""
    cut = F.when(F.contains(tail, F.lit(",")), F.substring_index(tail, ",", 1)).otherwise(
        F.substring_index(tail, " ", 1)
    )
    return F.nullif(cut, F.lit(""))


def eric_cell_id_lte(moid: Column) -> Column:
    """Cell of an LTE object name, null when it names none."""
    return _value(_tail(moid, LTE_CELL_KEY))


def eric_cell_id_umts(moid: Column, technology: str = "UMTS") -> Column:
    """Cell of an object name, the keyword chosen by technology."""
    return _value(_below_cell(moid, technology))


def eric_relation(moid: Column, technology: str = "UMTS") -> Column:
    """``STRUCT<rel_type, freq_rel, cell_rel>`` of a relation below a cell, null at cell grain.

    The first relation table whose frequency part occurs decides; if its cell part
    is missing the object stays at cell grain.
    """
    def classify(below: Column) -> Column:
        decided = F
        for rel_type, (freq_key, cell_key) in RELATION_KEYS.items():
            named = F.contains(below, F.lit(f"{freq_key}="))
            decided = decided.when(named, _relation(below, rel_type, freq_key, cell_key))
        return decided

    return bind(_below_cell(moid, technology), classify)


def _relation(below: Column, rel_type: str, freq_key: str, cell_key: str) -> Column:
    def both(from_freq: Column) -> Column:
        from_cell = _tail(from_freq, cell_key)
        return F.when(
            from_cell.isNotNull(),
            F.struct(
                F.lit(rel_type).alias("rel_type"),
                _value(from_freq).alias("freq_rel"),
                _value(from_cell).alias("cell_rel"),
            ),
        )

    return bind(_tail(below, freq_key), both)


def _dash_part(text: Column, n: int) -> Column:
    """n-th part between dashes, counted from 0; null past the end."""
    return F.get(F.split(text, "-"), F.lit(n))


def _path_part(text: Column, n: int) -> Column:
    return F.get(F.split(text, "/"), F.lit(n))


def nokia_lte_cell_id(mo: Column) -> Column:
    """Cell of the first managed object: its ``DN``, else put together from ``baseId`` and ``localMoid``."""
    first = F.get(mo, F.lit(0))
    base = F.concat(F.lit(PLMN_ROOT), _dash_part(first["baseId"], 1), F.lit("-"), _dash_part(first["baseId"], 2))
    local = F.concat_ws("-", *[_dash_part(first["localMoid"], n) for n in (1, 2, 3)])
    has_local = _dash_part(first["localMoid"], 3).isNotNull()
    return F.coalesce(first["DN"], F.when(has_local, F.concat(base, F.lit("/"), local)))


def nokia_lte_plmn(mo: Column) -> Column:
    """``PLMN-PLMN/MCC-310/MNC-260`` of the second managed object becomes ``310260``."""
    dn = F.get(mo, F.lit(1))["DN"]
    return F.concat(_dash_part(_path_part(dn, 1), 1), _dash_part(_path_part(dn, 2), 1))


def nokia_lte_cell_id_2(plmn: Column, cell_id: Column) -> Column:
    """``plmn-site-cell``; null when the cell name has fewer than four path parts."""
    return F.concat(
        F.coalesce(plmn, F.lit("")), F.lit("-"),
        _dash_part(_path_part(cell_id, 2), 1), F.lit("-"),
        _dash_part(_path_part(cell_id, 3), 1),
    )


def nokia_neighbour_target(mo: Column) -> Column:
    """The third managed object: its ``DN``, else its ``localMoid``."""
    third = F.get(mo, F.lit(2))
    return F.coalesce(third["DN"], third["localMoid"])


def _last_with(mo: Column, field: str) -> Column:
    return F.try_element_at(F.filter(mo, lambda m: m[field].isNotNull()), F.lit(-1))[field]


def _after_first(text: Column, mark: str) -> Column:
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + F.lit(1))).otherwise(text)


def nokia_base_id(mo: Column) -> Column:
    return _last_with(mo, "baseId")


def nokia_local_moid(mo: Column) -> Column:
    return _after_first(_last_with(mo, "localMoid"), ":")


def nokia_umts_cell_id_1(base_id: Column, local_moid: Column) -> Column:
    name = F.concat(
        F.lit(PLMN_ROOT), _after_first(base_id, "-"), F.lit("/"), _after_first(local_moid, "-")
    )
    return F.coalesce(name, F.lit(""))


def nokia_umts_cell_id_2(base_id: Column, local_moid: Column) -> Column:
    """``rnc-bts-cell``, each the text after the last dash; the local name when a part is missing."""
    name = F.concat(
        F.substring_index(base_id, "-", -1), F.lit("-"),
        F.substring_index(_path_part(local_moid, 0), "-", -1), F.lit("-"),
        F.substring_index(_path_part(local_moid, 1), "-", -1),
    )
    return F.coalesce(name, local_moid)


def _last_dn(mo: Column, mark: str) -> Column:
    return F.try_element_at(F.filter(mo, lambda m: F.contains(m["DN"], F.lit(mark))), F.lit(-1))["DN"]


def nokia_traffic_class(mo: Column) -> Column:
    """``STRUCT<tr_class, tr_subclass, ch_type>`` out of the object names; empty strings where absent."""
    class_dn, channel_dn = _last_dn(mo, TRAFFIC_CLASS_MARK), _last_dn(mo, CHANNEL_TYPE_MARK)
    blank = F.lit("")
    return F.struct(
        F.coalesce(_after_first(_path_part(class_dn, 1), "-"), blank).alias("tr_class"),
        F.coalesce(_after_first(_path_part(class_dn, 2), "-"), blank).alias("tr_subclass"),
        F.coalesce(_after_first(_path_part(channel_dn, 1), "-"), blank).alias("ch_type"),
    )
