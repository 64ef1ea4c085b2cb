"""Column expressions against results written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pmweave.functions import arrays, identity, names
from pmweave.plans.ericsson import eric_file_fields

NAME = "%s_%s_A%s.%s-%s_SubNetwork=ROOT,SubNetwork=Manhattan,MeContext=LBK04025A_statsfile.xml"


def one(spark, value, *columns, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


@pytest.mark.parametrize(
    "name, oss, start",
    [
        ("/in/" + NAME % ("OSS1", "-0400", "20170807", "1200-0400", "1215-0400"), "OSS1", dt.datetime(2017, 8, 7, 12)),
        (NAME % ("", "-0400", "20170807", "1200-0400", "1215-0400"), "Unknown", dt.datetime(2017, 8, 7, 12)),
        (NAME % ("OSS1", "-0400", "20170807", "1200+0000", "1215+0000"), "OSS1", dt.datetime(2017, 8, 7, 8)),
        (NAME % ("OSS1", "-0400", "20170807", "0010+0000", "0025+0000"), "OSS1", dt.datetime(2017, 8, 6, 20, 10)),
        (NAME % ("OSS1", "+0530", "20170807", "1200+0000", "1215+0000"), "OSS1", dt.datetime(2017, 8, 7, 17)),
        ("not a measurement file.xml", "Unknown", None),
    ],
)
def test_eric_file_fields(spark, name, oss, start):
    row = eric_file_fields(spark.createDataFrame([(name,)], "file_path string")).first()
    assert (row.oss, row.period_start) == (oss, start)
    if start:
        assert (row.sub_network, row.me_context) == ("Manhattan", "LBK04025A")
        assert row.hour_start == start.replace(minute=0)


def test_wall_clock_times_do_not_depend_on_the_session_zone(spark):
    """02:30 on the day clocks go forward does not exist in New York, but it does in a file name."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        name = NAME % ("OSS1", "+0000", "20170312", "0230+0000", "0245+0000")
        row = eric_file_fields(spark.createDataFrame([(name,)], "file_path string")).select(
            names.minute_text(F.col("period_start")).alias("start"), names.minute_text(F.col("hour_start")).alias("hour")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("2017-03-12 02:30", "2017-03-12 02:00")


def test_nokia_names(spark):
    x = F.col("x")
    assert one(spark, r"C:\in\RNC7_rest_of_it.xml", names.nokia_oss(x)).c0 == "RNC7"
    assert one(spark, "a/b/", names.base_name(x)).c0 == "a/b/"
    assert one(spark, "2017-06-14T15:00:00.000-04:00", names.nokia_start(x)).c0 == dt.datetime(2017, 6, 14, 15)
    assert one(spark, "soon", names.nokia_start(x), names.nokia_duration(x)) == (None, None)
    assert one(spark, "M1024C4", names.canonical_counter(x)).c0 == "m1024c4"
    assert one(spark, "baseId", names.canonical_counter(x)).c0 == "baseId"


@pytest.mark.parametrize(
    "moid, lte, umts, relation",
    [
        ("ManagedElement=1,EUtranCellFDD=C1", "C1", None, None),
        ("EUtranCellFDD=C1,EUtranFreqRelation=5,EUtranCellRelation=9", "C1", None, None),
        ("RncFunction=1,UtranCell=U7", None, "U7", None),
        ("UtranCell=U7 rest", None, "U7", None),
        ("UtranCell=U7,UtranFreqRelation=3,UtranCellRelation=4", None, "U7", ("umtscell", "3", "4")),
        ("UtranCell=U7,EUtranFreqRelation=3,EUtranCellRelation=4,X=1", None, "U7", ("ltecell", "3", "4")),
        ("UtranCell=U7,GeranFreqGroupRelation=3,GeranCellRelation=4", None, "U7", ("gsmcell", "3", "4")),
        ("UtranCell=U7,EUtranFreqRelation=3,UtranFreqRelation=3,UtranCellRelation=1", None, "U7", None),
        ("UtranCell=U7,UtranFreqRelation=3", None, "U7", None),
        ("ENodeBFunction=1", None, None, None),
        ("X=1,vsDataEUtranCellFDD=C1,Y=2", "C1", None, None),
        ("X=1,EUtranCell=C1", None, None, None),
        (None, None, None, None),
    ],
)
def test_eric_identity(spark, moid, lte, umts, relation):
    x = F.col("x")
    row = one(spark, moid, identity.eric_cell_id_lte(x), identity.eric_cell_id_umts(x), identity.eric_relation(x))
    assert (row.c0, row.c1, tuple(row.c2) if row.c2 else None) == (lte, umts, relation)


MO = "x array<struct<DN string, baseId string, localMoid string>>"


def test_nokia_lte_identity(spark):
    x = F.col("x")
    columns = [
        identity.nokia_lte_cell_id(x), identity.nokia_lte_plmn(x),
        identity.nokia_lte_cell_id_2(identity.nokia_lte_plmn(x), identity.nokia_lte_cell_id(x)),
        identity.nokia_neighbour_target(x),
    ]
    plmn = ("PLMN-PLMN/MCC-310/MNC-260", None, None)
    dn = ("PLMN-PLMN/MRBTS-1/LNBTS-7/LNCEL-2", None, None)
    assert tuple(one(spark, [dn, plmn], *columns, schema=MO)) == (dn[0], "310260", "310260-7-2", None)
    split = (None, "NE-MRBTS-12", "DN:NE-LNBTS-7/LNCEL-2")
    assert tuple(one(spark, [split, plmn, ("N1", None, None)], *columns, schema=MO)) == (
        "PLMN-PLMN/MRBTS-12/LNBTS-7/LNCEL-2", "310260", "310260-7-2", "N1")
    assert tuple(one(spark, [("PLMN-PLMN/MRBTS-1", None, None)], *columns, schema=MO))[2] is None


def test_nokia_umts_identity(spark):
    x = F.col("x")
    base, local = identity.nokia_base_id(x), identity.nokia_local_moid(x)
    columns = [
        local, identity.nokia_umts_cell_id_1(base, local), identity.nokia_umts_cell_id_2(base, local),
        identity.nokia_traffic_class(x),
    ]
    mo = [
        (None, "NE-RNC-5", "DN:NE-WBTS-12/WCEL-1"),
        ("PLMN-PLMN/TR_CLASS-background/TR_SUBCLASS-PS_NRT_data", None, None),
        ("PLMN-PLMN/ChType-HSUPA", None, None),
    ]
    assert tuple(one(spark, mo, *columns, schema=MO)) == (
        "NE-WBTS-12/WCEL-1", "PLMN-PLMN/RNC-5/WBTS-12/WCEL-1", "5-12-1", ("background", "PS_NRT_data", "HSUPA"))
    assert tuple(one(spark, [(None, None, "X-1/Y-2")], *columns, schema=MO)) == (
        "X-1/Y-2", "", "X-1/Y-2", ("", "", ""))


@pytest.mark.parametrize(
    "raw, dense",
    [
        ("2,1,7,9,5", "0,7,0,0,0,0,0,0,0,5"),
        ("0", "0,0,0,0,0,0,0,0,0,0"),
        ("3,1,7,1,8,12,4", "0,8,0,0,0,0,0,0,0,0"),
        ("3,1,7", "0,7,0,0,0,0,0,0,0,0"),
        ("", "0,0,0,0,0,0,0,0,0,0"),
        ("x", "0,0,0,0,0,0,0,0,0,0"),
        (None, "0,0,0,0,0,0,0,0,0,0"),
    ],
)
def test_expand_comp(spark, raw, dense):
    assert one(spark, raw, arrays.expand_comp(F.col("x"), 10)).c0 == dense.split(",")


@pytest.mark.parametrize(
    "raw, fixed",
    [("2,1", "2,1,0,0"), ("2,1,7,9,5", "2,1,7,9"), ("", "0,0,0,0"), ("1,,3", "1,0,3,0"), (None, "0,0,0,0")],
)
def test_expand_pdf(spark, raw, fixed):
    assert one(spark, raw, arrays.expand_pdf(F.col("x"), 4)).c0 == fixed.split(",")


def test_other_kinds(spark):
    x = F.col("x")
    assert one(spark, "1,2,3", arrays.expand_single(x)).c0 == "1"
    assert one(spark, ",".join("abcdefghijkl"), arrays.expand_special(x)).c0 == list("abcdefghij")
    assert one(spark, "1", arrays.expand_special(x)).c0 == ["1"] + ["0"] * 9
    for spec, kind, dim in [
        ("Single", "Single", 1), ("PDF[42]", "PDF", 42), ("COMP[10]", "COMP", 10), ("SPECIAL", "SPECIAL", 10),
        ("FOO", None, None), ("PDF", "PDF", None),
    ]:
        assert tuple(one(spark, spec, arrays.counter_kind(x), arrays.counter_dim(x))) == (kind, dim)
