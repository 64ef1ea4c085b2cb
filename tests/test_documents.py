"""Whole documents through shredders and jobs; expected rows written by hand."""

import gzip
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pmweave.__main__ import main
from pmweave.functions.identity import eric_cell_id_lte
from pmweave.operators.merge import merge_documents, merge_last, widen
from pmweave.operators.quality import array_length_issues, issues_of, missing_counters_eric
from pmweave.operators.shred import (
    detect_eric_dialect, explode_counters, lower_counter_codes, parse_eric, shred_3gpp, shred_eric, shred_mdc,
)
from pmweave.plans import ericsson, nokia
from pmweave.sinks import published
from pmweave.sources import load_catalog, load_settings, read_counter_catalog, read_pm_files, read_pm_sequence
from pmweave.sources.catalog import Counter, Settings
from pmweave.sources.files import text_of
from pmweave.streaming.landing import land_batches, stream_pm_files

ERIC_NAME = "OSS1_-0400_A20170807.1200-0400-1215-0400_SubNetwork=ROOT,SubNetwork=Manhattan,MeContext=%s_statsfile.xml"
CELL = "ManagedElement=1,ENodeBFunction=1,EUtranCellFDD="
MDC = f"""<?xml version="1.0"?>
<mdc><mfh/><md><mi>
  <mt>pmA</mt><mt>pmB</mt><mt>pmHist</mt><mt>pmUnlisted</mt>
  <mv><moid>{CELL}C1</moid><r>1</r><r/><r>1,2,3</r><r>8</r></mv>
  <mv><moid>{CELL}C2</moid><r>5</r></mv>
  <mv><moid>ManagedElement=1</moid><r>99</r></mv>
  <mv><r>77</r></mv>
</mi></md><md><mi>
  <mt>pmA</mt><mt>pmComp</mt>
  <mv><moid>{CELL}C1</moid><r>3</r><r>2,1,7,9,5</r></mv>
  <mv><moid>{CELL}C1,EUtranFreqRelation=5,EUtranCellRelation=9</moid><r>4</r></mv>
</mi></md></mdc>
"""
COLLEC = """<m:measCollecFile xmlns:m="urn:x"><m:measData><m:measInfo>
  <m:measType p="1">pmA</m:measType><m:measType p="2">pmB</m:measType>
  <m:measValue measObjLdn="X=1,EUtranCellFDD=C9"><m:r p="2">5</m:r><m:r p="1"/><m:r p="7">6</m:r></m:measValue>
  <m:measValue><m:r p="1">6</m:r></m:measValue>
</m:measInfo></m:measData><m:measData><m:measInfo><m:measType p="1">pmA</m:measType>
  <m:measValue measObjLdn="X=1,EUtranCellFDD=C9"><m:r p="1">1000</m:r></m:measValue>
</m:measInfo></m:measData></m:measCollecFile>
"""
LTE_ERIC_INI = """[General]
Region=East
Market=M1
HL_MARKET=HM
; Region=West
[Table]
TAB1=pmComp:COMP[10],pmA:Single,pmB:Single,pmHist:PDF[4]
"""
UMTS_ERIC_INI = """[General]
Technology=UMTS
[Table]
;Old=pmX:Single
Site=pmA:Single
LTECell=pmA:Single,pmB:PDF[2]
"""


def pm_files(spark, *named):
    return spark.createDataFrame([(n, n, c) for n, c in named], "file_path string, file_name string, content string")


def catalog_of(spark, tmp_path, text, vendor):
    path = tmp_path / "counters.ini"
    path.write_text(text)
    return load_catalog(read_counter_catalog(spark, str(path), vendor)), load_settings(spark, str(path))


def test_catalog(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_ERIC_INI, "ericsson")
    assert [(e.code, e.kind, e.dim) for e in catalog["tab1"]] == [
        ("pmComp", "COMP", 10), ("pmA", "Single", 1), ("pmB", "Single", 1), ("pmHist", "PDF", 4)]
    assert settings == Settings("East", "M1", "HM", "LTE")
    with pytest.raises(ValueError, match="pmX"):
        catalog_of(spark, tmp_path, "[Table]\nt=pmX:FOO\n", "ericsson")


def test_shred_mdc(spark):
    rows = shred_mdc(pm_files(spark, ("f", MDC))).orderBy("md", "mv").collect()
    assert [(r.md, r.mv, r.moid) for r in rows] == [
        (0, 0, CELL + "C1"), (0, 1, CELL + "C2"), (0, 2, "ManagedElement=1"), (0, 3, None),
        (1, 0, CELL + "C1"), (1, 1, CELL + "C1,EUtranFreqRelation=5,EUtranCellRelation=9")]
    assert (rows[0].names, rows[0].raws) == (["pmA", "pmB", "pmHist", "pmUnlisted"], ["1", "0", "1,2,3", "8"])
    tall = explode_counters(shred_mdc(pm_files(spark, ("f", MDC)))).filter(F.col("moid") == CELL + "C2").collect()
    assert [(r.counter, r.raw) for r in tall] == [("pmA", "5")]


def test_names_scope(spark):
    text = """<mdc><md><mi><mt>a</mt><mv><moid>x</moid><r>1</r></mv></mi>
    <mi><mt>b</mt><mv><moid>y</moid><r>2</r></mv></mi></md></mdc>"""
    for scope, second in (("md", ["a", "b"]), ("mi", ["b"])):
        rows = shred_mdc(pm_files(spark, ("f", text)), scope).filter("moid = 'y'").collect()
        assert [r.names for r in rows] == [second]


def test_shred_3gpp_and_dialect(spark):
    files = pm_files(spark, ("a", MDC), ("b", COLLEC))
    assert {r.file_path: r.dialect for r in detect_eric_dialect(files).collect()} == {"a": "mdc", "b": "3gpp"}
    rows = shred_3gpp(pm_files(spark, ("b", COLLEC))).orderBy("md", "mv").collect()
    assert [(r.moid, r.names, r.raws) for r in rows] == [
        ("X=1,EUtranCellFDD=C9", ["pmB", "pmA", None], ["5", "0", "6"]), (None, ["pmA"], ["6"]),
        ("X=1,EUtranCellFDD=C9", ["pmA"], ["1000"])]
    assert shred_eric(files).count() == 9


def test_dialect_is_told_by_the_root_alone(spark):
    before = '<?xml version="1.0"?>\n<!DOCTYPE x>\n<!-- <mdc> <measCollecFile > -->\n'
    files = pm_files(spark, ("a", before + MDC), ("b", before + COLLEC), ("c", MDC + "<!-- <measCollecFile > -->"), ("d", ""))
    assert {r.file_path: r.dialect for r in detect_eric_dialect(files).collect()} == {"a": "mdc", "b": "3gpp", "c": "mdc", "d": "mdc"}


def test_every_member_of_a_gzip_text_is_read():
    assert text_of(gzip.compress(b"<mdc>") + gzip.compress(b"</mdc>")) == "<mdc></mdc>"


def test_cells_without_configured_counters_stay(spark):
    tall = spark.createDataFrame([("f", "C1", "pmA", "1"), ("f", "C2", "other", "2")], "file_path string, cell_id string, counter string, raw string")
    assert {(r.cell_id, tuple(r.counters.items())) for r in widen(tall, ["file_path", "cell_id"], ["pmA"]).collect()} == {("C1", (("pmA", "1"),)), ("C2", ())}


def test_merge_in_document_equals_tall_merge(spark):
    codes = ["pmComp", "pmA", "pmB", "pmHist"]
    files = pm_files(spark, ("a", MDC), ("b", COLLEC))
    tall = (
        explode_counters(shred_eric(files)).withColumn("cell_id", eric_cell_id_lte(F.col("moid")))
        .filter("cell_id is not null")
    )
    keys = ["file_path", "cell_id"]
    wide = widen(merge_last(tall, keys), keys, codes)
    expected = {(r.file_path, r.cell_id): r.counters for r in wide.collect()}
    got = {
        (r.file_path, r.cell_id): {c: v for c, v in zip(codes, r["values"], strict=False) if v is not None}
        for r in merge_documents(parse_eric(files, codes=codes), ericsson.lte_identity).collect()
    }
    assert got == expected
    assert got[("a", "C1")] == {"pmComp": "2,1,7,9,5", "pmA": "4", "pmB": "0", "pmHist": "1,2,3"}


def test_lte_ericsson_job(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_ERIC_INI, "ericsson")
    files = pm_files(
        spark, (ERIC_NAME % "N1", MDC), (ERIC_NAME % "N2", COLLEC), (ERIC_NAME % "N3", MDC[:300]), ("odd.xml", MDC))
    ericsson.run(spark, files, catalog, settings, "LTE", str(tmp_path / "out"), "run-1")
    lines = [x for p in sorted((tmp_path / "out/report").glob("part-*")) for x in p.read_text().splitlines()]
    header = ("MGR_RUN_ID,HL_DATE,HL_MARKET,Cntr,Region,Market,SubNetwork_2,PERIOD_START_TIME,PERIOD_DURATION,"
              "MeContext,OSSName,EUtranCellFDD,"
              + ",".join(f"pmComp_{i}" for i in range(10)) + ",pmA,pmB,pmHist_0,pmHist_1,pmHist_2,pmHist_3")
    front = "run-1,2017-08-07 12:00,HM,1,East,M1,Manhattan,2017-08-07 12:00,15,%s,OSS1,%s,"
    assert sorted(x for x in set(lines) if not x.startswith("MGR")) == [
        front % ("N1", "C1") + "0,7,0,0,0,0,0,0,0,5,4,0,1,2,3,0",
        front % ("N1", "C2") + "0,0,0,0,0,0,0,0,0,0,5,0,0,0,0,0",
        front % ("N2", "C9") + "0,0,0,0,0,0,0,0,0,0,1000,5,0,0,0,0",
    ]
    assert header in lines
    found = spark.read.option("header", True).csv(str(tmp_path / "out/issues"))
    seen = {(r.kind, r.item) for r in found.collect() if "N1" in r.file_path}
    assert seen == {("missing", "pmComp"), ("missing", "pmB"), ("missing", "pmHist"), ("length", "pmHist"), ("no_name", "1")}
    assert {r.kind for r in found.collect() if "N3" in r.file_path} == {"bad_file"} | {
        r.kind for r in found.collect() if "N3" in r.file_path and r.kind == "bad_name"}
    assert {r.kind for r in found.collect() if r.file_path == "odd.xml"} >= {"bad_name"}
    messages = spark.read.option("header", True).csv(str(tmp_path / "out/issue_messages"))
    assert messages.groupBy("message").count().filter("count > 1").count() == 0


def test_no_shuffle_between_scan_and_report(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_ERIC_INI, "ericsson")
    entries = ericsson.report_entries(catalog, "LTE")
    merged = ericsson.cells(pm_files(spark, (ERIC_NAME % "N1", MDC)), entries, "LTE")
    plan = ericsson.report(merged, entries, settings, "LTE", "r")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_xml") == 2


def lines_of(folder):
    return sorted({x for p in folder.glob("part-*") for x in p.read_text().splitlines()})


def test_umts_ericsson_job_and_relations(spark, tmp_path):
    """Cells, relations, their sums and issues out of one parse, headers out of the definition file."""
    ini = UMTS_ERIC_INI.replace("[Table]", "CommonHeader=RUN,A,B,C,D,E,F,G,H,I,J,THE_CELL\nLTECellHeader=FREQ,NEXT\n[Table]\n")
    catalog, settings = catalog_of(spark, tmp_path, ini, "ericsson")
    relation = "ManagedElement=1,UtranCell=C1,EUtranFreqRelation=%d,EUtranCellRelation=9"
    text = MDC.replace("EUtranCellFDD", "UtranCell").replace("</mdc>", f"""<md><mi><mt>pmB</mt><mt>pmA</mt>
      <mv><moid>{relation % 6}</moid><r>7,8</r><r>10</r></mv></mi></md></mdc>""")
    ericsson.run(spark, pm_files(spark, (ERIC_NAME % "R1", text), ("odd.xml", text)), catalog, settings, "UMTS", str(tmp_path / "out"), "r")
    front = "r,2017-08-07 12:00,,1,,,Manhattan,2017-08-07 12:00,15,R1,OSS1,"
    head = "RUN,A,B,C,D,E,F,G,H,I,J,THE_CELL,"
    assert lines_of(tmp_path / "out/report") == sorted([head + "pmA", front + "C1,3", front + "C2,5"])
    assert lines_of(tmp_path / "out/ltecell") == sorted([
        head + "FREQ,NEXT,pmA,pmB_0,pmB_1", front + "C1,5,9,4,0,0", front + "C1,6,9,10,7,8"])
    assert lines_of(tmp_path / "out/ltecell_sum") == sorted([head + "pmA,pmB_0,pmB_1", front + "C1,14,7,8"])
    found = {(r.file_path, r.kind, r.item) for r in spark.read.option("header", True).csv(str(tmp_path / "out/issues")).collect()}
    # cells lack nothing that the site table asks for; relations are no cells
    assert found == {
        (ERIC_NAME % "R1", "no_name", "1"), ("odd.xml", "no_name", "1"), ("odd.xml", "bad_name", "odd.xml"),
        ("settings", "settings", "Region"), ("settings", "settings", "Market")}
    assert published(spark, str(tmp_path / "out")) == ["issue_messages", "issues", "ltecell", "ltecell_sum", "report"]
    with pytest.raises(ValueError, match="3 columns"):
        ericsson.report(None or ericsson.cells(pm_files(spark), [Counter("t", 0, "a", "a")], "UMTS"), [Counter("t", 0, "a", "a")],
                        Settings(header=("a", "b", "c")), "UMTS", "r")


def test_sections_of_a_definition_file(spark, tmp_path):
    text = """[General]\nRegion=East ; the first\nOther=a:b,c:d\nTechnology: UMTS\nElementsNotUsed=false\n[Other]\nt9=a:b\n
[Table]\n t1 = M1:A , M2:B\nT1=M1:A,M3:C\n# t2=M1:A\n[General]\nHL_MARKET=late\n"""
    catalog, settings = catalog_of(spark, tmp_path, text, "nokia")
    assert {t: [(e.code, e.column) for e in entries] for t, entries in catalog.items()} == {"t1": [("M1", "A"), ("M3", "C")]}
    assert settings == Settings("East", "", "late", "UMTS", list_not_used=False, absent=("Market",), technology_named=True)


@pytest.mark.parametrize(("text", "message"), [
    ("[Table]\nt1=foo\n", "entry 'foo' of table 't1' is no pair"), ("[Table]\nt1=\n", "table 't1' is no pair"),
    ("[Table]\nno list\n", "line 'no list' belongs to no table"), ("t1=a:b\n[Table]\nt2=a:b\n", "line 't1=a:b' belongs to no table")])
def test_lines_that_are_no_tables_are_refused(spark, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        catalog_of(spark, tmp_path, text, "nokia")


def test_values_by_place_equal_the_tall_way(spark):
    """Repeated names, short rows, values out of order, undeclared references and blank values, over many shapes of documents."""
    draw = random.Random(4)
    codes = ["a", "b", "c", "d", "e"]
    names = [*codes, "x", "y"]

    def mdc():
        blocks = ""
        for _ in range(draw.randint(0, 3)):
            mt = draw.choices(names, k=draw.randint(0, 7))
            mvs = "".join(
                f"<mv><moid>{CELL}C{draw.randint(1, 3)}</moid>" + "".join(
                    draw.choice(["<r/>", f"<r>{draw.randint(0, 99)}</r>"]) for _ in range(draw.randint(0, 8))) + "</mv>" for _ in range(draw.randint(0, 4)))
            blocks += "<md><mi>" + "".join(f"<mt>{n}</mt>" for n in mt) + mvs + "</mi></md>"
        return f"<mdc><mfh/>{blocks}</mdc>"

    def collec():
        infos = ""
        for _ in range(draw.randint(0, 3)):
            ps = draw.choice([list("12345"), list("1123"), list("31")])
            types = "".join(f'<measType p="{p}">{draw.choice(names)}</measType>' for p in ps)
            values = ""
            for _ in range(draw.randint(0, 4)):
                order = draw.choice([ps, ps, ps[::-1], [*ps, "9"], ps[:1]])
                values += f'<measValue measObjLdn="X=1,EUtranCellFDD=C{draw.randint(1, 3)}">' + "".join(
                    draw.choice([f'<r p="{p}"/>', f'<r p="{p}">{draw.randint(0, 99)}</r>']) for p in order) + "</measValue>"
            infos += f"<measInfo>{types}{values}</measInfo>"
        return f"<measCollecFile><measData>{infos}</measData></measCollecFile>"

    files = pm_files(spark, *[(f"f{i}", (mdc if i % 2 else collec)()) for i in range(120)])
    tall = explode_counters(shred_eric(files)).withColumn("cell_id", eric_cell_id_lte(F.col("moid"))).filter("cell_id is not null")
    keys = ["file_path", "cell_id"]
    expected = {(r.file_path, r.cell_id): r.counters for r in widen(merge_last(tall, keys), keys, codes).collect() if r.counters}
    merged = merge_documents(parse_eric(files, codes=codes), ericsson.lte_identity).collect()
    got = {(r.file_path, r.cell_id): {c: v for c, v in zip(codes, r["values"], strict=False) if v is not None} for r in merged}
    assert {k: v for k, v in got.items() if v} == expected and len(expected) > 100
    assert {len(r["values"]) for r in merged} == {0, 5}


def test_findings_equal_a_plain_look(spark):
    """Bits per file against sets, over more counters than one word of bits holds."""
    draw = random.Random(8)
    entries = [Counter("t", i, f"c{i}", f"c{i}") for i in range(150)]
    held = [(f"f{i % 7}", {e.code: "1" for e in entries if draw.random() > 0.02}) for i in range(40)]
    want = {(f, e.code) for f, counters in held for e in entries if e.code not in counters}
    maps = spark.createDataFrame(held, "file_path string, counters map<string,string>")
    places = spark.createDataFrame([(f, [c.get(e.code) for e in entries]) for f, c in held], "file_path string, values array<string>")
    for frame in (maps, places):
        rows = missing_counters_eric(frame, entries)
        assert {(r.file_path, r["item"]) for r in rows.collect()} == want and rows.count() == len(want)
        assert "bit_or" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("raw", "text"), [
    ("2,0,5,3,6", None), ("2,0,5,4,6", "more"), ("2,0,5,-1,6", "more"), ("1,0,5,3,6", "more"), ("3,0,5", "less"), ("2,0,5,x,6", "more"),
    ("0", None), ("0,1", "more"), ("", "less"), (None, None), ("x", "less")])
def test_sparse_lists_that_do_not_fit(spark, raw, text):
    rows = spark.createDataFrame([("f", "pmS", raw)], "file_path string, counter string, raw string")
    found = array_length_issues(rows, [Counter("t", 0, "pmS", "pmS", "COMP", 4)]).collect()
    assert [r.message for r in found] == ([f"IE:pmS has {text} elemments than configured"] if text else [])


LTE_NOKIA_INI = """[General]
DebugNothingUseInElement=true
Region=East
Market=M1
[Table]
lte_cell_avail=M8020C3:SAMPLES_CELL_AVAIL,M8020C4:SAMPLES_CELL_PLAN_UNAVAIL
lte_isys_ho_utran_nb=M8017C7:ATT_NB,M8017C9:FAIL_NB
LTE_Cell_Throughput=M8012C22:RATE
"""


def lte_object(meas, counters, cell=2, extra="", tag="PMTarget", second=True):
    plmn = "<MO><DN>PLMN-PLMN/MCC-310/MNC-260</DN></MO>" if second else ""
    return (f"<PMMOResult><MO><DN>PLMN-PLMN/MRBTS-1/LNBTS-7/LNCEL-{cell}</DN></MO>{plmn}{extra}"
            f'<{tag} measurementType="{meas}">{counters}</{tag}></PMMOResult>')


def setup(*objects):
    return ('<OMeS xmlns="urn:x"><PMSetup startTime="2017-06-14T15:00:00.000-04:00" interval="15">'
            + "".join(objects) + "</PMSetup></OMeS>")


def test_lte_nokia_job(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_NOKIA_INI, "nokia")
    neighbour = "<MO><DN>PLMN-PLMN/UTRAN-%d</DN></MO>"
    files = pm_files(
        spark,
        ("d/OSS9_a.xml", setup(
            lte_object("LTE_Cell_Avail", "<M8020C3>10</M8020C3><M8020C9>1</M8020C9>"),
            '<PMMOResult><MO><DN>PLMN-PLMN/MRBTS-1/LNBTS-7/LNCEL-3</DN></MO>'
            '<NE-LNBTS_x measurementType="lte_cell_avail"/></PMMOResult>',
            '<PMMOResult><MO><DN>PLMN-PLMN</DN></MO><PMTarget measurementType="lte_cell_avail">'
            "<M8020C3>1</M8020C3></PMTarget></PMMOResult>")),
        ("OSS9_b.xml", setup(
            lte_object("lte_isys_ho_utran_nb", "<M8017C7>1</M8017C7><M8017C9>2</M8017C9>", extra=neighbour % 1),
            lte_object("lte_isys_ho_utran_nb", "<M8017C7>10</M8017C7>", extra=neighbour % 2),
            lte_object("lte_isys_ho_utran_nb", "<M8017C7>5</M8017C7>", cell=4, extra=neighbour % 1))),
        ("OSS9_c.xml", setup(*[
            lte_object("LTE_Cell_Throughput", f"<M8012C22>{n}</M8012C22>", cell=n, extra=x, second=s)
            for n, x, s in ((1, "", False), (2, "", True), (3, neighbour % 1, True))])),
        ("OSS9_d.xml", setup(lte_object("other", "<B1>1</B1><A1>2</A1>"))),
        ("OSS9_e.xml", setup(lte_object("other", "<B1>1</B1>"))[:-30]),
    )
    nokia.run(spark, files, catalog, settings, "LTE", str(tmp_path / "out"), "r")

    def lines(folder):
        return sorted({x for p in (tmp_path / "out" / folder).glob("part-*") for x in p.read_text().splitlines()})

    front = "r|East|M1|OSS9|2017-06-14 15:00|15|"
    cell = "PLMN-PLMN/MRBTS-1/LNBTS-7/LNCEL-"
    head = "MGR_RUN_ID|Region|Market|OSS|PERIOD_START_TIME|PERIOD_DURATION|"
    assert lines("lte_cell_avail") == sorted([
        head + "MO_DN|MO_DN2|SAMPLES_CELL_AVAIL|SAMPLES_CELL_PLAN_UNAVAIL",
        front + cell + "2|310260-7-2|10|", front + cell + "3|-7-3||"])
    assert lines("lte_isys_ho_utran_nb") == sorted([
        head + "MO_DN2|MO_DN_Source|MO_DN_Target|ATT_NB|FAIL_NB",
        front + f"310260-7-2|{cell}2|PLMN-PLMN/UTRAN-1|1|2", front + f"310260-7-2|{cell}2|PLMN-PLMN/UTRAN-2|10|",
        front + f"310260-7-4|{cell}4|PLMN-PLMN/UTRAN-1|5|"])
    assert lines("lte_isys_ho_utran_nb_sum") == sorted([
        head + "MO_DN2|MO_DN_Source|ATT_NB|FAIL_NB",
        front + f"310260-7-2|{cell}2|11|2", front + f"310260-7-4|{cell}4|5|0"])
    assert [x.rsplit("|", 1)[1] for x in lines("lte_cell_throughput") if x.startswith("r|")] == ["", "2", ""]
    found = {(r.kind, r.item) for r in spark.read.option("header", True).csv(str(tmp_path / "out/issues")).collect()}
    assert found == {
        ("missing", "M8020C3,M8020C4"), ("missing", "M8017C9"), ("not_used", "M8020C9"), ("nothing_used", "A1,B1"),
        ("no_cell", "1"), ("bad_file", "OSS9_e.xml"),
        # two throughput objects have one or three managed objects, so their counters do not count
        ("missing", "M8012C22")}


def test_findings_of_all_objects(spark, tmp_path):
    """Object 12 and objects that are not the last count; the scan depths of old are parameters."""
    catalog, settings = catalog_of(spark, tmp_path, LTE_NOKIA_INI, "nokia")
    objects = [lte_object("other", f"<E{i}>1</E{i}>") for i in range(13)]
    objects += [lte_object("lte_cell_avail", "<M8020C4>1</M8020C4><X>1</X>"), lte_object("lte_cell_avail", "<M8020C3>1</M8020C3><M8020C4>1</M8020C4>")]
    files = pm_files(spark, ("in/OSS9_a.xml", setup(*objects)), ("OSS9_b.xml", setup()))

    def found(**limits):
        rows = nokia.objects(files, "LTE", True, catalog, settings, **limits)
        return {(r.file_path, r.meas_type, r.kind, r["item"]) for r in issues_of(rows).collect()}

    a = "in/OSS9_a.xml"
    every = ",".join(sorted(f"E{i}" for i in range(13)))
    assert found() == {(a, "other", "nothing_used", every), (a, "lte_cell_avail", "missing", "M8020C3"), (a, "lte_cell_avail", "not_used", "X")}
    few = ",".join(sorted(f"E{i}" for i in range(11)))
    assert found(last_only=True, first_objects=11) == {(a, "other", "nothing_used", few), (a, "lte_cell_avail", "not_used", "X")}


def test_switches_of_the_listings(spark, tmp_path):
    ini = LTE_NOKIA_INI.replace("DebugNothingUseInElement=true", "ElementsNotUsed=0")
    catalog, settings = catalog_of(spark, tmp_path, ini, "nokia")
    files = pm_files(spark, ("a", setup(lte_object("other", "<E>1</E>"), lte_object("lte_cell_avail", "<X>1</X>"))))
    kinds = {r.kind for r in issues_of(nokia.objects(files, "LTE", True, catalog, settings)).collect()}
    assert kinds == {"missing"}


def test_only_configured_values_are_shuffled(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_NOKIA_INI, "nokia")
    files = pm_files(
        spark, ("a", setup(*[lte_object("other", f"<E{i}>1</E{i}>") for i in range(50)])),
        ("b", setup(*[lte_object("lte_cell_avail", f"<M8020C3>{i}</M8020C3>" + "".join(f"<X{k}>1</X{k}>" for k in range(9))) for i in range(5)])))
    rows = nokia.objects(files, "LTE", True, catalog, settings)
    assert sorted((r.file_path, r.object_pos, str(r.counters)) for r in rows.collect()) == [
        ("a", 0, "{}"), *[("b", i, str({"M8020C3": str(i)})) for i in range(5)]]
    staged = nokia.stage_objects(spark, files, "LTE", catalog, settings)
    plan = nokia.issues(staged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "findings" in plan and "counters" not in plan


def test_header_of_a_nokia_definition_file(spark, tmp_path):
    ini = LTE_NOKIA_INI.replace("[Table]", "CommonHeader=RUN,REG,MKT,O,START,LEN,MO_DN,MO_DN2\n[Table]")
    catalog, settings = catalog_of(spark, tmp_path, ini, "nokia")
    nokia.run(spark, pm_files(spark, ("OSS9_a", setup(lte_object("lte_cell_avail", "<M8020C3>1</M8020C3>")))), catalog, settings, "LTE", str(tmp_path / "out"), "r")
    assert lines_of(tmp_path / "out/lte_cell_avail")[0] == "RUN|REG|MKT|O|START|LEN|MO_DN|MO_DN2|SAMPLES_CELL_AVAIL|SAMPLES_CELL_PLAN_UNAVAIL"
    with pytest.raises(ValueError, match="2 columns"):
        nokia._labelled(spark.range(1), Settings(header=("a", "b")))


UMTS_NOKIA_INI = """[General]
Region=East
Market=M1
[Table]
rcpm_olpc_wcel=baseId:BASEID,localMoid:LOCALMOID,cell_id_1:CELL_ID_1,cell_id_2:CELL_ID_2,TR_CLASS:TR_CLASS,TR_SUBCLASS:TR_SUBCLASS,CHTYPE:CHTYPE,m1024c4:oks,m1024c5:noks
rcpm_rlc_wcelsum=baseId:BASEID,localMoid:LOCALMOID,cell_id_1:CELL_ID_1,cell_id_2:CELL_ID_2,A:A,B:B,C:C,D:D,E:E,F:F,G:G,H:H
"""
UMTS = """<OMeS><PMSetup startTime="2017-06-14T15:00:00" interval="60"><PMMOResult>
  <MO><baseId>NE-RNC-5</baseId><localMoid>DN:NE-WBTS-12/WCEL-1</localMoid></MO>
  <MO><DN>PLMN-PLMN/TR_CLASS-background/TR_SUBCLASS-PS_NRT_data</DN></MO>
  <MO><DN>PLMN-PLMN/ChType-HSUPA</DN></MO>
  <NE-WBTS_Nokia measurementType="rcpm_olpc_wcel"><M1024C4>3</M1024C4><M1024C5>1</M1024C5><M1024C15>0.5</M1024C15><M1024C17>2</M1024C17></NE-WBTS_Nokia>
</PMMOResult></PMSetup></OMeS>"""


def test_umts_nokia_job(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, UMTS_NOKIA_INI, "nokia")
    nokia.run(spark, pm_files(spark, ("R_1.xml", UMTS)), catalog, settings, "UMTS", str(tmp_path / "out"), "r")

    def row(folder):
        found = [x for p in (tmp_path / "out" / folder).glob("part-*") for x in p.read_text().splitlines()]
        return [x for x in found if x.startswith("r|")]

    front = "r|East|M1|R|2017-06-14 15:00|60|NE-RNC-5|NE-WBTS-12/WCEL-1|PLMN-PLMN/RNC-5/WBTS-12/WCEL-1|5-12-1|"
    assert row("rcpm_olpc_wcel") == [front + "background|PS_NRT_data|HSUPA|3|1"]
    assert row("rcpm_olpc_wcel_sum") == [front + "0|0|1|3|1|3|0.0|0|0.5|2|0.5|2"]
    assert nokia.sum_labels(catalog, "rcpm_rlc_wcel") == list("ABCDEFGH")


def test_lower_codes_last_spelling_wins(spark):
    clash = F.create_map(*[F.lit(x) for x in ("M1", "a", "m1", "b", "Other", "c")])
    plain = F.create_map(F.lit("M2"), F.lit("x"))
    row = spark.range(1).select(lower_counter_codes(clash), lower_counter_codes(plain)).first()
    assert tuple(row) == ({"m1": "b", "Other": "c"}, {"m2": "x"})


def test_file_sources(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / (ERIC_NAME % "N1")).write_text(MDC)
    with gzip.open(folder / ("OSS_+0000_" + ERIC_NAME % "N2" + ".gz").replace("-0400", "+0000"), "wt") as f:
        f.write(COLLEC)
    (folder / "readme.txt").write_text("no")
    rows = {r.file_name: r for r in read_pm_files(spark, str(folder)).collect()}
    assert set(rows) == {p.name for p in folder.iterdir()} - {"readme.txt"}
    assert rows[ERIC_NAME % "N1"].content == MDC
    pairs = spark.sparkContext.parallelize([("in/" + ERIC_NAME % "N1", bytearray(MDC, "utf-8"))])
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    row = read_pm_sequence(spark, str(tmp_path / "seq")).first()
    assert (row.file_path, row.file_name, row.content) == ("in/" + ERIC_NAME % "N1", ERIC_NAME % "N1", MDC)


def test_folders_below_are_read(spark, tmp_path):
    (tmp_path / "in" / "deep" / "er").mkdir(parents=True)
    (tmp_path / "in" / (ERIC_NAME % "N1")).write_text(MDC)
    (tmp_path / "in" / "deep" / "er" / (ERIC_NAME % "N2")).write_text(MDC)
    seen = []
    assert read_pm_files(spark, str(tmp_path / "in")).count() == 2
    stream = stream_pm_files(spark, str(tmp_path / "in"))
    land_batches(stream, str(tmp_path / "ckpt"), lambda files, batch: seen.append(files.count())).awaitTermination()
    assert sum(seen) == 2


@pytest.mark.parametrize("line", ["t1=foo,M1:A", "t1=M1:A,M2,M3:C", "t1=M1:A,M2:"])
def test_entries_that_are_no_pair_are_refused(spark, tmp_path, line):
    with pytest.raises(ValueError, match="table 't1' is no pair"):
        catalog_of(spark, tmp_path, "[Table]\n" + line + "\n", "nokia")


def test_long_special_lists_are_reported(spark):
    rows = spark.createDataFrame([("f", "pmS", ",".join("1" * n)) for n in (10, 12)], "file_path string, counter string, raw string")
    found = array_length_issues(rows, [Counter("t", 0, "pmS", "pmS", "SPECIAL", 10)]).collect()
    assert [r.message for r in found] == ["IE:pmS has more elemments than configured"]


def test_odd_nokia_documents(spark):
    """Two targets in one object (the last counts), no start time, no objects, several setups."""
    two = lte_object("lte_cell_avail", "<M8020C3>1</M8020C3>").replace(
        "</PMMOResult>", '<PMTarget measurementType="lte_rrc"><M8008C1>2</M8008C1></PMTarget></PMMOResult>')
    late = setup(lte_object("lte_rrc", "<M8008C1>3</M8008C1>")).replace("<PMSetup startTime", "<PMSetup other")
    both = setup(lte_object("a", "<M8008C1>4</M8008C1>"))[:-7] + setup(
        lte_object("b", "<M8008C1>5</M8008C1>")).split(">", 1)[1].replace("15:00", "16:00")
    files = pm_files(spark, ("two", setup(two)), ("late", late), ("none", setup()), ("both", both))
    rows = nokia.objects(files, "LTE").orderBy("file_path", "object_pos").collect()
    assert [(r.file_path, r.object_pos, r.object_count, r.meas_type, r.counters) for r in rows] == [
        ("both", 0, 2, "a", {"M8008C1": "4"}), ("both", 1, 2, "b", {"M8008C1": "5"}),
        ("late", 0, 1, "lte_rrc", {"M8008C1": "3"}), ("two", 0, 1, "lte_rrc", {"M8008C1": "2"})]
    assert [r.period_start and r.period_start.hour for r in rows] == [15, 16, None, 15]
    kept = nokia.objects(files, "LTE", keep_empty=True).filter("object_pos is null").collect()
    assert [(r.file_path, r.corrupt) for r in kept] == [("none", False)]


def test_text_of_bytes():
    text = '<?xml version="1.0" encoding="ISO-8859-1"?><mdc>\u00e9</mdc>'
    plain = text.encode("latin-1")
    assert text_of(text) == text_of(plain) == text_of(gzip.compress(plain)) == text_of(zlib.compress(plain)) == text
    assert text_of(b"<mdc>\xff</mdc>") == "<mdc>\ufffd</mdc>"
    assert text_of(gzip.compress(plain)[:20]).startswith("\x1f")


def test_bytes_of_a_sequence_file_are_decoded_like_texts(spark, tmp_path):
    bodies = {
        "utf": "<mdc>\u00e9\u4e2d</mdc>".encode(), "bad": b"<mdc>\xff\xc3(</mdc>", "zipped": gzip.compress(b"<a/>") + gzip.compress(b"<b/>"),
        "latin": '<?xml version="1.0" encoding="iso-8859-1"?><mdc>\u00e9</mdc>'.encode("latin-1"),
        "windows": '<?xml version="1.0" encoding="windows-1252"?><mdc>\u20ac</mdc>'.encode("cp1252"),
        "unknown": b'<?xml version="1.0" encoding="x-none"?><mdc/>', "empty": b"", "cut": gzip.compress(b"<mdc/>" * 99)[:30]}
    pairs = spark.sparkContext.parallelize([(k, bytearray(v)) for k, v in bodies.items()])
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    got = {r.file_path: r.content for r in read_pm_sequence(spark, str(tmp_path / "seq")).collect()}
    assert {k: v for k, v in got.items() if k != "cut"} == {k: text_of(v) for k, v in bodies.items() if k != "cut"} and got["cut"].startswith("\x1f")


def test_command_line(spark, tmp_path):
    (tmp_path / "counters.ini").write_text(LTE_ERIC_INI)
    pairs = spark.sparkContext.parallelize([(ERIC_NAME % "N1", bytearray(gzip.compress(MDC.encode())))])
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / (ERIC_NAME % "N1")).write_text(MDC)
    common = ["ericsson", "LTE", "--catalog", str(tmp_path / "counters.ini"), "--run-id", "r"]
    main([*common, "--input", str(tmp_path / "seq"), "--out", str(tmp_path / "a")])
    main([*common, "--input", str(landing), "--out", str(tmp_path / "b"), "--format", "files"])
    main([*common, "--input", str(landing), "--out", str(tmp_path / "c"), "--format", "stream",
          "--checkpoint", str(tmp_path / "offsets")])
    reports = [
        sorted(map(tuple, spark.read.option("header", True).csv(f"{tmp_path}/{p}/report").collect()))
        for p in ("a", "b", "c/batch=0")
    ]
    assert reports[0] == reports[1] == reports[2] and len(reports[0]) == 2


def test_documents_are_parsed_once(spark):
    files = pm_files(spark, ("f", MDC))
    for frame in (shred_mdc(files), explode_counters(shred_mdc(files)), nokia.objects(files, "LTE"), nokia.objects(files, "UMTS")):
        assert frame._jdf.queryExecution().executedPlan().toString().count("from_xml") == 1


def test_empty_input(spark, tmp_path):
    catalog, settings = catalog_of(spark, tmp_path, LTE_ERIC_INI, "ericsson")
    files = pm_files(spark, ("x", "")).limit(0)
    ericsson.run(spark, files, catalog, settings, "LTE", str(tmp_path / "out"), "r")
    assert (tmp_path / "out/report/_SUCCESS").exists()
