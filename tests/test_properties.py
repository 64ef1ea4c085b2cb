"""Laws that hold for any input, checked on generated values in one job each."""

import random

from pyspark.sql import functions as F

from pmweave.functions import arrays
from pmweave.operators.merge import merge_last
from pmweave.operators.shred import parse_eric
from pmweave.operators.merge import merge_documents
from pmweave.plans import ericsson

RANDOM = random.Random(7)


def dense(raw, n):
    """The sparse rule, said once more in plain Python."""
    values, out = raw.split(","), ["0"] * n
    if values[0].isdigit():
        for k in range(min(int(values[0]), (len(values) - 1) // 2)):
            at = int(values[2 * k + 1])
            if at < n:
                out[at] = values[2 * k + 2]
    return out


def test_sparse_lists(spark):
    raws = []
    for _ in range(300):
        pairs = [(RANDOM.randrange(14), RANDOM.randrange(100)) for _ in range(RANDOM.randrange(8))]
        announced = len(pairs) + RANDOM.choice([0, 0, 0, 1, -1])
        raws.append(",".join([str(announced), *[f"{i},{v}" for i, v in pairs]]))
    frame = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r.raw: r.v for r in frame.select("raw", arrays.expand_comp(F.col("raw"), 10).alias("v")).collect()}
    for raw in raws:
        want = dense(raw, 10) if not raw.startswith("-") else ["0"] * 10
        assert got[raw] == want, raw


def test_fixed_lists_have_the_configured_length(spark):
    raws = [(",".join(str(RANDOM.randrange(9)) for _ in range(RANDOM.randrange(1, 9))),) for _ in range(100)]
    sizes = spark.createDataFrame(raws, "raw string").select(F.size(arrays.expand_pdf(F.col("raw"), 5))).distinct()
    assert [r[0] for r in sizes.collect()] == [5]


def test_merge_is_idempotent(spark):
    rows = [(RANDOM.randrange(3), RANDOM.randrange(3), str(n), (n,)) for n in range(200)]
    tall = spark.createDataFrame(rows, "cell_id int, counter int, raw string, pos struct<n:int>")
    once = merge_last(tall, ["cell_id"])
    again = merge_last(once.withColumn("pos", F.struct(F.lit(0).alias("n"))), ["cell_id"])
    expected = {(c, k): raw for c, k, raw, _ in rows}
    for frame in (once, again):
        assert {(r.cell_id, r.counter): r.raw for r in frame.collect()} == expected


def test_document_merge_against_brute_force(spark):
    """Random documents with repeated cells, repeated names, short rows and blanks."""
    codes = ["a", "b", "c", "d"]
    documents, expected = [], {}
    for doc in range(40):
        text, cells = [], {}
        for _ in range(RANDOM.randrange(1, 5)):
            names = [RANDOM.choice("abcdxyz") for _ in range(RANDOM.randrange(1, 6))]
            text.append("<md><mi>" + "".join(f"<mt>{n}</mt>" for n in names))
            for _ in range(RANDOM.randrange(0, 4)):
                cell = RANDOM.choice(["C1", "C2", "C3", ""])
                raws = [RANDOM.choice(["1", "22", "", "3,4"]) for _ in range(RANDOM.randrange(0, 7))]
                moid = f"M=1,EUtranCellFDD={cell}" if cell else "M=1"
                text.append(f"<mv><moid>{moid}</moid>" + "".join(f"<r>{r}</r>" for r in raws) + "</mv>")
                if cell:
                    held = cells.setdefault(cell, {})
                    held.update({n: r or "0" for n, r in zip(names, raws) if n in codes})
            text.append("</mi></md>")
        documents.append((str(doc), "<mdc>" + "".join(text) + "</mdc>"))
        expected.update({(str(doc), c): held for c, held in cells.items()})
    files = spark.createDataFrame(documents, "file_path string, content string")
    merged = merge_documents(parse_eric(files, codes=codes), ericsson.lte_identity)
    got = {(r.file_path, r.cell_id): {c: v for c, v in zip(codes, r["values"], strict=False) if v is not None} for r in merged.collect()}
    assert got == expected
