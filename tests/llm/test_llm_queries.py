"""The registered queries against their SQL or a plain version, and the pipeline stage by stage."""

from collections import defaultdict

import pytest

import corpus_pipeline
from pmweave.llm import queries
from pmweave.llm.fingerprints import simhash
from verification.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) == ""


def test_simhash_query_equals_all_pairs(spark):
    docs = {r.doc_id: simhash(r.text) for r in queries.table(spark, SF, "documents").collect()}
    root = {i: i for i in docs}
    links = [(a, b) for a in docs for b in docs if a < b and (docs[a] ^ docs[b]).bit_count() <= 4]
    for _ in docs:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == {i: (f"{f:016x}", root[i]) for i, f in docs.items()}


def test_stages_keep_the_columns_and_their_promises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(spark, docs, SF).cache()
        counts.append(docs.count())
        if name != "encode tokens":
            assert docs.columns == columns
            assert docs.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).count() == 0 or name == "mix sources"
    assert counts[0] > counts[1] and counts[3] <= counts[2] <= counts[1] and counts[5] == counts[4] > 0
    assert all(r.round_trip for r in docs.collect())
    copies = defaultdict(int)
    for r in docs.collect():
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 3
    assert corpus_pipeline.run(spark, SF).count() == counts[5]
