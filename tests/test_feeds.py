"""How documents land: what a reader, a task and the driver hold does not grow with the tables."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pmweave.sources import read_pm_files
from verification import feeds, queries_documents


def customers(spark, folder, documents):
    rows = spark.range(documents * feeds.WIDE_CELLS).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 977 / 4).alias("c_acctbal"))
    rows.write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_wide_documents_land_a_few_to_a_row_group(spark, tmp_path):
    landed = feeds.wide_documents(spark, customers(spark, tmp_path, 12))
    files = {f.removeprefix("file://") for f in landed.inputFiles()}
    groups = [m.row_group(i).num_rows for m in map(pq.read_metadata, files) for i in range(m.num_row_groups)]
    assert sum(groups) == 12 and max(groups) <= 2


def test_wide_documents_spread_over_files_by_their_number(spark):
    class Cluster:
        class sparkContext:
            master, defaultParallelism = "spark://somewhere:7077", 12

    assert feeds._wide_files(Cluster, spark.range(900_000)) == 225
    assert feeds._wide_files(Cluster, spark.range(1_500)) == 12


def test_counters_beyond_the_catalog_are_told_of_every_type(spark, tmp_path):
    kinds = F.array(*[F.lit(t) for t in queries_documents.TYPES])
    spark.range(128).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"), F.get(kinds, (F.col("id") % 5).cast("int")).alias("event_type"),
        (F.col("id") / 4).alias("value")).write.parquet(f"{tmp_path}/events.parquet")
    found = queries_documents.elements_not_used(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in found} == {
        (doc, *of) for doc in (0, 1) for of in (("lte_cell_avail", "M8020C77"), ("lte_isys_ho_utran_nb", "M8017C9"))}


def test_written_documents_share_folders_and_keep_their_numbers(spark):
    number = F.when(F.col("id") < 1500, F.col("id") - 1)
    documents = spark.range(1501).select(number.alias("doc"), F.concat(F.lit("<mdc>"), F.col("id").cast("string")).alias("content"))
    folder = feeds.written_documents(spark, documents)
    files = read_pm_files(spark, folder, "*.txt.gz", partitioned=True)
    rows = {r.content: r.doc for r in files.select(F.trim(F.translate("content", "\n", "")).alias("content"), feeds.doc_of_path()).collect()}
    assert rows == {f"<mdc>{i}": str(i - 1) if i < 1500 else None for i in range(1501)}
    assert files.select("block").distinct().count() == 3
