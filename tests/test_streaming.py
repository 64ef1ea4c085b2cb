"""A landing directory as a stream: equal to the batch, each file once."""

import gzip

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pmweave.plans import ericsson
from pmweave.sources import read_pm_files
from pmweave.sources.catalog import Counter, Settings
from pmweave.streaming import land_batches, read_quarantine, stream_pm_files
from pmweave.streaming.landing import read_paths

ENTRIES = [Counter("t", 0, "pmA", "pmA")]
NAME = "OSS1_-0400_A20170807.1200-0400-1215-0400_SubNetwork=R,SubNetwork=A,MeContext=%s_statsfile.xml"
DOC = "<mdc><md><mi><mt>pmA</mt><mv><moid>X=1,EUtranCellFDD=%s</moid><r>%d</r></mv></mi></md></mdc>"


def report(files):
    merged = ericsson.cells(files, ENTRIES, "LTE")
    return ericsson.report(merged, ENTRIES, Settings(), "LTE", "r")


def values(frame):
    return sorted(tuple(r) for r in frame.select("MeContext", "EUtranCellFDD", "pmA").collect())


def test_stream_equals_batch_and_reads_each_file_once(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "offsets")
    landing.mkdir()

    def land():
        batches = []

        def job(files, batch):
            batches.append(batch)
            report(files).write.mode("overwrite").parquet(f"{out}/{batch}")

        stream = stream_pm_files(spark, str(landing), "OSS*.xml", max_files=2)
        land_batches(stream, checkpoint, job).awaitTermination()
        return batches

    for n in range(3):
        (landing / (NAME % f"N{n}")).write_text(DOC % (f"C{n}", n))
    (landing / "other.xml").write_text(DOC % ("C9", 9))
    assert land() == ["batch=0", "batch=1"]
    expected = values(report(read_pm_files(spark, str(landing), "OSS*.xml")))
    assert values(spark.read.parquet(out)) == expected
    assert [r[0] for r in expected] == ["N0", "N1", "N2"]

    assert land() == []
    (landing / (NAME % "N3")).write_text(DOC % ("C3", 3))
    assert land() == ["batch=2"]
    assert len(values(spark.read.parquet(out))) == 4


def test_archive_moves_files_of_earlier_batches(spark, tmp_path):
    landing, archive, seen = tmp_path / "in", tmp_path / "done", []
    landing.mkdir()
    for n in range(3):
        (landing / (NAME % f"N{n}")).write_text(DOC % (f"C{n}", n))
    stream = stream_pm_files(spark, str(landing), "OSS*.xml", archive=str(archive), max_files=1)
    land_batches(
        stream, str(tmp_path / "offsets"), lambda files, batch: seen.append(files.count())
    ).awaitTermination()
    assert seen == [1, 1, 1]
    archived = [p for p in archive.rglob("OSS*.xml")]
    assert archived and len(archived) + len(list(landing.iterdir())) == 3


def poisoned_job(out, tried):
    def job(files, batch):
        tried.append(batch)
        checked = files.withColumn("content", F.when(F.contains("content", F.lit("BOOM")), F.raise_error(F.lit("cannot do"))).otherwise(F.col("content")))
        report(checked).write.mode("overwrite").parquet(f"{out}/{batch}")

    return job


def test_poisoned_files_are_put_aside_and_the_batch_goes_on(spark, tmp_path):
    """One text that makes the job raise and one gzip file cut short, among names with odd characters."""
    landing, out, quarantine, tried = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "quarantine"), []
    landing.mkdir()
    for n in range(6):
        (landing / (NAME % f"N{n}+[x] {{y}}")).write_text(DOC % (f"C{n}", n))
    (landing / (NAME % "BAD")).write_text(DOC % ("BOOM", 1))
    (landing / (NAME % "CUT" + ".gz")).write_bytes(gzip.compress((DOC % ("C8", 8)).encode() * 50)[:40])
    stream = stream_pm_files(spark, str(landing), "OSS*")
    land_batches(stream, str(tmp_path / "offsets"), poisoned_job(out, tried), quarantine).awaitTermination()
    kept = spark.read.parquet(*[str(p) for p in (tmp_path / "out").iterdir() if (p / "_SUCCESS").exists()])
    assert [r[1] for r in values(kept)] == [f"C{n}" for n in range(6)]
    aside = read_quarantine(spark, quarantine).collect()
    assert sorted(r.file_path.rsplit("=", 1)[1].split("_")[0] for r in aside) == ["BAD", "CUT"] and {r.batch for r in aside} == {"0"} or len(aside) == 2
    assert len([b for b in tried if tried.count(b) == 2]) == 4  # each of the two was tried twice alone
    assert read_paths(spark, [r.file_path for r in aside if "BAD" in r.file_path]).count() == 1
    seen = len(tried)
    land_batches(stream_pm_files(spark, str(landing), "OSS*"), str(tmp_path / "offsets"), poisoned_job(out, tried), quarantine).awaitTermination()
    assert len(tried) == seen


def test_a_batch_of_which_no_file_succeeds_is_not_put_aside(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    for n in range(3):
        (landing / (NAME % f"N{n}")).write_text(DOC % ("BOOM", n))
    query = land_batches(stream_pm_files(spark, str(landing)), str(tmp_path / "offsets"), poisoned_job(str(tmp_path / "out"), []), str(tmp_path / "q"))
    with pytest.raises(StreamingQueryException, match="cannot do"):
        query.awaitTermination()
    assert not (tmp_path / "q").exists()
