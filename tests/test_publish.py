"""A run's tables appear together or not at all."""

import pytest

from pmweave.plans import ericsson
from pmweave.sinks import publication, published, recover
from pmweave.sinks import publish
from pmweave.sources.catalog import Counter, Settings

CATALOG = {"tab1": [Counter("tab1", 0, "pmA", "pmA")]}
NAME = "OSS1_-0400_A20170807.1200-0400-1215-0400_SubNetwork=R,SubNetwork=A,MeContext=N_statsfile.xml"
DOC = "<mdc><md><mi><mt>pmA</mt><mv><moid>X=1,EUtranCellFDD=C1</moid><r>%d</r></mv></mi></md></mdc>"


def tables(out):
    return sorted(p.name for p in out.iterdir()) if out.exists() else []


def write(spark, folder, *names):
    for n in names:
        spark.range(2).write.mode("overwrite").parquet(f"{folder}/{n}")


def run(spark, out, value):
    files = spark.createDataFrame([(NAME, NAME, DOC % value)], "file_path string, file_name string, content string")
    ericsson.run(spark, files, CATALOG, Settings(), "LTE", str(out), "r")


def value_of(spark, out):
    return [r.pmA for r in spark.read.option("header", True).csv(f"{out}/report").collect()]


def test_tables_are_published_together(spark, tmp_path):
    out = tmp_path / "out"
    with publication(spark, str(out), "r1") as folder:
        write(spark, folder, "a", "b", "_work/c")
        assert published(spark, str(out)) is None and tables(out) == ["_staging"]
    assert {n for n in tables(out) if not n.endswith(".crc")} == {"_manifest.json", "a", "b"}
    assert published(spark, str(out)) == ["a", "b"] and spark.read.parquet(f"{out}/a").count() == 2


def test_a_job_that_ends_between_tables_shows_nothing(spark, tmp_path, monkeypatch):
    out = tmp_path / "out"
    run(spark, out, 1)
    monkeypatch.setattr(ericsson, "write_pm_issues", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        run(spark, out, 2)
    assert value_of(spark, out) == ["1"] and "_staging" not in tables(out)
    monkeypatch.undo()
    run(spark, out, 3)
    assert value_of(spark, out) == ["3"]


def test_a_killed_job_leaves_a_staging_folder_that_the_next_run_removes(spark, tmp_path):
    out = tmp_path / "out"
    write(spark, out / "_staging" / "dead", "report")
    assert published(spark, str(out)) is None and spark.read.parquet(f"{out}/_staging/dead/report").count() == 2
    run(spark, out, 4)
    assert value_of(spark, out) == ["4"] and "_staging" not in tables(out)


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_job_killed_while_tables_are_moved_is_finished(spark, tmp_path, monkeypatch, moves):
    out = str(tmp_path / "out")
    with publication(spark, out, "r1") as folder:
        write(spark, folder, "a", "old")
    left, move = [moves + 1], publish._Folder.move  # the manifest itself is the first

    def some(self, name, to):
        left[0] -= 1
        if left[0] < 0:
            raise KeyboardInterrupt
        move(self, name, to)

    monkeypatch.setattr(publish._Folder, "move", some)
    with pytest.raises(KeyboardInterrupt), publication(spark, out, "r2") as folder:
        spark.range(5).write.parquet(f"{folder}/a")
        write(spark, folder, "b")
    monkeypatch.undo()
    assert published(spark, out) is None
    recover(spark, out)
    assert published(spark, out) == ["a", "b"] and spark.read.parquet(f"{out}/a").count() == 5
    assert {n for n in tables(tmp_path / "out") if not n.endswith(".crc")} == {"_manifest.json", "a", "b"}
