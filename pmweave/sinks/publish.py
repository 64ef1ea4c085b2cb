"""All tables of a run become visible together.

A run writes below ``<out>/_staging/<id>``, which readers of ``<out>`` never see. When every table is there, a manifest
is put next to them: from then on the run is going to be published, whatever happens. Its tables are moved to
``<out>``, tables of the run before that it no longer has are removed, and the manifest is moved last. A job that
ends before the manifest leaves nothing but a staging folder, which the next run removes; one that ends while tables are moved
is finished by the next run, or by ``recover``. One run at a time may publish to a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STAGING, MANIFEST = "_staging", "_manifest.json"


class _Folder:
    """The few file operations needed, on whatever file system ``out`` lies."""

    def __init__(self, spark: SparkSession, out: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.files = self.path(out).getFileSystem(conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.files.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.files.listStatus(self.path(folder))) if self.exists(folder) else []

    def delete(self, name: str) -> None:
        self.files.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        if not self.files.rename(self.path(name), self.path(to)):
            raise OSError(f"cannot move {name} to {to}")

    def read(self, name: str) -> dict | None:
        if not self.exists(name):
            return None
        stream = self.files.open(self.path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, data: dict) -> None:
        """Whole or not at all."""
        stream = self.files.create(self.path(name + ".tmp"), True)
        stream.write(bytearray(json.dumps(data, sort_keys=True).encode()))
        stream.close()
        self.move(name + ".tmp", name)


@contextmanager
def publication(spark: SparkSession, out: str, run_id: str) -> Iterator[str]:
    """The folder to write a run's tables to; they are published when the block ends, and dropped when it raises.

    Folders in it whose names begin with ``_`` are the run's own and vanish with it.
    """
    recover(spark, out)
    folder, staged = _Folder(spark, out), f"{out}/{STAGING}/{uuid.uuid4().hex}"
    try:
        yield staged
    except BaseException:
        _drop(folder, out, staged)
        raise
    tables = [n for n in folder.names(staged) if not n.startswith("_")]
    before = folder.read(f"{out}/{MANIFEST}") or {}
    folder.write(f"{staged}/{MANIFEST}", {"run_id": run_id, "tables": tables, "replaces": before.get("tables", [])})
    _finish(folder, out, staged)


def recover(spark: SparkSession, out: str) -> None:
    """Finish the publication that an ended job had begun, drop what was not complete."""
    folder = _Folder(spark, out)
    for name in folder.names(f"{out}/{STAGING}"):
        staged = f"{out}/{STAGING}/{name}"
        if folder.exists(f"{staged}/{MANIFEST}"):
            _finish(folder, out, staged)
        else:
            _drop(folder, out, staged)


def _finish(folder: _Folder, out: str, staged: str) -> None:
    """Every step may have been done already."""
    run = folder.read(f"{staged}/{MANIFEST}")
    folder.delete(f"{out}/{MANIFEST}")  # until the last table is there, no run is complete
    for name in run["tables"]:
        if folder.exists(f"{staged}/{name}"):
            folder.delete(f"{out}/{name}")
            folder.move(f"{staged}/{name}", f"{out}/{name}")
    for name in set(run["replaces"]) - set(run["tables"]):
        folder.delete(f"{out}/{name}")
    folder.move(f"{staged}/{MANIFEST}", f"{out}/{MANIFEST}")
    _drop(folder, out, staged)


def _drop(folder: _Folder, out: str, staged: str) -> None:
    folder.delete(staged)
    if not folder.names(f"{out}/{STAGING}"):
        folder.delete(f"{out}/{STAGING}")


def published(spark: SparkSession, out: str) -> list[str] | None:
    """The tables of the run that is complete in ``out``; null where none is, or one is being moved in."""
    run = _Folder(spark, out).read(f"{out}/{MANIFEST}")
    return run and run["tables"]
