"""Pick up newly landed files exactly once and run a job over each batch of them."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pmweave.sources.files import XML_GLOB, as_pm_file

ATTEMPTS = 2
Job = Callable[[DataFrame, str], None]


def stream_pm_files(
    spark: SparkSession, path: str, glob: str = XML_GLOB,
    archive: str | None = None, max_files: int | None = None,
) -> DataFrame:
    """A streaming ``pm_file`` frame over a landing directory, oldest files first, folders below it included.

    ``glob`` tells vendor and technology apart by file name. With ``archive`` processed files
    are moved there; Spark does so when a later batch runs, so the last batch stays in
    place; the archive must lie outside the landing directory. ``max_files`` keeps a backlog from becoming one batch.
    """
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", glob)
        .option("latestFirst", False)
        .option("recursiveFileLookup", True)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return as_pm_file(reader.load(path))


def land_batches(
    stream: DataFrame, checkpoint: str, job: Job, quarantine: str | None = None, attempts: int = ATTEMPTS
) -> StreamingQuery:
    """Run ``job(files, batch)`` over everything that has landed, then stop.

    The checkpoint records which files a batch holds. After a failure the same batch runs again
    under the same name, so a job that overwrites the folder named by ``batch`` is
    exactly-once.

    With ``quarantine`` a file that makes the job raise does not stop the others: see ``run_apart``.
    """

    spark = stream.sparkSession

    def run(files: DataFrame, n: int) -> None:
        try:
            job(files, f"batch={n}")
        except Exception as failed:
            if quarantine is None:
                raise
            run_apart(spark, files_of_batch(spark, checkpoint, n), f"batch={n}", job, f"{quarantine}/batch={n}", attempts, failed)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def files_of_batch(spark: SparkSession, checkpoint: str, n: int) -> list[str]:
    """The files of a batch by the stream's own records, without opening any."""

    def reached(batch: int) -> int:
        if batch < 0:
            return -1
        lines = spark.read.text(f"{checkpoint}/offsets/{batch}")
        return lines.select(F.get_json_object("value", "$.logOffset").cast("long").alias("n")).where("n is not null").first().n

    first, last = reached(n - 1), reached(n)
    entry = F.from_json("value", "path STRING, batchId LONG").alias("e")
    seen = spark.read.text(f"{checkpoint}/sources/0").select(entry).where((F.col("e.batchId") > first) & (F.col("e.batchId") <= last))
    return sorted(unquote(r.path) for r in seen.select("e.path").distinct().collect())


def run_apart(spark: SparkSession, paths: list[str], batch: str, job: Job, quarantine: str, attempts: int, failed: Exception) -> None:
    """A batch whose job failed, run in halves until the files that make it fail are alone.

    A half that succeeds is done, under the batch's name and where it lies in it (``batch=3-01``), the same at every run. A file
    that fails alone ``attempts`` times goes to ``quarantine``, a table of ``file_path`` and ``error``. Where several files
    fail and none succeeds, the files are hardly the reason: nothing is put aside and the first error is raised. The driver
    handles the batch's file names, which the stream's source holds there anyway; the contents stay on executors.
    """
    succeeded, poisoned = [], []

    def attempt(paths: list[str], place: str) -> None:
        errors = []
        for _ in range(attempts if len(paths) == 1 else 1):
            try:
                job(read_paths(spark, paths), f"{batch}-{place}")
                succeeded.append(place)
                return
            except Exception as error:
                errors.append(error)
        if len(paths) == 1:
            poisoned.append((paths[0], str(errors[-1]).split("\n", 1)[0]))
        else:
            halve(paths, place)

    def halve(paths: list[str], place: str) -> None:
        middle = (len(paths) + 1) // 2
        attempt(paths[:middle], place + "0")
        attempt(paths[middle:], place + "1")

    if len(paths) > 1:
        halve(paths, "")
    else:
        attempt(paths, "0")
    if len(paths) > 1 and not succeeded:
        raise failed
    if poisoned:
        spark.createDataFrame(poisoned, "file_path STRING, error STRING").coalesce(1).write.mode("overwrite").parquet(quarantine)


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``pm_file`` of these files, whatever characters their names have."""
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    return as_pm_file(spark.read.option("wholetext", True).format("text").load(literal))


def read_quarantine(spark: SparkSession, quarantine: str) -> DataFrame:
    """Everything that ``land_batches`` put aside: ``file_path, error, batch``. ``read_paths`` reads the files again."""
    return spark.read.parquet(quarantine)
