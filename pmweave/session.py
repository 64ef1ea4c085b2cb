"""Session defaults, the shared scratch folder and tables staged in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    # PERIOD_START_TIME and friends are wall-clock values; nothing may shift them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A split is decoded one document at a time, but gzip input inflates ten- to
    # twentyfold, so splits are kept below the 128 MB default.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    # Documents are small files. The 4 MB default would put 16 of them into a split however
    # small they are, and a large landing zone into millions of tasks.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Staged tables must be readable from every executor, so the cluster's setting is used when
    there is one. Where it is unset, a temporary folder is taken only if driver and executors
    are one process (a ``local`` master, as in tests); anywhere else that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
        root = tempfile.mkdtemp(prefix="pmweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    folder = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def discard(frame: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    spark = frame.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
