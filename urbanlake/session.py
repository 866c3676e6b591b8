"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "urbanlake", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    Leave ``shuffle_partitions`` unset on a cluster that configures it; AQE
    coalesces small partitions and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every column costs more than building the plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


#: Scratch folders of local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    A session that names none has its driver and executors in one process, or it cannot work: then a folder of this machine
    serves them all.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        name = spark.sparkContext.applicationId
        root = _LOCAL.get(name) or _LOCAL.setdefault(name, tempfile.mkdtemp(prefix="urbanlake-"))
    return f"{root.rstrip('/')}/urbanlake/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the folder that ``stage`` wrote for ``df``, which must not be read again."""
    found = re.match(r"(.*/urbanlake/[^/]+)/", next(iter(df.inputFiles()), ""))
    if found:
        delete_folder(df.sparkSession, found[1])


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
