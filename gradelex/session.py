"""Session plumbing: table access and cutting of lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []
_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once per application; the driver serves the archive."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    home = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="gradelex-")) / "gradelex.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a temporary folder serves a session that runs in this process
    only; on a cluster that is an error, as every executor would write to a disk of its own."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = "file://" + os.path.join(tempfile.gettempdir(), f"gradelex-{os.getpid()}")
    return conf.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted with what cut() has written."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(drop_cuts)
    _written.append((spark, path))
    return path


def cut(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and reads it back, so that later stages neither
    recompute it nor depend on an executor that may be lost. Unlike checkpoint() it evaluates the plan once."""
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts() -> None:
    """Deletes what cut() and scratch() have written, at exit or when a caller is done; frames that read it are then of no use."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone at exit
            return
