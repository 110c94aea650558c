"""Tables and files in the folder that the whole cluster shares.

Lineage is cut with written tables, never with executors' own disks: a lost executor loses
nothing, and a retried task writes the same rows.  Operators delete the tables that nothing reads any
more (``dropped``); those that a returned frame still reads stay until ``clear``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths that this process has written and not deleted.
_written: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; where it is unset a temporary one, on local masters alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.add(path)
    return path


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Writes a frame as Parquet in the shared folder and returns the frame that reads it."""
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out._stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _written.discard(path)


def dropped(*frames: DataFrame | None) -> None:
    """Deletes the files of frames that ``stored`` gave and that nothing reads any more."""
    for frame in frames:
        path = getattr(frame, "_stored_at", None) if frame is not None else None
        if path in _written:
            _delete(frame.sparkSession, path)


def clear(spark: SparkSession) -> int:
    """Deletes all that this process has written in the shared folder; frames that read it are of no more use."""
    paths = sorted(_written)
    for path in paths:
        _delete(spark, path)
    return len(paths)
