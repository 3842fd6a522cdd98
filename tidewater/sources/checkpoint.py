"""Intermediate results that several later steps read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's folder for intermediate results, below its ``spark.checkpoint.dir``.

    Only a session in a single local process gets a temporary folder when none is set; a cluster
    without one is an error, since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
                raise RuntimeError("Set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="tidewater-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the session's shared folder.

    With ``spark.cleaner.referenceTracking.cleanCheckpoints`` the files go when the frame does.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    Unlike a settled frame the result forgets how large Spark once guessed it to be. In a loop
    that joins its own results those guesses multiply, until planning a step takes minutes.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system; one that is gone does no harm."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
