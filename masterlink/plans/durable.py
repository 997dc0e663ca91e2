"""Cuts of lineage that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: that of spark.checkpoint.dir, which all executors must reach.

    Only where that is unset and driver and executors are one process, as in tests, a folder of this machine is taken.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if sc.master.split("[")[0] != "local":
                raise RuntimeError("spark.checkpoint.dir is unset; set it to a folder that all executors reach")
            folder = Path(tempfile.mkdtemp(prefix="checkpoints-")).as_uri()
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with a checkpoint in the folder that all executors share."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def rewritten(df: DataFrame, name: str) -> DataFrame:
    """The DataFrame, written as Parquet in the folder that all executors share and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
