"""Shared scratch folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """Folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine. The name
    of a step is kept within one application, so running it again replaces its files.
    """
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder every executor can reach")
        base = os.path.join(tempfile.gettempdir(), "wayline-scratch")
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For a result that several later steps read: it is computed once, and a lost
    executor costs a re-read instead of the whole lineage.
    """
    path = shared_folder(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
