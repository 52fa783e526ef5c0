"""Shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir`` or ``setCheckpointDir``, which every machine of the cluster must see."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named


def new_path(spark: SparkSession, name: str) -> str:
    """Path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
