"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame

_own: list[str] = []


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that driver and executors share, and read again."""
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="annolake-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        base = f"file://{_own[0]}"
    path = f"{base.rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
