"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "tickloom", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local bench; on a cluster pass your own session to the operators."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only where that setting is absent (a local test session) a temporary folder is used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    """One temporary folder for a process whose session names none; it goes when the process ends."""
    path = tempfile.mkdtemp(prefix="tickloom-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: for results that several later jobs read."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
