"""Which scoring version is in force: an append-only table of decisions, the last of which counts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.models import active_variant, load_model

DECISIONS = "decided_at timestamp, place long, version string, variant string, model_path string"


class ModelVersions:
    """A table of decisions below ``path``.  Rows are few: one per release or rollback, never changed."""

    def __init__(self, path: str):
        self.path = path
        self.loaded: dict[str, PipelineModel] = {}

    def decisions(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(DECISIONS).parquet(self.path)

    def put_in_force(self, spark: SparkSession, version: str, variant: str = "ml", model_path: str | None = None) -> None:
        """From now on ``version`` scores; without a path it is one that was in force before (a rollback).

        Decisions are made by one writer at a time.
        """
        before = self._exists(spark)
        last = (self.decisions(spark).agg(F.max("place")).first()[0] or 0) if before else 0
        if model_path is None and before:
            known = self.decisions(spark).where(F.col("version") == version).orderBy(F.desc("place")).first()
            if known is not None:
                variant, model_path = known["variant"], known["model_path"]
        if active_variant(variant) == "ml" and model_path is None:
            raise ValueError(f"version {version} has no stored model")
        row = (datetime.now(timezone.utc).replace(tzinfo=None), last + 1, version, variant, model_path)
        spark.createDataFrame([row], DECISIONS).coalesce(1).write.mode("append").parquet(self.path)

    def in_force(self, spark: SparkSession) -> tuple[str, str, PipelineModel | None]:
        """Name, variant and model; a stored model is loaded once."""
        last = self.decisions(spark).orderBy(F.desc("place")).first()
        if last is None:
            raise ValueError("no version is in force")
        path = last["model_path"]
        if path is not None and path not in self.loaded:
            self.loaded[path] = load_model(path)
        return last["version"], last["variant"], self.loaded.get(path)

    def _exists(self, spark: SparkSession) -> bool:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)
