"""Feature tables, reports and the run log on files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import RUN_LOG


def read_features(spark: SparkSession, path: str, time_column: str = "ts") -> DataFrame:
    """A feature table in time order.  Use the unsorted scan where order does not matter."""
    df = spark.read.parquet(path)
    if isinstance(df.schema[time_column].dataType, T.StringType):
        df = df.withColumn(time_column, F.to_timestamp(time_column))
    return df.orderBy(time_column)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def read_first_available(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The first existing path of the list, .parquet or .csv (with header; give a schema to avoid inference)."""
    for path in paths:
        if path_exists(spark, path):
            if path.endswith(".csv"):
                reader = spark.read.option("header", True)
                return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
            return spark.read.parquet(path)
    raise FileNotFoundError(", ".join(paths))


def write_features(features: DataFrame, path: str, mode: str = "append") -> None:
    """Append feature rows by symbol and day.  Rows of a partition are brought together first, so a day of a symbol
    is a few files rather than one per task; AQE splits a partition that is too large."""
    dated = features.withColumn("date", F.col("ts").cast("date"))
    (dated.hint("rebalance", "symbol", "date").write.mode(mode).option("compression", "snappy")
     .partitionBy("symbol", "date").parquet(path))


def write_csv_report(report: DataFrame, path: str) -> None:
    """A small report (one row per feature or model) as one CSV file with header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append training runs to the run log table."""
    runs.select(*RUN_LOG.fieldNames()).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def latest_runs(runs: DataFrame, n: int = 3) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_name").limit(n)


# to_json would cut times to milliseconds
_JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def feature_messages(features: DataFrame) -> DataFrame:
    """``key``, ``value``: each feature row as a JSON message."""
    return features.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*features.columns), _JSON_TIMES).alias("value")
    )
