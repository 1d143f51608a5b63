"""Session builder with the settings every query of the package assumes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.sizeOfNull": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, name: str = "skein", **extra: str) -> SparkSession:
    """A session with UTC timestamps, AQE and Arrow; `extra` adds settings (dots written as in Spark)."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the shared Parquet tables, by Spark's own reader so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, from spark.checkpoint.dir; on local masters in Spark's
    warehouse if that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local["):
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    if not folder:
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, which cuts its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
