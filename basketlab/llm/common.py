"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.session import delete_path, scratch_path, shared_dir, ship_package

#: Removes a query's shuffle files as soon as it ends: its result is a table.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and return the
    reread table: a cut of the lineage that survives the loss of executors.
    The shuffle files behind it go once it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.__dict__["scratch"] = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete ``materialise``d tables that nothing reads any more."""
    for table in tables:
        path = table.__dict__.pop("scratch", None)
        if path:
            delete_path(table.sparkSession, path)


def python_ready(spark: SparkSession) -> None:
    """Call before a plan with Python stages: ships the package to the
    workers and makes sure that the shared folder is known."""
    shared_dir(spark)
    ship_package(spark)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
