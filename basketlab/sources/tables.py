"""Sources and sinks.

A "table" is either a catalog name or a path (anything containing '/' or a
URI scheme). Paths are read and written as parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import assert_schema
from ..session import path_exists
from .versioned import VersionedTable

MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists",
         "overwrite": "overwrite", "errorifexists": "errorifexists"}


def is_path(name: str) -> bool:
    return "/" in name or ":" in name


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole table. With ``schema`` a path is read by it, without looking
    into the files: columns come in declared order, a table without a single
    row (and so without a file) is empty instead of unreadable, and a file of
    other types fails when it is read. A catalog table's own schema is
    compared with it. A versioned table is read at its current version."""
    if not is_path(name):
        df = spark.table(name)
        return assert_schema(df, schema, name) if schema is not None else df
    versions = VersionedTable(spark, name)
    if (now := versions.current_version()) is not None:
        name = versions.path(now)
    if schema is None:
        return spark.read.parquet(name)
    return spark.read.schema(schema).parquet(name).select(*schema.names)


def read_until(df: DataFrame, date_col: str = "InvoiceDate", as_of=None) -> DataFrame:
    """Rows at or before ``as_of`` (default: now). On a table partitioned
    by ``date_col`` this prunes partitions; otherwise it is pushed to the scan."""
    dt = df.schema[date_col].dataType
    if as_of is None:
        bound = F.current_date() if isinstance(dt, T.DateType) else F.current_timestamp()
    else:
        bound = F.lit(str(as_of)).cast(dt)
    return df.where(F.col(date_col) <= bound)


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    """S3: validate first, then run. The statement is parsed and analysed,
    which executes nothing, not even a command; errors come up here. The
    result is a distributed DataFrame; nothing is collected."""
    state = spark._jsparkSession.sessionState()
    plan = state.sqlParser().parsePlan(sql)
    state.executePlan(plan, getattr(state, "executePlan$default$2")()).assertAnalyzed()
    return spark.sql(sql)


def write_table(df: DataFrame, name: str, mode: str = "replace") -> None:
    """Replace, append (default of S9) or fail-if-present."""
    w = df.write.mode(MODES[mode])
    if is_path(name):
        w.parquet(name)
    else:
        w.format("parquet").saveAsTable(name)


def write_partitioned(df: DataFrame, name: str, part_col: str = "InvoiceDate",
                      mode: str = "replace", atomic: bool = True) -> None:
    """Create-or-replace a table partitioned by ``part_col``.

    A ``rebalance`` hint on the partition column hash-distributes rows by
    date (few files per date), and AQE splits a date that holds a large
    share of all rows over several tasks and merges small ones. There is no
    sampling pass over the input (range partitioning would recompute the
    whole upstream plan once more to sample it).

    A path is replaced by a next version of the table (``VersionedTable``,
    the last two stay): readers see the old rows until the new ones are
    committed, also if the write fails, and a date that is gone has no folder
    left over. ``atomic=False`` overwrites the folder itself, for a writer
    that alone reads it.
    """
    df = df.hint("rebalance", part_col)
    if not is_path(name):
        df.write.mode(MODES[mode]).partitionBy(part_col).format("parquet").saveAsTable(name)
        return
    versions = VersionedTable(df.sparkSession, name, keep=2)
    if atomic and MODES[mode] == "overwrite":
        versions.write(df, partition_by=part_col)
        return
    if MODES[mode] == "append" and (now := versions.current_version()) is not None:
        name = versions.path(now)
    df.write.mode(MODES[mode]).partitionBy(part_col).parquet(name)


def read_partitioned(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned table back; partition column comes last on read, so
    the declared order is restored by name."""
    return read_table(spark, name, schema)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Table or path present (a path counts once a write committed: a
    plain table's ``_SUCCESS`` file, or a committed version of a versioned
    table)."""
    if is_path(name):
        return (path_exists(spark, name.rstrip("/") + "/_SUCCESS")
                or VersionedTable(spark, name).exists())
    return spark.catalog.tableExists(name)
