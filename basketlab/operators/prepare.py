"""Data preparation: typed frames for feature engineering (lazy plans over one
input; nothing is materialised here)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import normalise_types
from ..schemas import FILTERED_COLUMNS, RETURNS_COLUMNS


def keep(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep listed columns (column pruning reaches the scan)."""
    return df.select(*cols)


def filtered(df: DataFrame) -> DataFrame:
    """P5: the 7-column frame (no Description)."""
    return keep(df, FILTERED_COLUMNS)


def returns(df: DataFrame) -> DataFrame:
    """Lines with negative quantity, customer and quantity only."""
    return df.where(F.col("Quantity") < 0).select(*RETURNS_COLUMNS)


def purchases(df: DataFrame) -> DataFrame:
    """Lines with quantity >= 0 (zero counts as a purchase)."""
    return df.where(F.col("Quantity") >= 0)


def cast_trusted(df: DataFrame) -> DataFrame:
    """Type normalisation for curated input, where CustomerID is known to be
    present and finite (P1), so the all-or-nothing check cannot fail and the
    extra checking pass over the data is skipped."""
    return (df.withColumn("CustomerID", F.col("CustomerID").cast("bigint"))
              .withColumn("InvoiceDate", F.col("InvoiceDate").cast("date")))


def prepare(df: DataFrame, trusted: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(filtered, purchases, returns) after F3 type normalisation."""
    typed = cast_trusted(df) if trusted else normalise_types(df)
    return filtered(typed), purchases(typed), returns(typed)


def require(df: DataFrame, cols, name: str = "frame", non_empty: bool = False) -> DataFrame:
    """Required columns (schema only) and optional non-empty check
    (``isEmpty`` reads at most one row)."""
    lacking = [c for c in cols if c not in df.columns]
    if lacking:
        raise ValueError(f"{name} lacks the columns {lacking}")
    if non_empty and df.isEmpty():
        raise ValueError(f"{name} has no rows")
    return df


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """P10: drop rows with any null in ``subset`` (default all columns)."""
    return df.na.drop("any", subset=subset)


def fill_zero(df: DataFrame, col: str) -> DataFrame:
    """Missing -> 0 in ``col``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(0).cast(df.schema[col].dataType)))
