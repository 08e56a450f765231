"""Fixed table schemas of the retail job (explicit, never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.DateType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
])
CURATED = RAW

# After type normalisation CustomerID is an integer key.
PREPARED = T.StructType([
    f if f.name != "CustomerID" else T.StructField("CustomerID", T.LongType())
    for f in RAW.fields
])

FILTERED_COLUMNS = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate",
                    "UnitPrice", "CustomerID", "Country"]
RETURNS_COLUMNS = ["CustomerID", "Quantity"]

FEATURES = T.StructType([
    T.StructField("CustomerID", T.LongType()),
    T.StructField("gross_revenue", T.DoubleType()),
    T.StructField("recency_days", T.LongType()),
    T.StructField("qty_products", T.LongType()),
    T.StructField("frequency", T.DoubleType()),
    T.StructField("qty_returns", T.LongType()),
])
FEATURE_COLUMNS = [f.name for f in FEATURES.fields]

# Entity key and feature-time column names of the stored feature table.
ENTITY_COL = "values"
TIME_COL = "timestamp"

# Registered feature types, descriptions and labels, in the
# reference's order. Four DOUBLE features and one INT64 feature.
FEATURE_REGISTRY = [
    ("gross_revenue", "DOUBLE", "Gross Revenue", {"status": "passed"}),
    ("recency_days", "DOUBLE", "Recency Days", {"status": "passed"}),
    ("qty_products", "DOUBLE", "Quantity products", {"status": "passed"}),
    ("frequency", "DOUBLE", "Frequency", {"status": "passed"}),
    ("qty_returns", "INT64", "Quantity returns", {"status": "passed"}),
]

# Model inputs in fit/predict order, the unused target, k.
MODEL_FEATURES = ["qty_products", "qty_returns", "frequency", "recency_days"]
MODEL_TARGET = "gross_revenue"
N_CLUSTERS = 8
SEED = 42

SPARK_TYPES = {"DOUBLE": T.DoubleType(), "INT64": T.LongType(),
               "STRING": T.StringType(), "BOOL": T.BooleanType()}


def assert_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Check names and types by name (partitioned reads put the partition
    column last), then return the columns in the declared order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    wrong = [(f.name, have[f.name].simpleString(), f.dataType.simpleString())
             for f in schema.fields if have[f.name] != f.dataType]
    if wrong:
        raise ValueError(f"{name}: wrong types (column, have, want) {wrong}")
    return df.select(*[f.name for f in schema.fields])
