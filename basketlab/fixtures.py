"""Retail-shaped input derived from the driver's TPC-H-like tables.

The driver tables are clean, so deterministic dirt is added (excluded stock
codes and countries, missing customers and descriptions, a too-low price) so
that every cleaning rule has rows to act on. The same derivation exists as SQL
(``RAW_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]

# Stock codes that cleaning must drop, as they occur in raw data.
# Written out here, not taken from the rules under test.
DIRTY_CODES = ["POST", "D", "DOT", "M", "S", "AMAZONFEE", "m", "DCGSSBOY", "DCGSSGIRL", "PADS", "B", "CRUK"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_mod(c: str, m: int) -> Column:
    return (F.col(c) % F.lit(m)) == 0


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines (8 columns, raw schema) from lineitem/orders/customer/
    nation/part.

    lineitem and orders are both fact-sized, so their join is left to the
    planner (sort-merge, or broadcast when AQE sees a small side at run time).
    nation has 25 rows by definition and is broadcast explicitly.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
           .join(p, li.l_partkey == p.p_partkey))
    return j.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.when(_when_mod("l_partkey", 43), F.element_at(
            F.array(*map(F.lit, DIRTY_CODES)), (F.col("l_orderkey") % len(DIRTY_CODES) + 1).cast("int")))
         .otherwise(F.col("l_partkey").cast("string")).alias("StockCode"),
        F.when(_when_mod("l_partkey", 61), F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("Description"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
         .otherwise(F.col("l_quantity")).cast("bigint").alias("Quantity"),
        F.col("o_orderdate").cast("date").alias("InvoiceDate"),
        F.when((F.col("l_linenumber") == 7) & _when_mod("l_partkey", 5), F.lit(0.01))
         .otherwise(F.col("p_retailprice")).alias("UnitPrice"),
        F.when(_when_mod("o_orderkey", 41), F.lit(None).cast("double"))
         .when(_when_mod("o_custkey", 49), F.lit(16446.0))  # the excluded customer
         .otherwise(F.col("o_custkey").cast("double")).alias("CustomerID"),
        F.when(F.col("n_nationkey") == 24, F.lit("Unspecified"))
         .when(F.col("n_nationkey") == 23, F.lit("European Community"))
         .otherwise(F.col("n_name")).alias("Country"),
    )


# The same derivation for DuckDB (VARCHAR instead of STRING).
RAW_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
  CASE WHEN l_partkey % 43 = 0 THEN (['POST', 'D', 'DOT', 'M', 'S', 'AMAZONFEE', 'm', 'DCGSSBOY', 'DCGSSGIRL',
       'PADS', 'B', 'CRUK'])[l_orderkey % 12 + 1] ELSE CAST(l_partkey AS VARCHAR) END AS StockCode,
  CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE p_name END AS Description,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS Quantity,
  CAST(o_orderdate AS DATE) AS InvoiceDate,
  CASE WHEN l_linenumber = 7 AND l_partkey % 5 = 0 THEN 0.01 ELSE p_retailprice END AS UnitPrice,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_custkey % 49 = 0 THEN 16446.0
       ELSE CAST(o_custkey AS DOUBLE) END AS CustomerID,
  CASE WHEN n_nationkey = 24 THEN 'Unspecified' WHEN n_nationkey = 23 THEN 'European Community'
       ELSE n_name END AS Country
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
"""

