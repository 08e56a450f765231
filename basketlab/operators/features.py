"""Per-customer features.

Two forms compute the same table:

* ``customer_features`` (flagship, fused): two partial+final aggregations,
  (customer, invoice, date) then customer. The first level is both the
  de-duplication that purchase frequency needs and a partial aggregate for
  every other feature. Both levels are algebraic (sum / count / min / max), so
  map-side combining collapses a hot customer before each shuffle.
* ``features_join``: the five separate aggregates joined on CustomerID, kept
  as a cross-check.

The recency anchor (latest date of the *filtered* frame, returns and rows
without customer included) is a scalar subquery, inlined as a literal, so no
join is needed to attach it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import guarded_divide, whole_days
from ..schemas import FEATURE_COLUMNS
from ..session import shared_dir
from .prepare import drop_incomplete, fill_zero, require

# Columns that the feature build reads.
FEATURE_INPUT = ("CustomerID", "InvoiceNo", "InvoiceDate", "Quantity", "UnitPrice", "StockCode")


def _q() -> Column:
    return F.col("Quantity")


def _keyed(df: DataFrame) -> DataFrame:
    # pandas groupby drops missing keys; Spark would make a NULL group.
    return df.where(F.col("CustomerID").isNotNull())


def anchor_date(filtered_df: DataFrame) -> Column:
    """The latest InvoiceDate of the filtered frame as a scalar subquery."""
    return filtered_df.agg(F.max("InvoiceDate")).scalar()


def gross_revenue(p: DataFrame) -> DataFrame:
    """A1: sum(Quantity * UnitPrice) per customer over purchases."""
    return (_keyed(p).groupBy("CustomerID")
            .agg(F.coalesce(F.sum(_q() * F.col("UnitPrice")), F.lit(0.0)).alias("gross_revenue")))


def last_purchase(p: DataFrame) -> DataFrame:
    return _keyed(p).groupBy("CustomerID").agg(F.max("InvoiceDate").alias("InvoiceDate"))


def recency(p: DataFrame, f: DataFrame) -> DataFrame:
    """A2: days from each customer's last purchase to the filtered frame's
    latest date."""
    return last_purchase(p).select(
        "CustomerID", whole_days(anchor_date(f), F.col("InvoiceDate")).alias("recency_days"))


def qty_products(p: DataFrame) -> DataFrame:
    """A3: number of purchase lines with a StockCode (not distinct)."""
    return _keyed(p).groupBy("CustomerID").agg(F.count("StockCode").alias("qty_products"))


def frequency(p: DataFrame) -> DataFrame:
    """A4: distinct (customer, invoice, date) visits per active day span."""
    visits = _keyed(p).select("CustomerID", "InvoiceNo", "InvoiceDate").dropDuplicates()
    agg = visits.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("max_"),
        F.min("InvoiceDate").alias("min_"),
        F.count("InvoiceNo").alias("buy_"))
    days = (whole_days(F.col("max_"), F.col("min_")) + 1)
    return agg.select(
        "CustomerID", "max_", "min_", days.alias("days_"), "buy_",
        F.when(days.isNull(), F.lit(None).cast("double"))
         .otherwise(guarded_divide(F.col("buy_"), days)).alias("frequency"))


def qty_returns(r: DataFrame) -> DataFrame:
    """A5: returned units, as a positive number."""
    return (_keyed(r).groupBy("CustomerID")
            .agg((-F.coalesce(F.sum(_q()), F.lit(0))).cast("bigint").alias("qty_returns")))


def distinct_customers(f: DataFrame) -> DataFrame:
    """Distinct customers of the filtered frame."""
    return f.select("CustomerID").distinct()


def active_customers(raw: DataFrame, day) -> DataFrame:
    """Distinct customers with a raw line on ``day``."""
    from .clean import as_of_col
    return raw.where(F.col("InvoiceDate") == as_of_col(day)).select("CustomerID").distinct()


def daily_quantity(df: DataFrame, lo=None, hi=None, keys: tuple = (),
                   date_col: str = "InvoiceDate", value_col: str = "Quantity") -> DataFrame:
    """Total quantity per day (and per series key) in [lo, hi]."""
    if lo is not None and hi is not None:
        df = df.where(F.col(date_col).between(F.to_date(F.lit(str(lo))), F.to_date(F.lit(str(hi)))))
    return (df.groupBy(*keys, date_col)
              .agg(F.sum(value_col).cast("bigint").alias(value_col)))


def features_join(f: DataFrame, p: DataFrame, r: DataFrame) -> DataFrame:
    """J1 + P10 + P11: the joined form (left-join chain on CustomerID)."""
    require(f, ("CustomerID", "InvoiceDate"), "filtered")
    require(p, FEATURE_INPUT, "purchases")
    require(r, ("CustomerID", "Quantity"), "returns")
    parts = [distinct_customers(f), gross_revenue(p), recency(p, f), qty_products(p),
             frequency(p).select("CustomerID", "frequency"), qty_returns(r)]
    # Left-join on an equality key never matches NULL; a NULL customer row
    # would survive with all features missing and be dropped below.
    joined = reduce(lambda a, b: a.join(b, "CustomerID", "left"), parts)
    joined = fill_zero(joined, "qty_returns")
    return drop_incomplete(joined.select(*FEATURE_COLUMNS))


def customer_features(typed: DataFrame, anchor: Column | None = None,
                      only: DataFrame | None = None) -> DataFrame:
    """A6 (fused): one feature row per customer with at least one purchase.

    ``typed`` has the prepared schema (CustomerID BIGINT, InvoiceDate DATE);
    ``filtered`` / ``purchases`` / ``returns`` are the three row predicates of
    it, evaluated inside the aggregation instead of as three frames.
    ``anchor`` overrides the recency anchor (default: latest date of ``typed``).
    ``only`` (one ``CustomerID`` per row) restricts the result, and with it the
    default anchor, to some customers. The semi-join stands above both
    aggregations: below them it would deal the raw lines out by customer, and
    a customer with many lines would meet in one task uncombined.
    """
    level2 = merged(daily_partials(typed))
    if only is not None:
        level2 = level2.join(only, "CustomerID", "left_semi")
    # The anchor covers every filtered row; rows without customer sit in the
    # NULL group of level2. level2 (one row per customer, far smaller than the input) feeds both
    # the anchor and the final projection. Column pruning makes the two uses
    # different plans, so Spark would not share their shuffle; a reliable
    # checkpoint in the shared checkpoint folder computes it once, cuts the
    # lineage and survives executor loss. The anchor is then one scalar
    # subquery over the checkpointed rows: no join at all.
    shared_dir(typed.sparkSession)
    level2 = level2.checkpoint(eager=True)
    if anchor is None:
        anchor = level2.agg(F.max("max_any")).scalar()
    return from_partials(level2, anchor)


def daily_partials(typed: DataFrame) -> DataFrame:
    """Per (customer, invoice, day) the sums, counts and extremes that the
    features are made of, in the form that ``merged`` adds up. A day's invoices
    are counted here once, and belong to no other day. Rows without a customer are one
    group, which counts for the anchor alone."""
    require(typed, FEATURE_INPUT, "typed lines")
    Q = _q()
    purch = Q >= 0
    level1 = typed.groupBy("CustomerID", "InvoiceNo", "InvoiceDate").agg(
        F.sum(F.when(purch, Q * F.col("UnitPrice"))).alias("rev"),
        F.count(F.when(purch, F.col("StockCode"))).alias("lines"),
        F.count(F.when(purch, F.lit(1))).alias("n_purch"),
        F.sum(F.when(Q < 0, Q)).alias("ret"))
    bought = F.col("n_purch") > 0
    day = F.col("InvoiceDate")
    return level1.select(
        "CustomerID", "rev", "lines", "ret", F.when(bought, day).alias("last_"), F.when(bought, day).alias("first_"),
        F.when(bought & F.col("InvoiceNo").isNotNull(), 1).otherwise(0).cast("bigint").alias("buy_"), "n_purch",
        day.alias("max_any"))


def merged(partials: DataFrame, *by) -> DataFrame:
    """Partial rows added up per customer (and the columns ``by``); the result
    can be merged again with others."""
    return partials.groupBy("CustomerID", *by).agg(
        F.sum("rev").alias("rev"), F.sum("lines").alias("lines"), F.sum("ret").alias("ret"),
        F.max("last_").alias("last_"), F.min("first_").alias("first_"), F.sum("buy_").alias("buy_"),
        F.max("n_purch").alias("n_purch"), F.max("max_any").alias("max_any"))


def from_partials(level2: DataFrame, anchor: Column) -> DataFrame:
    """The feature rows of merged partials, for customers with a purchase."""
    days = whole_days(F.col("last_"), F.col("first_")) + 1
    keep = (F.col("CustomerID").isNotNull() & (F.col("n_purch") > 0)
            & F.col("last_").isNotNull())
    return (level2
            .where(keep)
            .select(
                F.col("CustomerID"),
                F.coalesce(F.col("rev"), F.lit(0.0)).alias("gross_revenue"),
                whole_days(anchor, F.col("last_")).alias("recency_days"),
                F.col("lines").cast("bigint").alias("qty_products"),
                guarded_divide(F.col("buy_"), days).alias("frequency"),
                (-F.coalesce(F.col("ret"), F.lit(0))).cast("bigint").alias("qty_returns")))
