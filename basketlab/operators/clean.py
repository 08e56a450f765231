"""Cleaning of raw invoice lines into the curated table (one narrow stage,
no shuffle: both rule sets are row predicates that Catalyst merges into one
filter and pushes into the parquet scan where it can)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null_all

# The business rules of the curated table.
PRICE_FLOOR = 0.04
EXCLUDED_COUNTRIES = ("European Community", "Unspecified")
EXCLUDED_STOCK_CODES = ("POST", "D", "DOT", "M", "S", "AMAZONFEE", "m",
                        "DCGSSBOY", "DCGSSGIRL", "PADS", "B", "CRUK")
EXCLUDED_CUSTOMERS = (16446,)


@dataclass(frozen=True)
class Rules:
    price_floor: float = PRICE_FLOOR
    countries: tuple = EXCLUDED_COUNTRIES
    stock_codes: tuple = EXCLUDED_STOCK_CODES  # case-sensitive on purpose
    customers: tuple = field(default=EXCLUDED_CUSTOMERS)


def as_of_col(as_of) -> Column:
    """``as_of`` as a DATE column; None means today (session time zone)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of).cast("date")
    return F.to_date(F.lit(str(as_of)))


def not_null_rows(df: DataFrame, as_of=None, cut_off: bool = True) -> DataFrame:
    """Not in the future, customer and description present. Without
    ``cut_off`` later rows stay, for a table that is cut on every read."""
    cond = F.col("CustomerID").isNotNull() & F.col("Description").isNotNull()
    return df.where((F.col("InvoiceDate") <= as_of_col(as_of)) & cond if cut_off
                    else F.col("InvoiceDate").isNotNull() & cond)


def business_rows(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Price floor, excluded countries / stock codes / customers.

    SQL three-valued logic: a NULL Country, StockCode or UnitPrice fails.
    """
    cond = (F.col("UnitPrice") >= F.lit(rules.price_floor))
    if rules.countries:
        cond = cond & ~F.col("Country").isin(*rules.countries)
    if rules.stock_codes:
        cond = cond & ~F.col("StockCode").isin(*rules.stock_codes)
    for c in rules.customers:
        cond = cond & (F.col("CustomerID") != F.lit(float(c)))
    return df.where(cond)


def curate(raw: DataFrame, as_of=None, rules: Rules = Rules(), cut_off: bool = True) -> DataFrame:
    """NaN -> NULL on doubles, then P1 and P2 (one filter after Catalyst)."""
    return business_rows(not_null_rows(nan_to_null_all(raw), as_of, cut_off), rules)
