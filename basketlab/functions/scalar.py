"""Scalar column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL for a double column (pandas treats NaN as missing; in Spark
    ``NaN >= 0`` is true, so this must run before any predicate)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c, F.lit(None).cast("double"))


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Apply ``nan_to_null`` to every float/double column, keep names/order."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(nan_to_null(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def guarded_divide(num: Column, den: Column, zero: float = 0.0) -> Column:
    """``num / den`` with ``zero`` when the divisor is 0 (ANSI mode would raise)."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(zero))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two dates as BIGINT."""
    return F.datediff(later, earlier).cast("bigint")
