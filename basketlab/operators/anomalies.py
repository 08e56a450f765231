"""Spikes, dips and step changes of daily series (part of T4 and T5).

A spike or dip is a day far from the median of the days around it, measured
by the median distance in the same window. A step is a lasting change of
level: the day where a stretch's running sum of distances from its mean is
farthest from zero, if the fortnights on either side differ by several times
the day-to-day noise; both parts are then searched again. All of it is
windows, one grouped maximum and one join a round, for all series at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .forecast import DATE, VALUE

#: Days on either side of a rolling median, and of a step.
AROUND, BESIDE = 7, 14
#: Standard deviations (of a normal distribution with that median distance).
SPIKE_LIMIT, STEP_LIMIT = 5.0, 5.0
#: Median distance to standard deviation, for normal noise.
MAD_TO_SD = 1.4826
ROUNDS = 3


def _median(values: Column) -> Column:
    """Of a sorted array: its middle, or the mean of the two middles."""
    n = F.size(values)
    return (F.get(values, F.floor((n - 1) / 2).cast("int")) + F.get(values, F.floor(n / 2).cast("int"))) / 2


def anomalies(series: DataFrame, keys=(), date_col: str = DATE, value_col: str = VALUE) -> DataFrame:
    """The daily rows (gapless; ``seasonal_trend`` output counts without its
    season) with ``spike``, ``dip`` and ``step`` (the first day on a new
    level), ``cleaned`` (spikes and dips replaced by the median around them)
    and ``steady`` (cleaned, with all days moved to the last level).

    A window whose days are mostly equal has no scale and no spike; a series
    without day-to-day noise has no step, nor has one of fewer than two
    fortnights. At most 2 ** ``ROUNDS`` - 1 steps are found a series."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(date_col)
    around = w.rowsBetween(-AROUND, AROUND)
    season = F.col("seasonal") if "seasonal" in series.columns else F.lit(0.0)
    rows = series.select(*keys, date_col, F.col(value_col).cast("double").alias(value_col), season.alias("__s"))
    rows = rows.withColumn("__x", F.col(value_col) - F.col("__s"))
    rows = rows.withColumn("__m", _median(F.sort_array(F.collect_list("__x").over(around))))
    rows = rows.withColumn("__d", F.col("__x") - F.col("__m"))
    rows = rows.withColumn("__a", _median(F.sort_array(F.collect_list(F.abs("__d")).over(around))))
    far = F.lit(SPIKE_LIMIT * MAD_TO_SD) * F.col("__a")
    rows = rows.withColumns({"spike": (F.col("__a") > 0) & (F.col("__d") > far),
                             "dip": (F.col("__a") > 0) & (F.col("__d") < -far)})
    rows = rows.withColumn("__x", F.when(F.col("spike") | F.col("dip"), F.col("__m")).otherwise(F.col("__x")))
    rows = rows.withColumn("__n", F.abs(F.col("__x") - F.lag("__x").over(w)))
    # Noise between days: the median step from one to the next.
    whole = Window.partitionBy(*keys)
    noise = F.expr("percentile(__n, 0.5D)").over(whole) * (MAD_TO_SD / 2 ** 0.5)
    rows = rows.withColumn("__n", noise).withColumns({"__g": F.lit(1), "__j": F.lit(None).cast("double")})
    for _ in range(ROUNDS):
        rows = _split(rows, keys, date_col)
    # Changes of level after the day: all less those up to it.
    jump = F.coalesce(F.col("__j"), F.lit(0.0))
    later = F.sum(jump).over(whole) - F.sum(jump).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(
        *keys, date_col, value_col, "spike", "dip", F.col("__j").isNotNull().alias("step"),
        (F.col("__x") + F.col("__s")).alias("cleaned"),
        (F.col("__x") + F.col("__s") + later).alias("steady"))


def _split(rows: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """One round: every stretch (``__g``) is cut at its step, if it has one;
    the first day behind it gets the change of level (``__j``)."""
    own = [*keys, "__g"]
    w = Window.partitionBy(*own).orderBy(date_col)
    mean = F.avg("__x").over(Window.partitionBy(*own))
    before, after = w.rowsBetween(1 - BESIDE, 0), w.rowsBetween(1, BESIDE)
    full = (F.count("__x").over(before) == BESIDE) & (F.count("__x").over(after) == BESIDE)
    scored = rows.withColumn("__c", F.col("__x") - mean)
    scored = scored.withColumns({
        "__c": F.abs(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))),
        "__u": F.when(full, F.avg("__x").over(after) - F.avg("__x").over(before)),
        "__t": F.lead(date_col).over(w)})
    best = (scored.filter("__u IS NOT NULL").groupBy(*own)
            .agg(F.max_by(F.struct("__t", "__u", "__n"), F.col("__c")).alias("__b"))
            .filter((F.col("__b.__n") > 0) & (F.abs(F.col("__b.__u")) >= STEP_LIMIT * F.col("__b.__n")))
            .select(*own, F.col("__b.__t").alias("__first"), F.col("__b.__u").alias("__by")))
    cut = rows.join(best, own, "left")
    return cut.withColumns({
        "__j": F.when(F.col(date_col) == F.col("__first"), F.col("__by")).otherwise(F.col("__j")),
        "__g": 2 * F.col("__g") + F.coalesce((F.col(date_col) >= F.col("__first")).cast("int"), F.lit(0)),
    }).drop("__first", "__by")


def flags(found: DataFrame, keys=()) -> DataFrame:
    """Per series: has_spikes_and_dips and has_step_changes."""
    return found.groupBy(*keys).agg(F.max(F.col("spike") | F.col("dip")).alias("has_spikes_and_dips"),
                                    F.max("step").alias("has_step_changes"))
