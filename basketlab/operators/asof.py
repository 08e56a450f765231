"""Point-in-time (as-of) join: for each left row, the latest right row of the
same entity whose time is at or before the left row's time.

Spark has no as-of join operator, and a range join (entity equal, right time
<= left time, keep the latest) first emits every earlier pair of an entity,
which explodes on busy entities. Here the match is computed on *keys* with
built-in operators, in a way that bounds every task even when one entity,
one instant or one group of duplicate rows holds a large share of the data:

1. Duplicates collapse first: left keys (entity, time) are made distinct and
   the right side is reduced to one row per (entity, time), the winner of the
   tie rule (both partial + final aggregates).
2. The union of both key sets is range-partitioned on (entity, time). The
   range bounds come from a sample of the keys, so a busy entity is cut into
   as many time slices as its share of the data needs. Each key then carries
   its slice number. The sliced keys (four narrow columns) are written once
   as a reliable checkpoint in the shared folder: steps 3 and 4 read them
   three times, and recomputing would repeat both scans, the aggregations
   and the sampling pass, and could even draw other range bounds, which
   would make the slice numbers of the three uses disagree.
3. Within (entity, slice), a running ``last(ignorenulls)`` window finds the
   latest right time at or before each left time.
4. Left keys without a match in their own slice take the latest right time
   of an earlier slice of the entity. That comes from a summary with one row
   per (entity, slice), so the per-entity window runs over at most
   #partitions rows.
5. Equi-joins bring back the right values (by entity and matched time) and
   the left rows (by entity and time). AQE splits skewed join partitions.

Ties: a right row at exactly the left time qualifies; among right rows with
equal entity and time, the one with the greatest ``order_by`` value wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def asof_join(left: DataFrame, right: DataFrame, by: str | list[str],
              left_time: str, right_time: str, right_cols: list[str],
              order_by: list[str] | None = None, prefix: str = "",
              partitions: int | None = None) -> DataFrame:
    """Left join each ``left`` row to the latest ``right`` row with equal
    ``by`` and ``right_time <= left_time``.

    Output: all left columns, then ``prefix + c`` for ``c`` in ``right_cols``
    (NULL when nothing qualifies; NULL entity or time never matches).
    ``partitions`` sets the number of range slices (default: the session's
    shuffle partitions, adjusted by AQE).
    """
    by = [by] if isinstance(by, str) else list(by)
    order_by = list(order_by or [])
    t, side, sl = "__t", "__side", "__slice"

    # 1. one right row per (entity, time): the tie winner carries the values
    r = right.where(F.col(right_time).isNotNull())
    for c in by:
        r = r.where(F.col(c).isNotNull())
    win = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                         *[F.col(c).alias(f"__v{i}") for i, c in enumerate(right_cols)]))
    rk = (r.groupBy(*by, F.col(right_time).cast("timestamp").alias(t))
          .agg(win.alias("__w")))
    lk = left.select(*by, F.col(left_time).cast("timestamp").alias(t)).distinct()
    lk = lk.where(F.col(t).isNotNull())
    for c in by:
        lk = lk.where(F.col(c).isNotNull())

    # 2. range slices over the key union (features sort before reads at equal time)
    keys = rk.select(*by, t, F.lit(0).alias(side)).unionByName(
        lk.select(*by, t, F.lit(1).alias(side)))
    ranged = (keys.repartitionByRange(partitions, *by, t, side) if partitions
              else keys.repartitionByRange(*by, t, side))
    shared_dir(keys.sparkSession)
    keys = ranged.withColumn(sl, F.spark_partition_id()).checkpoint(eager=True)

    # 3. in-slice match
    w = (Window.partitionBy(*by, sl).orderBy(t, side)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = keys.withColumn("__m", F.last(F.when(F.col(side) == 0, F.col(t)), ignorenulls=True).over(w))
    reads = scanned.where(F.col(side) == 1).select(*by, t, sl, "__m")

    # 4. carry from earlier slices of the same entity
    last_in_slice = (keys.where(F.col(side) == 0).groupBy(*by, sl)
                     .agg(F.max(t).alias("__last")))
    need = reads.where(F.col("__m").isNull()).select(*by, sl).distinct()
    wc = (Window.partitionBy(*by).orderBy(sl, "__k")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (last_in_slice.withColumn("__k", F.lit(1))
             .unionByName(need.withColumn("__k", F.lit(0))
                              .withColumn("__last", F.lit(None).cast("timestamp")))
             .withColumn("__c", F.last("__last", ignorenulls=True).over(wc))
             .where(F.col("__k") == 0).select(*by, sl, "__c"))
    matched = (reads.join(carry, [*by, sl], "left")
               .select(*by, t, F.coalesce("__m", "__c").alias("__rt")))

    # 5. values of the matched right row, then back to every left row
    vals = matched.join(rk.withColumnRenamed(t, "__rt"), [*by, "__rt"], "left") \
                  .select(*by, t, "__w")
    # Rows without a key match nothing. A salt deals them out evenly: by the
    # key alone they would all hash to one task.
    keyed = F.col(t).isNotNull()
    for c in by:
        keyed = keyed & F.col(c).isNotNull()
    salt = F.when(keyed, F.lit(0)).otherwise(F.monotonically_increasing_id() % 4096 + 1)
    rows = left.withColumn(t, F.col(left_time).cast("timestamp")).withColumn("__salt", salt)
    out = rows.join(vals.withColumn("__salt", F.lit(0).cast("long")), [*by, t, "__salt"], "left")
    return out.select(*left.columns,
                      *[F.col(f"__w.__v{i}").alias(prefix + c) for i, c in enumerate(right_cols)])
