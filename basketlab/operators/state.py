"""Customer features from a stored state and one day's lines.

Every feature is made of sums, counts and extremes, so a day's lines can be
aggregated alone and added to what was known. The state has two parts:

* ``totals``: one merged row per customer, a versioned table;
* days: one row per customer and day. ``base`` holds those of the first
  build, ``day/InvoiceDate=...`` those of each day since. A folder of a day
  replaces what ``base`` knows of that day.

A new day writes its folder and a next version of ``totals``. A day that was
there before (late lines) is opened again: its folder is written anew, and the
totals are added up from the day rows. Lines of other days are never read.
A job that dies after writing a folder leaves totals without it; the same call
again finds the folder, takes the day as opened again, and is right.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_dirs, path_exists, shared_dir
from ..sources.versioned import VersionedTable
from . import features
from .store import active_set, replace_active

DAY = "InvoiceDate"


class CustomerState:
    """The state under ``root``."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.totals = VersionedTable(spark, f"{self.root}/totals", keep=keep)

    @property
    def base(self) -> str:
        return f"{self.root}/base"

    def _folder(self, day) -> str:
        return f"{self.root}/day/{DAY}={_dt.date.fromisoformat(str(day)).isoformat()}"

    def _written(self) -> list[str]:
        """Days with a folder of their own."""
        names = list_dirs(self.spark, f"{self.root}/day")
        return sorted(n.split("=")[1] for n in names if n.startswith(f"{DAY}=")
                      and path_exists(self.spark, f"{self.root}/day/{n}/_SUCCESS"))

    def build(self, typed: DataFrame) -> None:
        """From all lines so far (once)."""
        if self.totals.exists():
            raise FileExistsError(f"state {self.root} already exists")
        rows = features.merged(features.daily_partials(typed).withColumn(DAY, F.col("max_any")), DAY)
        rows.write.mode("overwrite").parquet(self.base)
        self._total(self.days(), "build")

    def days(self) -> DataFrame:
        """One row per customer and day."""
        rows = self.spark.read.parquet(self.base)
        written = self._written()
        if not written:
            return rows
        later = (self.spark.read.schema(rows.schema).option("basePath", f"{self.root}/day")
                 .parquet(*[self._folder(d) for d in written]).select(*rows.columns))
        own = [F.lit(d).cast("date") for d in written]
        return rows.filter(~F.coalesce(F.col(DAY).isin(*own), F.lit(False))).unionByName(later)

    def _total(self, rows: DataFrame, note: str) -> None:
        self.totals.write(features.merged(rows), note=note)

    def knows(self, day) -> bool:
        """Whether lines of ``day`` are in the state already."""
        if str(day) in self._written():
            return True
        return not self.spark.read.parquet(self.base).filter(F.col(DAY) == F.lit(str(day)).cast("date")).isEmpty()

    def update(self, lines: DataFrame, day) -> bool:
        """Add ``day``, from all of its lines (and no others). Returns whether
        the day was opened again."""
        again = self.knows(day)
        own = lines.filter(F.col(DAY) == F.lit(str(day)).cast("date"))
        features.merged(features.daily_partials(own)).write.mode("overwrite").parquet(self._folder(day))
        new = self.spark.read.schema(self.totals.read().schema).parquet(self._folder(day))
        self._total(self.days().drop(DAY) if again else self.totals.read().unionByName(new), f"day {day}")
        return again

    def features(self, active: DataFrame | None = None) -> DataFrame:
        """Feature rows, of all customers or those in ``active`` (one
        ``CustomerID`` a row). The recency anchor is the latest day of the
        customers taken, as in ``customer_features``."""
        rows = self.totals.read()
        if active is not None:
            rows = rows.join(active, "CustomerID", "left_semi")
        return features.from_partials(rows, rows.agg(F.max("max_any")).scalar())


def refresh_from_state(table: VersionedTable, state: CustomerState, lines: DataFrame, raw: DataFrame, day,
                       at=None, key: str = "uuid", mode: str = "append") -> int | None:
    """K2 with a state: add the day's lines to it and refresh the feature
    table for the customers active on ``day``. ``lines`` and ``raw`` need hold
    that day's rows only; the result is ``refresh_features``'s over all of
    them. An empty active set changes the state, but not the table."""
    state.update(lines, day)
    active = active_set(raw, day)
    shared_dir(active.sparkSession)
    active = active.checkpoint(eager=True)
    if active.isEmpty():
        return None
    return replace_active(table, state.features(active), active, at, key, mode)
