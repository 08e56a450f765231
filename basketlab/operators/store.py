"""Offline feature store on plain Spark tables.

* The *feature table* holds one row per computed customer feature vector plus
  an entity key (``values``) and a feature time (``timestamp``). It is a
  ``VersionedTable``: every build or refresh writes a complete next version,
  so a table is never overwritten while it is being read.
* The *feature store* is an append-only log of ingested rows, partitioned by
  ingest date, with typed columns whose descriptions and labels are kept in
  the column metadata (it survives parquet) and in a small registry file.
* Serving reads the log as of each instance's time (``asof.asof_join``).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENTITY_COL, FEATURE_COLUMNS, FEATURE_REGISTRY, SPARK_TYPES, TIME_COL
from ..session import list_dirs, list_files, path_exists, read_text, shared_dir, write_text
from ..sources.versioned import VersionedTable
from .asof import asof_join
from .features import active_customers, customer_features

VERSION_COL = "_version"   # version in which a row was appended


def time_col(at) -> Column:
    """Feature time: a fixed instant, or the current timestamp."""
    if at is None:
        return F.current_timestamp()
    if isinstance(at, Column):
        return at
    return F.lit(str(at)).cast("timestamp")


def entity_key(kind: str, at: Column, version: Column) -> Column:
    """``uuid``: random, as the reference does (materialise by writing once).
    ``hash``: reproducible from customer, feature time and append version."""
    if kind == "uuid":
        return F.expr("uuid()")
    if kind == "hash":
        return F.sha2(F.concat_ws("|", F.col("CustomerID").cast("string"),
                                  F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
                                  version.cast("string")), 256)
    raise ValueError(f"unknown key kind {kind!r}")


def stamp(features: DataFrame, at=None, key: str = "uuid", version: int = 1) -> DataFrame:
    """K1: add entity key, feature time and append version to feature rows."""
    t = time_col(at)
    v = F.lit(version)
    return features.select(*FEATURE_COLUMNS, entity_key(key, t, v).alias(ENTITY_COL),
                           t.alias(TIME_COL), v.alias(VERSION_COL))


def active_set(raw: DataFrame, day) -> DataFrame:
    """Distinct, non-null customers active on ``day`` as BIGINT keys."""
    return (active_customers(raw, day).where(F.col("CustomerID").isNotNull())
            .select(F.col("CustomerID").cast("bigint").alias("CustomerID")).distinct())


def semi_active(df: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of ``df`` whose customer is in ``active`` (a semi-join; works
    for an empty set, a single customer, and ignores NULL)."""
    return df.join(active, "CustomerID", "left_semi")


def restamp(table: DataFrame, active: DataFrame, at=None, key: str = "uuid") -> DataFrame:
    """Rows of active customers get a new key and time; others unchanged.

    ``active`` has one row per customer, so the flagging left join never
    multiplies rows.
    """
    t = time_col(at)
    flag = active.select("CustomerID", F.lit(True).alias("__hit"))
    j = table.join(flag, "CustomerID", "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    new_key = entity_key(key, t, F.col(VERSION_COL))
    return j.select(*FEATURE_COLUMNS,
                    F.when(hit, new_key).otherwise(F.col(ENTITY_COL)).alias(ENTITY_COL),
                    F.when(hit, t).otherwise(F.col(TIME_COL)).alias(TIME_COL),
                    F.col(VERSION_COL))


def build_feature_table(table: VersionedTable, typed: DataFrame, at=None,
                        key: str = "uuid", note: str | None = None) -> int:
    """K1 full build: features of every customer, stamped, written once
    (fails if the table exists). ``note`` is committed with the version."""
    return table.write(stamp(customer_features(typed), at, key, version=1), mode="fail", note=note)


def refresh_features(table: VersionedTable, typed: DataFrame, raw: DataFrame, day,
                     at=None, key: str = "uuid", mode: str = "append",
                     anchor: str = "active") -> int | None:
    """K2 incremental build for customers active on ``day``.

    Features are those of the active customers' lines alone, so the recency
    anchor is that of the restricted frame, as in the reference; the lines are
    aggregated first and restricted by customer then. ``append``: the new rows are added and every row of an
    active customer gets a new key and time (duplicates kept). ``upsert``:
    active customers keep only their new row. An empty active set is a no-op
    (returns None). ``anchor='all'`` measures recency against the latest date
    of the whole input instead of the active customers' rows.
    """
    return refresh_for(table, typed, active_set(raw, day), at, key, mode, anchor)


def refresh_for(table: VersionedTable, typed: DataFrame, active: DataFrame, at=None,
                key: str = "uuid", mode: str = "append", anchor: str = "active",
                note: str | None = None) -> int | None:
    """K2 for an explicit active set (one BIGINT ``CustomerID`` per row).
    ``note`` is committed with the new version. The active set, small next to
    the lines it comes from, is checkpointed once for its three uses."""
    shared_dir(active.sparkSession)
    active = active.checkpoint(eager=True)
    if active.isEmpty():
        return None
    if anchor not in ("active", "all"):
        raise ValueError(f"unknown anchor {anchor!r}")
    whole = typed.agg(F.max("InvoiceDate")).scalar() if anchor == "all" else None
    return replace_active(table, customer_features(typed, whole, only=active), active, at, key, mode, note)


def replace_active(table: VersionedTable, new_features: DataFrame, active: DataFrame, at=None, key: str = "uuid",
                   mode: str = "append", note: str | None = None) -> int:
    """The next version of the feature table: with the new feature rows of the
    active customers (``mode`` as in ``refresh_features``)."""
    new_rows = stamp(new_features, at, key, version=(table.current_version() or 0) + 1)
    old = table.read()
    if mode == "upsert":
        old = old.join(active, "CustomerID", "left_anti")
        combined = old.unionByName(new_rows)
    elif mode == "append":
        combined = restamp(old.unionByName(new_rows), active, at, key)
    else:
        raise ValueError(f"unknown refresh mode {mode!r}")
    return table.write(combined, mode="replace", note=note)


def with_customer(served: DataFrame, feature_table: DataFrame) -> DataFrame:
    """Bring CustomerID back to served rows or predictions (the served
    training set carries only the entity key): equi-join on the key, which is
    unique per feature-table row."""
    return served.join(feature_table.select(ENTITY_COL, "CustomerID"), ENTITY_COL, "left")


def read_instances(feature_table: DataFrame) -> DataFrame:
    """K6: the (entity, time) pairs to serve."""
    return feature_table.select(ENTITY_COL, TIME_COL)


class FeatureStore:
    """K3/K4/K5/K7: an entity type with registered, typed features."""

    def __init__(self, spark: SparkSession, root: str, entity: str = ENTITY_COL,
                 time: str = TIME_COL):
        self.spark = spark
        self.root = root.rstrip("/")
        self.entity = entity
        self.time = time

    @property
    def registry_dir(self) -> str:
        """Registry states ``000001.json``, ...: the newest counts. A change
        adds a file under a new name, so a reader always sees a whole state."""
        return f"{self.root}/_registry"

    def _states(self) -> list[str]:
        return sorted(n for n in list_files(self.spark, self.registry_dir) if n[:6].isdigit() and n.endswith(".json"))

    def _save(self, registry: dict) -> None:
        last = int(self._states()[-1][:6]) if self.exists() else 0
        write_text(self.spark, f"{self.registry_dir}/{last + 1:06d}.json", json.dumps(registry))

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def exists(self) -> bool:
        return bool(self._states())

    def get_or_create(self) -> "FeatureStore":
        """K3: create the (empty) registry only if absent."""
        if not self.exists():
            self._save({"entity": self.entity, "time": self.time, "features": []})
        return self

    def registry(self) -> dict:
        states = self._states()
        return json.loads(read_text(self.spark, f"{self.registry_dir}/{states[-1]}")) if states else {"features": []}

    def register(self, features=FEATURE_REGISTRY) -> T.StructType:
        """K4: register (name, type, description, labels); existing names are
        kept, new ones added. Returns the typed schema with metadata."""
        reg = self.get_or_create().registry()
        known = {f["name"] for f in reg["features"]}
        for name, vtype, desc, labels in features:
            if name not in known:
                reg["features"].append({"name": name, "value_type": vtype,
                                        "description": desc, "labels": labels})
        if reg != self.registry():
            self._save(reg)
        return self.schema()

    def schema(self) -> T.StructType:
        reg = self.registry()
        return T.StructType([
            T.StructField(f["name"], SPARK_TYPES[f["value_type"]], True,
                          {"description": f["description"], "labels": f["labels"],
                           "value_type": f["value_type"]})
            for f in reg["features"]])

    def ingest(self, df: DataFrame, feature_ids=None, ingest_date=None,
               batch: str | None = None) -> str:
        """K5: append rows (entity, time, features cast to registered types)
        to the log, partitioned by ingest date and ingest batch. An ingest
        sequence number orders rows with equal entity and time (later ingest
        wins).

        ``batch`` names the source (e.g. the feature-table version). Each
        batch owns one folder that is written with overwrite, so ingesting
        the same batch again after a failure replaces it instead of adding
        the rows twice. Without ``batch`` a fresh id is used (plain append).
        Returns the batch id."""
        sch = self.schema()
        fields = [f for f in sch.fields if feature_ids is None or f.name in feature_ids]
        day = _dt.date.fromisoformat(str(ingest_date)) if ingest_date is not None else today()
        batch = f"b-{batch}" if batch is not None else f"b-{uuid.uuid4().hex}"
        out = df.select(
            F.col(self.entity).cast("string").alias(self.entity),
            F.col(self.time).cast("timestamp").alias(self.time),
            *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in fields],
            F.current_timestamp().alias("_ingested_at"),
            F.monotonically_increasing_id().alias("_ingest_seq"))
        out.write.mode("overwrite").parquet(
            f"{self.log_path}/_ingest_date={day.isoformat()}/_ingest_batch={batch}")
        return batch

    def ingested_versions(self) -> list[int]:
        """Feature-table versions in the log, ascending."""
        days = [d for d in list_dirs(self.spark, self.log_path) if d.startswith("_ingest_date=")]
        names = {b.split("b-v")[-1] for d in days for b in list_dirs(self.spark, f"{self.log_path}/{d}")
                 if b.startswith("_ingest_batch=b-v") and path_exists(self.spark, f"{self.log_path}/{d}/{b}/_SUCCESS")}
        return sorted(int(n) for n in names if n.isdigit())

    def ingest_version(self, table: VersionedTable, version: int | None = None, ingest_date=None) -> str:
        """K5 for a versioned feature table: the log gets the rows that it
        doesn't hold yet, new or restamped, recognised by their entity key (a
        restamped row has a new one). That doesn't depend on which versions of
        the table are still there, nor on how many were passed over. Ingesting
        a version again replaces its batch."""
        v = table.current_version() if version is None else version
        rows, batch = table.read(v), f"b-v{v:06d}"
        days = list_dirs(self.spark, self.log_path)
        other = False
        for day in days:
            for name in list_dirs(self.spark, f"{self.log_path}/{day}"):
                if name == f"_ingest_batch={batch}":
                    ingest_date = day.split("=")[1]  # a re-run on a later day keeps the first day
                else:
                    other = other or path_exists(self.spark, f"{self.log_path}/{day}/{name}/_SUCCESS")
        if other:
            held = self.log().filter(F.col("_ingest_batch") != batch).select(self.entity)
            rows = rows.join(held, self.entity, "left_anti")
        return self.ingest(rows, ingest_date=ingest_date, batch=batch[2:])

    def log(self) -> DataFrame:
        return self.spark.read.parquet(self.log_path)

    def serve(self, instances: DataFrame, features="*") -> DataFrame:
        """K7: for each (entity, time) instance, the latest ingested feature
        values at or before that time; ``"*"`` serves every registered feature."""
        names = [f.name for f in self.schema().fields]
        if features != "*" and features != ["*"]:
            names = [n for n in names if n in set(features)]
        return asof_join(instances, self.log(), self.entity, self.time, self.time, names,
                         order_by=["_ingested_at", "_ingest_seq"])


def today() -> _dt.date:
    return _dt.datetime.now(_dt.timezone.utc).date()
