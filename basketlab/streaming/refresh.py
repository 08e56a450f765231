"""Incremental feature refresh driven by arriving raw invoice files.

The reference refreshes the feature table once a day when an HTTP request
arrives, for the customers with raw lines "today". Here new raw files landing
in a directory drive the same work through Structured Streaming: every
micro-batch is cleaned and appended to the curated table, and the customers
in the batch are the active set of a feature refresh. ``availableNow``
processes whatever has arrived and stops, which is the daily-trigger shape.

Exactly-once: the stream's checkpoint (in the shared folder) tracks consumed
files. Each batch writes its curated rows into its own folder
(``batch_id=N``), so a replayed batch overwrites its files instead of
appending them twice. The feature-table version that a batch produces is
committed together with the batch id, so a batch that is replayed after a
failure is applied at most once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, prepare, store
from ..schemas import RAW
from ..sources import tables
from ..sources.versioned import VersionedTable


BATCH_NOTE = "batch="


def applied_batch(vt: VersionedTable) -> int:
    """Id of the last stream batch committed into the table (-1 if none)."""
    return _applied(vt)[0]


def _applied(vt: VersionedTable) -> tuple[int, str | None]:
    """(batch id, processing day) of the last committed batch."""
    note = vt.current_note()
    if not note or not note.startswith(BATCH_NOTE):
        return -1, None
    batch, _, day = note[len(BATCH_NOTE):].partition(" day=")
    return int(batch), day or None


def _process(spark: SparkSession, curated_path: str, table_root: str, at, key, mode, rules, as_of=None):
    vt = VersionedTable(spark, table_root)

    def fn(batch: DataFrame, batch_id: int) -> None:
        last, last_day = _applied(vt)
        if batch_id <= last:
            return                                   # replayed batch: already applied
        day = str(as_of if as_of is not None else store.today())
        # Read twice (curated rows, active set): keep it for this batch only.
        # A lost executor's blocks are recomputed from the batch's files.
        batch = batch.persist()
        try:
            # Rows dated after the day stay in the curated table (the file is
            # consumed and won't come again); every read cuts them off.
            cur = clean.curate(batch, None, rules, cut_off=False)
            tables.write_partitioned(cur, f"{curated_path}/batch_id={batch_id}", "InvoiceDate", atomic=False,
                                     mode="replace")
            rows = tables.read_until(tables.read_table(spark, curated_path, RAW), "InvoiceDate", day)
            typed = prepare.cast_trusted(rows)
            seen = batch.where((F.col("InvoiceDate") <= F.lit(day).cast("date")) & F.col("CustomerID").isNotNull())
            if last_day is not None and last_day < day:
                # Earlier rows whose date has come since the last batch.
                seen = seen.select("CustomerID").unionByName(
                    rows.where(F.col("InvoiceDate") > F.lit(last_day).cast("date")).select("CustomerID"))
            active = seen.select(F.col("CustomerID").cast("bigint").alias("CustomerID")).distinct()
            note = f"{BATCH_NOTE}{batch_id} day={day}"
            if not vt.exists():
                store.build_feature_table(vt, typed, at, key, note=note)
            else:
                store.refresh_for(vt, typed, active, at, key, mode, note=note)
        finally:
            batch.unpersist()
    return fn


def start_refresh_stream(spark: SparkSession, landing_dir: str, curated_path: str,
                         table_root: str, checkpoint: str, at=None, key: str = "uuid",
                         mode: str = "append", rules: clean.Rules = clean.Rules(),
                         available_now: bool = True, max_files_per_trigger: int | None = None, as_of=None):
    """Start the stream; returns the ``StreamingQuery``. ``as_of`` is the
    processing day (default: today).

    ``checkpoint`` and ``table_root`` belong together: the table records the
    last applied batch id of *this* checkpoint's numbering, so a new
    checkpoint (batch ids from 0 again) needs a new table root."""
    reader = spark.readStream.schema(RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(landing_dir)
    w = (src.writeStream.foreachBatch(_process(spark, curated_path, table_root, at, key, mode, rules, as_of))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")
    return w.start()
