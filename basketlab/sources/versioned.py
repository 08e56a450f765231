"""Versioned tables: replace a table from itself without overwriting its input.

Spark's parquet tables cannot be overwritten while being read in the same job
(and have no UPDATE/MERGE). A versioned table keeps ``v=000001``,
``v=000002``… under its root. A rewrite writes the next version completely,
then commits it by creating a ``_COMMITTED`` marker inside the version folder
(a new file name, so the commit is one atomic create/rename; nothing is
deleted or replaced). The current version is the newest committed one.
Readers of older versions are unaffected; a version whose job failed has no
marker, is never read, and is overwritten by the next attempt, so a re-run
after an executor or driver loss is safe.

The marker can carry a short note (for example the id of the stream batch
that produced the version). It is committed with the version itself, so
"version written" and "batch applied" can never disagree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, list_dirs, path_exists, read_text, write_text

MARKER = "_COMMITTED"


class VersionedTable:
    """``keep`` committed versions stay (at least 1; None: all). Older ones
    are retired after a commit, so a reader of the version before last has
    ``keep - 1`` further writes' time to finish."""

    def __init__(self, spark: SparkSession, root: str, keep: int | None = None):
        if keep is not None and keep < 1:
            raise ValueError("keep must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:06d}"

    def marker(self, version: int) -> str:
        return f"{self.path(version)}/{MARKER}"

    def _versions(self) -> list[int]:
        """Version folders present (committed or not), newest first."""
        names = list_dirs(self.spark, self.root)
        return sorted((int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()),
                      reverse=True)

    def current_version(self) -> int | None:
        for v in self._versions():
            if path_exists(self.spark, self.marker(v)):
                return v
        return None

    def current_note(self) -> str | None:
        """The note committed with the current version (None if none)."""
        v = self.current_version()
        if v is None:
            return None
        txt = (read_text(self.spark, self.marker(v)) or "").strip()
        return txt or None

    def exists(self) -> bool:
        return self.current_version() is not None

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"versioned table {self.root} has no version")
        return self.spark.read.parquet(self.path(v))

    def write(self, df: DataFrame, mode: str = "replace", note: str | None = None,
              partition_by: str | None = None) -> int:
        """Write ``df`` as the next version. ``mode='fail'`` refuses when a
        version exists; ``'append'`` writes old ∪ new as the next version.
        ``note`` (one line) is committed together with the version."""
        cur = self.current_version()
        if mode == "fail" and cur is not None:
            raise FileExistsError(f"versioned table {self.root} already exists")
        if mode == "append" and cur is not None:
            df = self.read(cur).unionByName(df)
        # Above every folder present: a failed attempt's leftovers are never
        # mixed with new files, and a reader never sees a half-written version.
        nxt = max([cur or 0, *self._versions()]) + 1
        df.write.mode("overwrite").parquet(self.path(nxt), partitionBy=partition_by)
        write_text(self.spark, self.marker(nxt), note or "")
        self.retire()
        return nxt

    def committed(self) -> list[int]:
        """Committed versions, newest first."""
        return [v for v in self._versions() if path_exists(self.spark, self.marker(v))]

    def retire(self) -> list[int]:
        """Delete committed versions beyond the newest ``keep``: the marker
        first, so a half-deleted version is never read. Returns them."""
        old = self.committed()[self.keep:] if self.keep else []
        for v in old:
            delete_path(self.spark, self.marker(v))
            delete_path(self.spark, self.path(v))
        return old
