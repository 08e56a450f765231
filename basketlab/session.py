"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job in this library relies on. AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def get_session(master: str | None = None, app: str = "basketlab",
                conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's base settings.

    ``master`` is only set when given, so on a cluster the submitter decides.
    Settings already present on an existing session win over BASE_CONF
    except the time zone, which the date logic depends on.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (what
    ``--py-files`` does): zip its sources once per application and hand the
    zip to ``addPyFile``, which distributes it to every executor. Needed
    before grouped Python jobs whose functions refer to package modules."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="basketlab-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset on a ``local`` master (tests)
    a private directory is created and registered, so ``checkpoint()`` works
    too. On a cluster an unset folder is an error: a machine-local folder
    would not survive the loss of the executor that wrote it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder "
                               "(HDFS / object store) for checkpoints and scratch tables")
        d = tempfile.mkdtemp(prefix="basketlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for intermediate tables.

    The path is deleted when the driver process exits: results read from it
    lazily stay readable for the whole session, and no scratch copy outlives
    the application."""
    base = shared_dir(spark)
    path = f"{base}/basketlab/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    if not _SCRATCH:
        atexit.register(_drop_scratch)
    _SCRATCH.append((jvm, hconf, path))
    return path


_SCRATCH: list = []


def _drop_scratch() -> None:
    """Delete this process's scratch paths (atexit; the JVM is still up, as
    this handler was registered after the session started)."""
    while _SCRATCH:
        jvm, hconf, path = _SCRATCH.pop()
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hconf).delete(p, True)
        except Exception:  # noqa: BLE001 - best effort at exit
            pass


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem API (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(hconf).exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a small text file under a NEW name, any FS scheme: written aside
    and renamed, so it appears whole or not at all. Nothing is replaced: an
    existing target is an error."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    tmp = jvm.org.apache.hadoop.fs.Path(path + f".tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
