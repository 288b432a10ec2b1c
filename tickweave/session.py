"""Session helpers: UTC pinning, shared working folders, a local builder for tests/bench."""

from __future__ import annotations

import atexit
import datetime as dt
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()
#: Scratch folders of this driver; for a written table, a weak reference to what reads it.
_SCRATCH: dict[str, object] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``tickweave`` importable on executors (``addPyFile``), once per
    application: the decoder runs in Python workers
    and is pickled by module reference. Equivalent to ``--py-files``."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tickweave-pyfiles-"), "tickweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join("tickweave", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All bar/slot arithmetic is defined in UTC; pin the session zone (and
    ship the package to the executors' Python workers)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    if not spark.sparkContext.getCheckpointDir():
        checkpoint_root(spark)  # checkpoint() needs it; uses spark.checkpoint.dir when set
    return spark


def utc_micros(t: dt.datetime) -> int:
    """Epoch microseconds of a datetime; naive values are taken as UTC."""
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(round(t.timestamp() * 1_000_000))


def from_utc_micros(us: int) -> dt.datetime:
    """Naive-UTC datetime from epoch microseconds (driver-zone independent)."""
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(us))


def load_time(t: dt.datetime | str | None) -> dt.datetime:
    """The one load time of a batch: ``t`` (text is taken as UTC), or now."""
    if t is None:
        return dt.datetime.now(dt.timezone.utc)
    return dt.datetime.fromisoformat(t) if isinstance(t, str) else t


def ts_lit(t: dt.datetime) -> Column:
    """A timestamp literal that does not depend on the driver's local zone."""
    return F.timestamp_micros(F.lit(utc_micros(t)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every
    executor; without it there, this raises. Only in local mode (tests) is a
    folder made here.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        master = sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tickweave-ckpt-")
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root, deleted when
    the driver's Python ends (results may read it until then)."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_scratch, spark)
    _SCRATCH[path] = None
    return path


def _drop_scratch(spark: SparkSession) -> None:
    try:
        for path in _SCRATCH:
            delete_path(spark, path)
    except Exception:  # noqa: BLE001 - the session may be gone; local folders can still be deleted
        for path in _SCRATCH:
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in a scratch folder and read back: cuts
    the lineage without computing the plan again, as checkpoint() would.

    The table belongs to the frames that read it, like the files of a
    checkpoint: every frame derived from the result shares its file index, and
    once the JVM has collected that index no frame can read the table any more,
    so the next call deletes it (see ``sweep``)."""
    spark = df.sparkSession
    sweep(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return read_tracked(spark, path, df.schema)


def read_tracked(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at a scratch path, which from now on lives as long as what reads it."""
    back = spark.read.schema(schema).parquet(path)
    index = back._jdf.queryExecution().analyzed().relation().location()
    _SCRATCH[path] = spark.sparkContext._jvm.java.lang.ref.WeakReference(index)
    return back


def written_path(back: DataFrame) -> str:
    """The scratch path of a frame that ``written`` returned."""
    return back._jdf.queryExecution().analyzed().relation().options().apply("path")


def sweep(spark: SparkSession) -> None:
    """Delete the written tables that no frame can read any more."""
    for path, reader in list(_SCRATCH.items()):
        if reader is not None and reader.get() is None:
            forget(spark, path)


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders now; for callers that know all their readers to have ended."""
    for path in paths:
        delete_path(spark, path)
        _SCRATCH.pop(path, None)


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_fs(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tickweave") -> SparkSession:
    """Builder used by tests and the bench (single JVM, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # remove checkpoint files once their DataFrame is garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # raw tick files are ~17 KiB each: let one task read many of them
        .config("spark.sql.files.openCostInBytes", str(64 * 1024))
        .config("spark.driver.memory", os.environ.get("TICKWEAVE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark
