"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import contextlib
import contextvars
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings applied to sessions this package creates.  A session handed in by
# a cluster keeps its own values; only the time zone matters for results
# (report timestamps are formatted as UTC wall clock).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "opslog", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The folder holds cut tables, streaming state and sink output that every
    executor must see, so it is never guessed: a session without the setting
    gets an error.  Only a single-process ``local[...]`` session, where driver
    and executors are one JVM, may fall back to a scratch folder.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        cur = tempfile.mkdtemp(prefix="opslog-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (streaming state, cut tables)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


SCRATCH: list[str] = []  # folders of cut tables that this process made and has not released
_MADE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def _jvm_folder(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh scratch folder below the checkpoint folder, deleted when the driver's JVM ends, if not released before."""
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    jpath, fs = _jvm_folder(spark, path)
    fs.deleteOnExit(jpath)
    SCRATCH.append(path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_made():
    """The scratch folders that this thread makes meanwhile, as a list that grows."""
    outer, made = _MADE.get(), []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if outer is not None:
            outer += made


def release_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders whose tables nobody reads any more."""
    for path in [p for p in paths if p in SCRATCH]:
        jpath, fs = _jvm_folder(spark, path)
        fs.delete(jpath, True)
        SCRATCH.remove(path)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession):
    """Shuffle files of a query that runs meanwhile go with its end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    For plans that read one derived table from several branches: the table is
    computed once instead of once per branch, and its lineage is cut (a lost
    executor re-reads the files rather than recomputing the upstream joins).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``opslog`` importable in Python workers (pandas UDFs, mapInPandas, state, data source).

    Workers do not see the driver's ``sys.path``; the package is zipped once per
    SparkContext on the driver and added with ``addPyFile``: executors fetch it
    from the driver, so the zip needs no shared folder.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    path = os.path.join(tempfile.mkdtemp(prefix="opslog-zip-"), "opslog-pkg.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    _SHIPPED.add(key)
