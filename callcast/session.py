"""Session helpers.

The library never owns the session in production: jobs take the caller's
``SparkSession``.  ``build_session`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(
    app_name: str = "callcast",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
) -> SparkSession:
    """Local session with the settings the tests and the bench rely on."""
    builder = (
        SparkSession.builder.appName(app_name)
        .master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when it is unset (local
    tests) a private scratch folder is created and registered, so a cluster run
    never falls back to a machine-local folder silently.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="callcast-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet (with writer ``options``) under the checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads the files instead of recomputing
    the whole plan) and gives later jobs column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return spark.read.parquet(path)


_MADE: ContextVar[list | None] = ContextVar("callcast_made", default=None)


@contextmanager
def disposable(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread's ``materialize`` writes inside are removed at the end; what is needed later is collected, or ``written``."""
    made: list = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        discard(spark, *made)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send Python at most ``rows`` rows a batch; for rows of many kilobytes each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def described(spark: SparkSession, text: str, tag: str | None = None) -> Iterator[None]:
    """Jobs started inside carry a description and a tag (``cancel`` stops all jobs of a tag); both are taken back, also after an error.

    Descriptions belong to the calling thread and its children, so concurrent work keeps its own.
    """
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.job.description")
    new = tag is not None and tag not in sc.getJobTags()
    sc.setJobDescription(text)
    if new:
        sc.addJobTag(tag)
    try:
        yield
    finally:
        sc.setJobDescription(before)
        if new:
            sc.removeJobTag(tag)


def cancel(spark: SparkSession, tag: str) -> None:
    """Stop every running job of a tag."""
    spark.sparkContext.cancelJobsWithTag(tag)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize``, and the path, for tables that ``discard`` removes later."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove intermediate tables that a later table has replaced (nothing may still read them).

    The JVM collects its garbage once, so that Spark's cleaner also drops the shuffle files of
    plans that nobody holds any more.
    """
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    gc.collect()
    spark._jvm.System.gc()


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``callcast`` importable in Python workers (like ``--py-files``).

    Needed only by operators that run Python on executors (pandas UDFs,
    ``mapInPandas``).  Zips the installed package once per SparkContext.
    """
    import shutil

    import callcast

    key = spark.sparkContext.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(callcast.__file__))
    out = tempfile.mkdtemp(prefix="callcast-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(out, "callcast"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="callcast"
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(key)
