"""Session defaults and the written tables that cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", app: str = "brevia") -> SparkSession:
    """A session for tests and the bench. A cluster job brings its own."""
    return ship(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BREVIA_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # hash joins instead of sorts where every measured partition is small
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the Python workers, once for each application.

    Functions run there are pickled by reference, so the workers must import it
    wherever the driver was started.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        archive = os.path.join(tempfile.mkdtemp(prefix="brevia-package-"), f"{root.name}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would not survive a lost executor.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brevia-checkpoint-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark)}/{app}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files.

    Else these stay until the driver's JVM happens to collect its garbage, so the rounds of a
    fit pile up on the executors' disks.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def as_dealt(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside need no exchange where both sides are dealt by one of their keys.

    By default Spark deals both sides anew by all keys, lest one key hold many rows.
    """
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_PARTITION, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Unlike a block kept by an executor the table outlives executors, and its file
    sizes let the planner pick broadcast joins by measured size. Nothing reads the shuffle
    files of the written query again, so they go with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[id(out)] = (weakref.ref(out), path)
    return out


def bucketed(df: DataFrame, by: str, n: int, name: str, dealt: bool = False) -> DataFrame:
    """:func:`materialise` as a table of ``n`` buckets, which joins and groups by ``by`` read as they lie.

    With more keys than ``by`` a join reads them so inside :func:`as_dealt` only. Rows that are ``dealt`` by
    bucket already, though the plan does not show it, are written by the tasks that have them.
    """
    spark = df.sparkSession
    name = name.replace("-", "_")
    table = f"{name}_{uuid.uuid4().hex}"
    with shuffles_removed(spark), as_dealt(spark):
        writer = (df if dealt else df.repartition(n, by)).write.bucketBy(n, by).option("compression", "lz4_raw" if dealt else "zstd")
        path = scratch_path(spark, name)
        writer.option("path", path).saveAsTable(table)
    out = scanned(spark.table(table))
    _buckets[id(out)] = (weakref.ref(out), n)
    _written[id(out)] = (weakref.ref(out), path)
    return out


def buckets(df: DataFrame) -> int:
    """The number of buckets of a table of :func:`bucketed`."""
    known, n = _buckets.get(id(df), (None, 0))
    if known is None or known() is not df:
        raise ValueError("not a table in buckets")
    return n


_buckets: dict[int, tuple[weakref.ref, int]] = {}


def observed(
    df: DataFrame, name: str, metrics: dict[str, Column], n: int = 0, dealt: bool = False
) -> tuple[DataFrame, dict]:
    """Write ``df``, in ``n`` buckets of its block if given, and return it with aggregates taken on the way."""
    seen = Observation()
    df = df.observe(seen, *[c.alias(name) for name, c in metrics.items()])
    return bucketed(df, "block", n, name, dealt) if n else materialise(df, name), seen.get


_written: dict[int, tuple[weakref.ref, str]] = {}


_scans: dict[int, weakref.ref] = {}


def scanned(df: DataFrame) -> DataFrame:
    """Says that ``df`` is a plain scan of written files, or columns of one."""
    _scans[id(df)] = weakref.ref(df)
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` itself if it is a table of :func:`materialise` or :func:`scanned`, else its copy."""
    known = _scans.get(id(df)) or _written.get(id(df), (None,))[0]
    return df if known is not None and known() is df else materialise(df, name)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``materialise`` or ``bucketed`` that nothing will read any more."""
    for df in tables:
        known, path = _written.pop(id(df), (None, None))
        if known is not None and known() is df:
            context = df.sparkSession.sparkContext
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
