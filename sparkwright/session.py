"""Session set-up, table loading and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


TEXT_PARTITIONS = "spark.sparkwright.textPartitions"
KEYED_ROWS = 8192


def get_spark(app: str = "sparkwright", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitter sets these."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(TEXT_PARTITIONS, str(partitions))
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows cost much CPU. Where the session sets a number of text partitions
    (as a local one does, whose small files are single splits) the rows are dealt to that
    many by key; otherwise they stay where they are."""
    df = load(spark, sf_dir, name)
    parts = spark.conf.get(TEXT_PARTITIONS, None)
    return df.repartition(int(parts), key) if parts else df


def load_texts_by_key(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """The same rows, those of one key always in one partition: words taken from the texts
    are then grouped by the key where they are, and what crosses the network is each text
    once, not each of its words. A partition has about ``KEYED_ROWS`` rows."""
    df = load(spark, sf_dir, name)
    least = int(spark.conf.get(TEXT_PARTITIONS, None) or spark.sparkContext.defaultParallelism)
    return df.repartition(max(least, -(-df.count() // KEYED_ROWS)), key)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local temporary folder stands in only for a local master, where
    driver and executors share one file system.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="sparkwright-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the scratch root, never used before."""
    return os.path.join(scratch_root(spark), f"{tag}-{uuid.uuid4().hex}")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING, _CLEANERS = threading.Lock(), {"n": 0, "before": None}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed in here leaves no shuffle files: otherwise they stay until the
    driver happens to collect its garbage. Threads may be in here together."""
    with _CLEANING:
        if not _CLEANERS["n"]:
            _CLEANERS["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _CLEANERS["n"] += 1
    try:
        yield
    finally:
        with _CLEANING:
            _CLEANERS["n"] -= 1
            if not _CLEANERS["n"]:
                spark.conf.set(SHUFFLE_CLEANUP, _CLEANERS["before"])


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage through a table in the scratch folder, so a lost executor
    re-reads files instead of re-running the plan."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that functions
    run there can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="sparkwright-"), "sparkwright")
    archive = shutil.make_archive(
        base, "zip", root_dir=os.path.dirname(package), base_dir=os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
