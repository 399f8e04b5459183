"""Session settings and the staging of intermediate tables."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the jobs want on a cluster. Everything also runs with Spark's defaults.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Sampled ids filter the corpus before its text is shuffled, also beyond broadcast size.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Fits that run side by side share the executors evenly.
    "spark.scheduler.mode": "FAIR",
}


def build_session(app_name: str = "claimweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the recommended settings; keyword ``conf`` entries use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting uses its warehouse instead; on a cluster the
    folder has to be named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staging"


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path under the application's folder."""
    application = f"claimweave-{spark.sparkContext.applicationId}"
    return f"{staging_root(spark)}/{application}/{name}-{uuid.uuid4().hex}"


# With it a query's shuffle files go when the query ends, not when the driver collects its garbage.
_GIVE_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: WeakKeyDictionary[SparkSession, list] = WeakKeyDictionary()  # writers at work, the setting before the first
_lock = threading.Lock()


@contextmanager
def _shuffles_given_up(spark: SparkSession) -> Iterator[None]:
    with _lock:
        held = _writing.setdefault(spark, [0, None])
        if not held[0]:
            held[1] = spark.conf.get(_GIVE_UP, None)
            spark.conf.set(_GIVE_UP, "true")
        held[0] += 1
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.unset(_GIVE_UP) if held[1] is None else spark.conf.set(_GIVE_UP, held[1])


def append(df: DataFrame, path: str) -> None:
    """Add ``df`` to the table at ``path``; what it shuffled is not needed again and does not stay on disk."""
    with _shuffles_given_up(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage (a lost executor costs only the running tasks), keeps columns
    prunable, and gives the planner the true size, so that it broadcasts the table exactly
    when it is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. All
    tables of an application lie under one folder, to be dropped when its results are stored.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    append(df, path)
    return spark.read.schema(df.schema).parquet(path)


def clear_staging(spark: SparkSession) -> None:
    """Delete the application's staged tables, once all results that read them are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{staging_root(spark)}/claimweave-{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_together(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Run independent steps that submit Spark jobs side by side; their results in order."""
    with ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [f.result() for f in futures]
