"""Session settings and the durable scratch area used to cut long lineages."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; keyword settings win."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without that setting; it then gets a folder of its own, which goes
    when the process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app_id = spark.sparkContext.applicationId
    if app_id not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app_id] = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[app_id], ignore_errors=True)
    return _LOCAL_SCRATCH[app_id]


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the writes inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_STORED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame, label: str = "stage", partitions: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder, in folders by ``partitions``, and read it back.

    Used where a later step must see exactly one evaluation (range bounds, partition numbers) or
    where an iterative job would otherwise grow an endless plan. Being a written table, it
    survives the loss of executors. What the write shuffled is deleted with its end, not when the JVM happens to collect it.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path, partitionBy=partitions)
    stored = spark.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the table behind a result of ``materialize`` that no plan reads any more."""
    path = _STORED.pop(stored, None)
    if path is None:
        return
    spark = stored.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
