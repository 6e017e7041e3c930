"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Dates in the data are wall-clock values, so the session zone is pinned. The
# adaptive settings are Spark's defaults; they are named here because the joins
# rely on them to split a hot key and to size partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # recording the Python line of every Column takes longer than all other plan building;
    # switch it on to see those lines in error messages
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # HotSpot does not compile longer methods; Spark then generates several short ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def spark_session(app: str = "creditloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def side_by_side(spark: SparkSession, *works: Callable[[], Any], threads: int = 4) -> list[Any]:
    """Results of independent calls, in order. Small jobs leave cores free, and so does planning.

    All calls end before the first failure, if any, is raised.
    """
    with ThreadPoolExecutor(threads) as pool:
        # threads have the caller's job group and other local properties
        runs = [pool.submit(inheritable_thread_target(spark)(work)) for work in works]
    return [run.result() for run in runs]


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside it, the shuffle files of a query go when the query ends.

    Otherwise they lie on the executors' disks until the driver happens to collect its garbage,
    so that many queries in a row fill the disks. A frame that is run twice shuffles twice.
    """
    before = spark.conf.get(_FREES_SHUFFLES, None)
    spark.conf.set(_FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREES_SHUFFLES)
        else:
            spark.conf.set(_FREES_SHUFFLES, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local-mode session may go
    without that setting, because there the driver's disk is everyone's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="creditloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
