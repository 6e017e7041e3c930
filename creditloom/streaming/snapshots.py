"""New, late and corrected snapshot files, loaded once each.

A manifest table remembers every file version that was loaded: path, modification time
and length. A call lists the folder, takes the files whose version the manifest does not
have, however old they are, and replaces the snapshots they belong to. The manifest is
written last, so a call that fails is simply repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.audit import AuditLog
from creditloom.operators.rows import union_aligned
from creditloom.plans.cleaning import clean_credit_snapshot, quarantine_credit
from creditloom.settings import Settings
from creditloom.sources import scans, sinks

VERSION = "path string, modified timestamp, length bigint, snapshot_date date"


def listed_files(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """Version and snapshot date of every matching file; names only, no content is read."""
    name = F.element_at(F.split("path", "/"), -1)
    day = scans.snapshot_date_of(name, settings.snapshot_pattern, settings.snapshot_format)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", settings.snapshot_glob)
        .load(folder)
        .select("path", F.col("modificationTime").alias("modified"), "length", day.alias("snapshot_date"))
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Versions loaded so far; none before the first load."""
    # an empty append makes the folder, so that the first read finds one
    spark.createDataFrame([], VERSION).write.mode("append").parquet(path)
    return spark.read.schema(VERSION).parquet(path)


def ingest_new_snapshots(
    spark: SparkSession,
    folder: str,
    layer: str,
    checkpoint: str,
    settings: Settings | None = None,
    *,
    quarantine: str | None = None,
    audit: str | None = None,
    days_per_batch: int = 20,
) -> list[dt.date]:
    """Bring the staging layer up to date with the folder; gives the reloaded snapshots.

    ``checkpoint`` holds the manifest. All files of a snapshot are read again when one of
    them is new or changed, ``days_per_batch`` snapshots at a time. Rows that lose their
    key go to ``quarantine``, row counts to ``audit``. A file that was deleted leaves its
    snapshot as it is.
    """
    settings = settings or Settings()
    listed = listed_files(spark, folder, settings)
    fresh = listed.join(manifest(spark, checkpoint), ["path", "modified", "length"], "left_anti")
    days = [r[0] for r in fresh.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    for first in range(0, len(days), days_per_batch):
        batch = days[first : first + days_per_batch]
        files = listed.filter(F.col("snapshot_date").isin(batch)).collect()
        _load(spark, sorted(r.path for r in files), layer, settings, quarantine, audit)
        spark.createDataFrame(files, VERSION).coalesce(1).write.mode("append").parquet(checkpoint)
    return days


def _load(spark, paths, layer, settings, quarantine, audit) -> None:
    frames = scans.scan_snapshot_files(spark, paths, settings.snapshot_pattern, settings.snapshot_format)
    log = AuditLog(f"ingest-{len(paths)}-files")
    with log.step("late_credit"):
        counted = [log.watch(f, "late_credit", "in_rows") for f in frames]
        cleaned = union_aligned([clean_credit_snapshot(f) for f in counted])
        _replace(log.watch(cleaned, "late_credit", "out_rows"), layer)
        if quarantine:
            losers = union_aligned([quarantine_credit(f) for f in frames])
            _replace(log.watch(losers, "late_credit", "rejected_rows"), quarantine)
    if audit:
        log.append_to(spark, audit)


def _replace(frame: DataFrame, path: str) -> None:
    sinks.write_layer(frame, path, partition_by="snapshot_date", keep_other_partitions=True)
