"""A snapshot layer with versions: late, corrected and deleted files, switched at once.

The rows of a load lie in a folder of their own, ``load=<id>/outcome=<kept|rejected>/
snapshot_date=<day>``. Which load holds a snapshot is told by the manifest only, to which a load
appends one file after its rows are written. So a load that fails is never seen, a reader
sees a batch of snapshots change together, and a snapshot whose files are gone is gone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.audit import AuditLog
from creditloom.operators.rows import union_aligned
from creditloom.plans.cleaning import OUTCOME, SOURCES, sorted_out
from creditloom.settings import Settings
from creditloom.sources import scans
from creditloom.streaming.snapshots import listed_files

MANIFEST = "path string, modified timestamp, length bigint, snapshot_date date, present boolean, generation bigint, load string"


class VersionedSnapshots:
    """The snapshots of a folder of exported files, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings | None = None):
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings or Settings()

    def manifest(self) -> DataFrame:
        """Every version of every file that was loaded, and every deletion; none before the first load."""
        folder = f"{self.path}/manifest"
        # an empty append makes the folder, so that the first read finds one
        self.spark.createDataFrame([], MANIFEST).write.mode("append").parquet(folder)
        return self.spark.read.schema(MANIFEST).parquet(folder)

    def state(self) -> DataFrame:
        """The newest manifest row of each file."""
        columns = [f.strip().split()[0] for f in MANIFEST.split(",")]
        newest = F.max_by(F.struct(*[c for c in columns if c != "path"]), "generation").alias("v")
        return self.manifest().groupBy("path").agg(newest).select("path", "v.*")

    def sync(self, folder: str, *, audit: str | None = None, days_per_batch: int = 20) -> list[dt.date]:
        """Bring the layer up to date with the folder; gives the snapshots that changed.

        A snapshot is read again from all of its files when one of them is new, changed or
        gone. Snapshots without files leave the layer.
        """
        listed, known = listed_files(self.spark, folder, self.settings), self.state()
        held = known.filter("present")
        fresh = listed.join(held, ["path", "modified", "length"], "left_anti").select("snapshot_date")
        gone = held.join(listed, "path", "left_anti")
        days = [r[0] for r in fresh.union(gone.select("snapshot_date")).distinct().orderBy("snapshot_date").collect()]
        after = (known.agg(F.max("generation")).first()[0] or 0) + 1
        for step, first in enumerate(range(0, len(days), days_per_batch)):
            batch = days[first : first + days_per_batch]
            files = listed.filter(F.col("snapshot_date").isin(batch)).collect()
            lost = gone.filter(F.col("snapshot_date").isin(batch)).select(*listed.columns).collect()
            load = f"{after + step:06d}-{uuid.uuid4().hex[:8]}"
            if files:
                self._write(sorted(r.path for r in files), load, audit)
            rows = [(*r, True, after + step, load) for r in files] + [(*r, False, after + step, load) for r in lost]
            # one file, which appears as a whole when it is committed
            self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return days

    def _write(self, paths: list[str], load: str, audit: str | None) -> None:
        s, log = self.settings, AuditLog(f"sync-{load}")
        with log.step("late_credit"):
            frames = scans.scan_snapshot_files(self.spark, paths, s.snapshot_pattern, s.snapshot_format, s.encoding)
            counted = [log.watch(f, "late_credit", "in_rows") for f in frames]
            rows = log.watch(union_aligned([sorted_out(f, SOURCES["credit"]) for f in counted]), "late_credit", "out_rows")
            out = rows.hint("rebalance", OUTCOME, "snapshot_date").write.partitionBy(OUTCOME, "snapshot_date")
            out.parquet(f"{self.path}/data/load={load}")
        if audit:
            log.append_to(self.spark, audit)

    def read(self, outcome: str = "kept") -> DataFrame:
        """The current rows: those that count, or those ``rejected`` for another row of their key.

        Whole folders are chosen while planning. A layer without snapshots raises.
        """
        pointers = self.state().filter("present").groupBy("snapshot_date").agg(F.max_by("load", "generation").alias("load"))
        loads: dict[str, list[dt.date]] = {}
        for row in pointers.collect():  # one row a reporting date
            loads.setdefault(row.load, []).append(row.snapshot_date)
        if not loads:
            raise FileNotFoundError(f"no snapshots in {self.path}")
        chosen = reduce(lambda a, b: a | b, [(F.col("load") == load) & F.col("snapshot_date").isin(days) for load, days in loads.items()])
        data = self.spark.read.option("mergeSchema", True).parquet(f"{self.path}/data")
        return data.filter((F.col(OUTCOME) == outcome) & chosen).drop("load", OUTCOME)
