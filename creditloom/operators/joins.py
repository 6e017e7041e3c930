"""Validated joins, the as-of join and set membership."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.operators.dedupe import repeated_keys


def _unique_or_raise(df: DataFrame, keys: Sequence[str], side: str) -> Column:
    """A scalar that is null when keys are unique and raises when they are not.

    Evaluated once, before the join, from the key columns alone. Being a subquery
    it stays out of the join's own plan, so the join keeps its skew handling.
    """
    worst = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
    message = F.concat(
        F.lit(f"join keys {list(keys)} are not unique on the {side} side: up to "),
        F.col("n").cast("string"),
        F.lit(" rows per key"),
    )
    return worst.select(
        F.when(F.coalesce(F.col("n"), F.lit(1)) > 1, F.raise_error(message)).cast("string")
    ).scalar()


def checked_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], validate: str | None = "many_to_one"
) -> DataFrame:
    """Left join that raises when run if ``validate`` (``one_to_one``, ``many_to_one``) is broken.

    ``validate=None`` is for inputs unique by construction, as after a dedupe.
    """
    if validate not in (None, "one_to_one", "many_to_one"):
        raise ValueError(f"unknown validation {validate!r}")
    if validate:
        left_checked = left.filter(_unique_or_raise(right, keys, "right").isNull())
        if validate == "one_to_one":
            left_checked = left_checked.filter(_unique_or_raise(left, keys, "left").isNull())
        left = left_checked
    return left.join(right, list(keys), "left")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness (null counts as a value), with their row count."""
    return repeated_keys(df, keys)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str,
    left_time: Column | str,
    right_time: str,
    payload: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    One output row per left row, with nulls where nothing matches or key or time is null. Of right
    rows with equal key and time the one highest in ``payload`` counts (nulls lowest).

    Both sides go through one range shuffle by key and a window over a key's rows by time: the last
    right row seen so far is the match, so no pairs are formed. Keys with more rows than one of the
    ``partitions`` (by default the session's) should have are merged apart, by ``_merged_in_ranges``.
    They are told by quantiles of the keys' hashes; an empty list of them leaves their scan out.
    """
    at = F.col(left_time) if isinstance(left_time, str) else left_time
    timed = left.withColumn("_at", at)
    can_match = F.col(key).isNotNull() & F.col("_at").isNotNull()
    known = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull())
    found = F.struct(right_time, *payload)
    # single columns, so that those a reader does not ask for are not shuffled
    own = {f"_l{i}": c for i, c in enumerate(left.columns)}
    questions = timed.filter(can_match).select(
        F.col(key).alias("_k"), F.col("_at").alias("_time"), F.lit(1).alias("_side"), *[F.col(c).alias(n) for n, c in own.items()]
    )
    answers = known.select(F.col(key).alias("_k"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), found.alias("_found"))
    merged = questions.unionByName(answers, allowMissingColumns=True).withColumn("_hash", F.hash("_k"))
    count = partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(_frequent_hashes(merged, count))
    match = F.col("_hash") == F.col("_h")

    cold = merged.join(hot, match, "left_anti").repartitionByRange(*([partitions] if partitions else []), "_k")
    so_far = Window.partitionBy("_k").orderBy("_time", "_side", "_found").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = cold.withColumn("_match", F.last("_found", ignorenulls=True).over(so_far)).filter("_side = 1").select(*own, "_match")
    both = seen.unionByName(_merged_in_ranges(merged.join(hot, match, "left_semi"), list(own), count))
    matched = both.select(*[F.col(n).alias(c) for n, c in own.items()], *[F.col("_match")[c].alias(c) for c in (right_time, *payload)])
    return matched.unionByName(left.withColumn("_at", at).filter(~can_match).drop("_at"), allowMissingColumns=True)


def _frequent_hashes(rows: DataFrame, parts: int) -> DataFrame:
    """Hashes ``_h`` of the keys that have one of ``parts`` equal shares of the rows, and none with less than half of one.

    A value on that many rows is met by two quantiles in a row; these are exact to 53 bits only,
    hence hashes of 32. One row a task is sent.
    """
    points = min(2 * parts, 1000)
    if parts < 2:
        return rows.select(F.col("_hash").alias("_h")).limit(0)
    quantiles = F.percentile_approx("_hash", [(i + 0.5) / points for i in range(points)], 10_000)
    again = F.filter("q", lambda h, i: (i > 0) & (h == F.get("q", i - 1)))
    return rows.agg(quantiles.alias("q")).select(F.explode(F.array_distinct(again)).alias("_h"))


def _merged_in_ranges(merged: DataFrame, own: list[str], count: int) -> DataFrame:
    """The columns ``own`` of left rows with ``_match``, where a key may have any share of the rows.

    Rows go through one range shuffle by (key, time), so a key spans as many of ``count`` partitions
    as it fills. What a partition ends with is carried to those after it by a scan over one row
    a partition. Rows know their partition by its first row: a task's number depends on what
    the result is united with.
    """
    # the input split parts equal left rows; right rows need no parting beyond their payload
    turn = F.when(F.col("_side") == 1, F.xxhash64(F.spark_partition_id(), *own)).otherwise(F.lit(0).cast("long"))
    row = F.when(F.col("_side") == 1, F.struct(*own))
    order = ["_k", "_time", "_side", "_found", "_turn"]
    placed = merged.select("_k", "_time", "_side", turn.alias("_turn"), row.alias("_row"), "_found")
    # a given number of partitions is not changed while the query runs, so both readers below see the same ones
    place = F.xxhash64(*order).alias("_place")
    placed = placed.repartitionByRange(count, *order).sortWithinPartitions(*order).select("_k", "_side", "_row", "_found", place)
    types = {f.name: f.dataType for f in placed.schema.fields}
    schema = T.StructType([
        T.StructField("_row", types["_row"]), T.StructField("_match", types["_found"]), T.StructField("_part", T.IntegerType()), T.StructField("_place", T.LongType()),
        T.StructField("_open", T.BooleanType()), T.StructField("_first", types["_k"]), T.StructField("_last", types["_k"]),
    ])
    filled = placed.mapInArrow(_filled_forward, schema)

    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = filled.filter("_row IS NULL").withColumn("_end", F.when(F.col("_match").isNotNull(), F.struct("_last", "_match")))
    carried = ends.withColumn("_end", F.last("_end", ignorenulls=True).over(earlier)).filter(F.col("_end")["_last"] == F.col("_first")).select(
        F.col("_place").alias("_for"), F.col("_first").alias("_key"), F.col("_end")["_match"].alias("_carried")
    )
    # one row a partition
    same = F.col("_open") & (F.col("_place") == F.col("_for")) & (F.col("_first") == F.col("_key"))
    joined = filled.filter("_row IS NOT NULL").join(F.broadcast(carried), same, "left")
    return joined.withColumn("_match", F.coalesce("_match", "_carried")).select("_row.*", "_match")


def _filled_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Left rows of a sorted partition with the last right row of their key before them.

    Rows of the partition's first key ahead of its first right row are open: earlier
    partitions may have their match; ``_first`` is a left row's own key. A last row without a left
    row tells the first and the last key, and the last key's last right row.
    """
    part, place, first, last, carry = TaskContext.get().partitionId(), None, None, None, None
    names = ["_row", "_match", "_part", "_place", "_open", "_first", "_last"]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys, rows, found = batch.column("_k"), batch.column("_row"), batch.column("_found")
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        fresh[0] = last is None or not keys[0].equals(last)
        if first is None:
            first, place, carry = keys[0], batch.column("_place")[0].as_py(), pa.nulls(1, found.type)
        begins = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
        is_left = batch.column("_side").to_numpy() == 1
        seen = np.maximum.accumulate(np.where(is_left, -1, np.arange(n)))
        # 0 stands for the carried row, which serves rows of the key that the last batch ended with
        here = (seen >= begins) & (seen >= 0)
        source = pa.array(np.where(here, seen + 1, 0), mask=~here & (begins >= 0))
        match = pa.concat_arrays([carry, found]).take(source)
        # no right row yet in this partition, and still its first key
        is_open = match.is_null().to_numpy(zero_copy_only=False) & (pc.equal(keys, first).to_numpy(zero_copy_only=False))
        kept = np.flatnonzero(is_left)
        m, kind = len(kept), keys.type
        if m:
            take = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [rows.take(take), match.take(take), pa.nulls(m, pa.int32()), pa.array(np.full(m, place, np.int64)), pa.array(is_open[kept]), keys.take(take), pa.nulls(m, kind)],
                names,
            )
        carry, last = match.slice(n - 1), keys[n - 1]
    if first is not None:
        ends = [pa.nulls(1, rows.type), carry, pa.array([part], pa.int32()), pa.array([place], pa.int64()), pa.array([False]), pa.array([first.as_py()], kind), pa.array([last.as_py()], kind)]
        yield pa.RecordBatch.from_arrays(ends, names)


def coverage(
    left: DataFrame, right: DataFrame, key: str, *, count_null_keys: bool = False
) -> DataFrame:
    """One row ``(total, matched, coverage)``: share of left rows whose key is on the right.

    Left rows are counted per key before the join, so a frequent key costs one row.
    """
    per_key = left.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if not count_null_keys:
        per_key = per_key.filter(F.col(key).isNotNull())
    known = right.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(1))
    matched = F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return (
        per_key.join(known, key, "left")
        .agg(total.cast("bigint").alias("total"), matched.cast("bigint").alias("matched"))
        .withColumn(
            "coverage",
            F.try_divide(F.col("matched").cast("double"), F.col("total").cast("double")),
        )
    )


def unmatched_keys(left: DataFrame, right: DataFrame, key: str, limit: int | None = 25) -> DataFrame:
    """Sorted distinct left keys that the right side lacks; the first ``limit`` of them."""
    missing = (
        left.select(key)
        .filter(F.col(key).isNotNull())
        .distinct()
        .join(right.select(key), key, "left_anti")
        .orderBy(key)
    )
    return missing if limit is None else missing.limit(limit)


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Expected columns the table lacks, in the given order. Metadata only."""
    return [c for c in expected if c not in df.columns]
