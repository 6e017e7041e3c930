"""One row per key, and the rows that lost.

A key may hold a large share of all rows, so nothing here gathers a key's raw
rows in one task. ``row_number() = 1`` plans a partial group limit ahead of the
shuffle: every input partition sends at most one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKETS = 1 << 16


def _latest_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_break: Sequence[str] | None
) -> list[Column]:
    """Total order: highest first, nulls lose; ties fall to the tie-break columns."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in order_by]
    return [F.col(c).desc_nulls_last() for c in [*order_by, *tie_break]]


def keep_tied(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The rows that are highest in ``order_by`` within their key; several where they are tied."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.rank().over(window)).filter("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the highest ``order_by`` per key. Null keys form one group.

    ``tie_break`` defaults to all other columns, so the result never depends on
    how rows were spread. Pass the ingest ordinal to let the last input row win.
    """
    window = Window.partitionBy(*keys).orderBy(*_latest_first(df, keys, order_by, tie_break))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_highest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the row that is highest in all its columns, as by ``keep_latest(df, keys, [])``.

    For rows that a window has left sorted by key: an aggregate takes them in that order, where
    a second ranking would sort them again by every column.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return keep_latest(df, keys, [])
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def rows_sharing_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key is on more than one row; null keys are equal to each other."""
    repeated = repeated_keys(df, keys).select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return df.join(repeated, match, "left_semi")


def quarantine(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
    *,
    typed: Callable[[DataFrame], DataFrame] | None = None,
    slice_rows: int = 100_000,
) -> DataFrame:
    """The rows ``keep_latest`` leaves out: together the two are the whole input.

    ``typed`` is applied to the rows whose key is on several rows, ahead of the ranking and
    to no others; it leaves the keys as they are.

    Rows go through one shuffle, by key. Keys with more than ``slice_rows`` rows, of which there
    are at most a ``slice_rows``-th of all rows, are counted beforehand and ranked apart.
    """
    typed = typed or (lambda rows: rows)
    # few, see above; an empty list leaves the second scan of the input out
    hot = F.broadcast(repeated_keys(df, keys).filter(F.col("n") > slice_rows).select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("n").alias("_n")))
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]

    one_key = Window.partitionBy(*keys)
    cold = df.join(hot, match, "left_anti").withColumn("_n", F.count(F.lit(1)).over(one_key))
    contested = typed(cold.filter("_n > 1").drop("_n"))
    ranking = _latest_first(contested, keys, order_by, tie_break)
    lost = contested.withColumn("_rank", F.row_number().over(one_key.orderBy(*ranking))).filter("_rank > 1").drop("_rank")
    return lost.unionByName(losing_rows(typed(_sliced(df, keys, hot, match, slice_rows)), keys, ranking))


def _sliced(df: DataFrame, keys: Sequence[str], hot: DataFrame, match: Sequence[Column], slice_rows: int) -> DataFrame:
    """The rows of the keys ``hot``, with ``_slice``: a key gets a slice for every ``slice_rows`` of its rows.

    A row's slice comes from its content and its input split, so that exact copies part too.
    Any assignment gives the same result, and a repeated task makes the same one.
    """
    turn = F.xxhash64(F.spark_partition_id(), *[c for c in df.columns if c not in keys])
    piece = F.pmod("_turn", F.ceil(F.col("_n") / slice_rows)).cast("int")
    return df.withColumn("_turn", turn).join(hot, match).select(*df.columns, piece.alias("_slice"))


def losing_rows(sliced: DataFrame, keys: Sequence[str], ranking: Sequence[Column]) -> DataFrame:
    """Of rows with a ``_slice`` of their key, all but the best row per key.

    Ranked in two steps, because a key may have very many rows: first within (key,
    slice), then the best row of each slice competes for the key while all other
    rows stay spread over the slices.
    """
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*ranking)
    in_pool = Window.partitionBy(*keys, "_pool").orderBy(*ranking)
    return (
        sliced.withColumn("_first", F.row_number().over(in_slice) == 1)
        .withColumn("_pool", F.when(F.col("_first"), F.lit(-1)).otherwise(F.col("_slice")))
        .withColumn("_rank", F.row_number().over(in_pool))
        .filter(~(F.col("_first") & (F.col("_rank") == 1)))
        .drop("_slice", "_first", "_pool", "_rank")
    )


def ranked_outcomes(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], narrow: Sequence[str], slices: int, outcome: str, *, slice_rows: int = 100_000
) -> DataFrame:
    """Every row, with the text column ``outcome``: ``kept`` for the best row of its key, else ``rejected``.

    Rows are shuffled and ranked once, by key. Only keys that may have more than ``slice_rows`` rows
    are ranked in ``slices`` slices; they are told by the row counts of hash buckets of the keys,
    from a scan of the key columns. An empty list of buckets leaves the scan for these keys out.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    full = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
    hot, marked = F.broadcast(full.select("_b")), df.withColumn("_bucket", bucket)
    match = F.col("_bucket") == F.col("_b")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    cold = marked.join(hot, match, "left_anti").withColumn("_rank", rank)
    ranked = cold.select(*df.columns, F.when(F.col("_rank") == 1, "kept").otherwise("rejected").alias(outcome))
    return ranked.unionByName(_sliced_outcomes(marked.join(hot, match, "left_semi").select(*df.columns), keys, order_by, narrow, slices, outcome))


def _sliced_outcomes(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], narrow: Sequence[str], slices: int, outcome: str
) -> DataFrame:
    """As ``ranked_outcomes`` for keys with very many rows.

    Rows are shuffled by key and one of ``slices`` slices of it. The best row of each slice then
    competes for its key with the columns ``narrow`` only (those ``order_by`` reads), and the
    winning slice is joined back to the rows where they lie.
    """
    content = [c for c in df.columns if c not in keys]
    # a struct, in which nulls are equal; the input split parts exact copies
    turn = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.lit(slices)).cast("int")
    placed = df.withColumn("_k", F.struct(*keys)).withColumn("_slice", turn)
    # no row ahead of it; a row number would be limited ahead of the shuffle for the rivals alone, from a scan of their own
    first = placed.withColumn("_first", F.lag(F.lit(1)).over(Window.partitionBy("_k", "_slice").orderBy(*order_by)).isNull())
    # the hash needs every column, as the join below does, so both read the same shuffle of one scan
    rivals = first.filter("_first").select("_k", "_slice", *[c for c in narrow if c not in keys], *keys, F.xxhash64(*df.columns).alias("_all"))
    best = rivals.withColumn("_rank", F.row_number().over(Window.partitionBy("_k").orderBy(*order_by, "_all"))).filter("_rank = 1")
    winners = best.select(F.col("_k").alias("_wk"), F.col("_slice").alias("_wslice"))
    match = (F.col("_k") == F.col("_wk")) & (F.col("_slice") == F.col("_wslice"))
    won = F.when(F.col("_first") & F.col("_wslice").isNotNull(), "kept").otherwise("rejected")
    return first.join(winners, match, "left").select(*df.columns, won.alias(outcome))
