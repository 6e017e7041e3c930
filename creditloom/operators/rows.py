"""Headers, blank rows, column typing, aligned unions, fixed-size samples."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.text import snake_header


def normalise_headers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Snake-case headers; padding columns (no name, ``_c<N>``, ``Unnamed: <N>``) are dropped.

    Columns in ``keep`` (a scan's own) stay as they are, whatever the raw headers are.
    Metadata only. Two headers that become equal raise, because picking one of
    them would lose data silently.
    """
    kept: list[Column] = []
    seen: dict[str, str] = {}
    for raw in df.columns:
        if raw in keep:
            kept.append(F.col(raw))
            continue
        # the CSV scan calls an empty header _c<N>, which is a fine name once normalised
        name = "" if re.fullmatch(r"_c\d+", raw) else snake_header(raw)
        if not name or name.startswith("unnamed_"):
            continue
        if name in seen:
            raise ValueError(f"headers {seen[name]!r} and {raw!r} both become {name!r}")
        seen[name] = raw
        kept.append(F.col("`" + raw.replace("`", "``") + "`").alias(name))
    return df.select(*kept)


def drop_blank_rows(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Keep rows with any key present; with no such key column, rows with any value.

    Written as ``IS NOT NULL OR ...`` so that the filter reaches the file scan.
    """
    tested = [k for k in keys if k in df.columns] or df.columns
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in tested]))


def map_columns(
    df: DataFrame, columns: Iterable[str], expression: Callable[[Column], Column]
) -> DataFrame:
    """Apply one expression to the named columns that exist, in a single projection."""
    changed = {c: expression(F.col(c)) for c in columns if c in df.columns}
    return df.withColumns(changed) if changed else df


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name over the union of columns, sorted by name; absent columns are null."""
    if not frames:
        raise ValueError("nothing to union")
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return joined.select(*sorted(joined.columns))


def fixed_sample(df: DataFrame, keys: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """``size`` rows picked by a seeded digest of the key, sorted by the key.

    The same keys and seed are picked again whatever the partitioning. Digests are
    first counted by their leading characters (at most 65,536 groups); that gives
    the exact prefix up to which ``size`` rows are found, and only rows up to it
    are sorted. Otherwise every input split would send ``size`` candidates.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    marked = df.withColumn("_digest", digest)
    prefix = F.substring("_digest", 1, 4)
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the first prefix that completes the sample; none if the table is smaller than it
    last = (
        marked.groupBy(prefix.alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("found", F.sum("n").over(upto))
        .filter(F.col("found") >= size)
        .agg(F.coalesce(F.min("p"), F.lit("g")).alias("p"))
    )
    return (
        marked.filter(prefix <= last.scalar())
        .orderBy("_digest", *keys)
        .limit(size)
        .drop("_digest")
        .orderBy(*keys)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
