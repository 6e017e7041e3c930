"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its nearest pivots in order. In a block of the index each
pivot has an inverted file: the vectors that list it, with its place in their order. A
query reads the files of its own nearest pivots and sums, for every vector met there,
how much nearer the two orders are than orders with nothing in common; that ranks the
block by the footrule distance of the orders (a pivot not listed has the place after the
last). The best share of a block is compared exactly.

Blocks of vectors and blocks of queries meet in pairs, each a group of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, ShortType, StructField, StructType

from creditloom.llm.tables import stored


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the vectors that take part, equal rows once.

    Left out: null ids, null or zero vectors, null or non-finite components, and vectors
    of another length than the most frequent one (the smaller, if two are as frequent).
    """
    vec = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(
        "vec_id IS NOT NULL AND vec IS NOT NULL AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(vec, x -> x <> 0)"
    )
    top = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    return rows.filter(F.size("vec") == (top[0]["length"] if top else 0)).distinct()


def scaled(x: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that bring their largest components to 0.5 to 1.

    Directions and digits stay, and no square is too large or too small for a double.
    """
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def choose_pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """Up to ``pivots`` different vectors, those least by a hash of their components.

    The hashes of all different vectors compete; each task sends its least ones only.
    """
    turn = F.xxhash64("vec")
    least = rows.select(turn.alias("turn")).distinct().orderBy("turn").limit(pivots).collect()
    if not least:
        return np.zeros((0, 0))
    some = rows.select("vec").filter(turn <= least[-1]["turn"]).distinct().orderBy(turn, "vec").limit(pivots)
    return np.asarray([r[0] for r in some.collect()], dtype=float)


class PermutationIndex:
    """Blocks of vectors with the order of their nearest pivots, written to shared storage.

    The pivots are a bounded sample (``pivots`` vectors, sent to every task); every
    vector is indexed. Blocks have about ``block_rows`` vectors, dealt by a hash of the id.
    """

    def __init__(self, vectors: DataFrame, pivots: int = 512, listed: int = 64, block_rows: int = 1024):
        rows = stored(usable(vectors), "usable-vectors")
        self.spark, self.total = vectors.sparkSession, rows.count()
        self.blocks = max(1, -(-self.total // block_rows))
        chosen = choose_pivots(rows, pivots)
        self.pivots, self.listed = len(chosen), min(listed, len(chosen))
        self.rows = rows if not len(chosen) else stored(self._ordered(rows, chosen), "permutation-index")

    def _ordered(self, rows: DataFrame, chosen: np.ndarray) -> DataFrame:
        sent, listed = self.spark.sparkContext.broadcast(unit(chosen)), self.listed
        schema = StructType([*rows.schema.fields, StructField("order", ArrayType(ShortType()))])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                near = np.argsort(-(unit(matrix(batch.column("vec"))) @ sent.value.T), axis=1, kind="stable")[:, :listed]
                ends = np.arange(len(near) + 1) * listed
                order = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(near.reshape(-1).astype(np.int16)))
                yield pa.RecordBatch.from_arrays([*batch.columns, order], [*batch.schema.names, "order"])

        return rows.mapInArrow(work, schema).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(self.blocks)))

    def search(self, queries: DataFrame, k: int = 5, share: float = 0.25, least: int = 64, query_rows: int = 1024) -> DataFrame:
        """query_id, rank (from 1), vec_id, score: up to ``k`` nearest by cosine.

        ``queries`` are rows of the index. A row is no candidate for its own id. In every
        block the best ``share`` by footrule distance, at least ``least``, are compared
        exactly. Equal scores are ordered by vec_id. Finite components of any size have
        finite scores. An empty index gives an empty result.
        """
        schema = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])
        if not self.pivots:
            return self.spark.createDataFrame([], StructType([schema[0], StructField("rank", LongType()), *schema.fields[1:]])).withColumn("rank", F.col("rank").cast("int"))
        listed, pivots = self.listed, self.pivots
        asked = queries.count()
        parts = max(1, -(-asked // query_rows))

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            return pa.Table.from_pydict(search_block(left, right, pivots, listed, k, share, least), schema=RESULT)

        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.blocks - 1).cast("long")))
        asking = queries.select("vec_id", "vec", "order", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).alias("part")).withColumn("block", every)
        held = self.rows.select("vec_id", "vec", "order", "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        found = asking.groupBy("part", "block").cogroup(held.groupBy("part", "block")).applyInArrow(work, schema)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search_block(queries: pa.Table, rows: pa.Table, pivots: int, listed: int, k: int, share: float, least: int) -> dict:
    """The nearest rows of one block for each query of one block."""
    out_query, out_row, out_score = [], [], []
    if queries.num_rows and rows.num_rows:
        ids, x, orders = rows["vec_id"].to_numpy(), scaled(matrix(rows["vec"])), matrix(rows["order"]).astype(np.int64)
        turn = np.argsort(ids, kind="stable")
        ids, x, orders = ids[turn], x[turn], orders[turn]
        size = np.sqrt((x * x).sum(axis=1))
        # inverted files: the entries of pivot p lie between starts[p] and starts[p + 1]
        by_pivot = np.argsort(orders.reshape(-1), kind="stable")
        entry_row, entry_place = by_pivot // listed, by_pivot % listed
        starts = np.searchsorted(orders.reshape(-1)[by_pivot], np.arange(pivots + 1))
        places = np.arange(listed)
        for name, q, order in zip(queries["vec_id"].to_pylist(), scaled(matrix(queries["vec"])), matrix(queries["order"]).astype(np.int64), strict=True):
            low, count = starts[order], starts[order + 1] - starts[order]
            at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
            gain = listed - np.maximum(np.repeat(places, count), entry_place[at])
            near = np.bincount(entry_row[at], gain, len(ids))
            near[ids == name] = -1.0
            take = min(len(ids), max(least, int(np.ceil(share * len(ids)))))
            pick = np.argsort(-near, kind="stable")[:take]
            pick = pick[ids[pick] != name]
            score = (x[pick] * q).sum(axis=1) / (size[pick] * np.sqrt((q * q).sum()))
            best = np.lexsort((ids[pick], -score))[:k]
            out_query += [name] * len(best)
            out_row += ids[pick[best]].tolist()
            out_score += score[best].tolist()
    return {"query_id": out_query, "vec_id": out_row, "score": out_score}
