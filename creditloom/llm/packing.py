"""Harmonic packing of documents into fixed-length token sequences.

A length belongs to class k when at most k pieces of it fit a sequence of C tokens
(C/(k+1) < length <= C/k), and a sequence of class k takes exactly k pieces. Documents
are cut so that a piece has the greatest length of its class, C // k; a rest of at most
``short`` tokens is left as it is, and its pieces share sequences with pieces of their
own length only. So full sequences are padded by a few tokens, and a place is a matter
of counting.

Each task fills the sequences of every class on its own. What it could not fill (fewer
than k pieces a class) is ranked across tasks by prefix sums of counts and fills
sequences of the same kind. The last pieces, fewer than k a class whatever the input,
are laid end to end and cut at sequence ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from creditloom.llm.tables import small_batches, stored
from creditloom.llm.tokens import TEXT_BYTES, shared_coder, vocabulary_path
from creditloom.llm.words import gathered

SHARED = 1 << 62  # sequences that pieces of several tasks fill
LAST = SHARED + (1 << 61)


def cut_lengths(total: int, capacity: int, short: int) -> list[int]:
    """Lengths of a document's pieces, greatest first."""
    out = [capacity] * (total // capacity)
    rest = total % capacity
    while rest > short:
        out.append(capacity // -(-capacity // rest))
        rest -= out[-1]
    return out + [rest] * (rest > 0)


class Filler:
    """Fills the sequences of one task; holds the pieces of unfilled ones back."""

    def __init__(self, task: int, capacity: int):
        self.task, self.capacity, self.count, self.open = task, capacity, 0, {}

    def put(self, length: int, piece: tuple) -> list[tuple]:
        """The rows of a sequence that became full, with their places."""
        held = self.open.setdefault(length, [])
        held.append(piece)
        if len(held) < self.capacity // length:
            return []
        del self.open[length]
        name = (self.task << 32) + self.count
        self.count += 1
        return [(*p, False, self.task, name, k * length) for k, p in enumerate(held)]

    def rest(self) -> list[tuple]:
        return [(*p, True, self.task, k, 0) for held in self.open.values() for k, p in enumerate(held)]


def cut_documents(docs: DataFrame, capacity: int, short: int, vocabulary: str, end: int) -> DataFrame:
    """The pieces of all documents: those of full sequences placed, the others marked as rest."""
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("start", LongType()), StructField("length", LongType()),
        StructField("doc_tokens", LongType()), StructField("ids", BinaryType()), StructField("rest", BooleanType()),
        StructField("task", IntegerType()), StructField("sequence_id", LongType()), StructField("offset", LongType()),
    ])
    kind = pa.schema([
        ("doc_id", None), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
        ("rest", pa.bool_()), ("task", pa.int32()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ][1:])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, filler, id_type = shared_coder(vocabulary), Filler(TaskContext.get().partitionId(), capacity), None

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, f.type) for c, f in zip(columns[1:], kind, strict=True)]]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *kind.names])

        for part in gathered(batches, "text", TEXT_BYTES):
            id_type = part.schema.field("doc_id").type
            ids, at = coder.encode_ending(part.column("text"), end)
            data, rows = ids.astype("<u4").tobytes(), []
            for doc, first, last in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                start = first
                for length in cut_lengths(last - first, capacity, short):
                    piece = (doc, start - first, length, last - first, data[4 * start : 4 * (start + length)])
                    rows += filler.put(length, piece)
                    start += length
            if rows:
                yield frame(rows)
        if filler.open:
            yield frame(filler.rest())

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, schema)


def pack(docs: DataFrame, capacity: int = 2048, short: int = 64, vocabulary: str | None = None, end: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    ids holds the piece's token ids as little-endian unsigned 32-bit integers. Every
    document ends with the id ``end``; a null or empty text is that id alone. Each id
    is in exactly one piece, and the pieces of a sequence lie end to end from offset 0.
    Repeated rows are packed once each; an empty table gives an empty result.
    """
    pieces = stored(cut_documents(docs, capacity, short, vocabulary_path(vocabulary), end), "packing-pieces")
    keep = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    placed = pieces.filter(~F.col("rest")).select(keep)

    # a rest's sequence_id is its number among the task's rests of its length
    rest = pieces.filter("rest").withColumnRenamed("sequence_id", "number")
    counts = rest.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy("length")
    ranks = counts.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(everyone).alias("all")
    )
    fits = F.floor(F.lit(capacity) / F.col("length"))
    ranked = rest.join(ranks, ["length", "task"]).withColumn("rank", F.col("before") + F.col("number")).withColumn("fits", fits)
    full = F.col("rank") < F.floor(F.col("all") / F.col("fits")) * F.col("fits")
    shared = ranked.filter(full).withColumn(
        "sequence_id", F.lit(SHARED) + F.shiftleft("length", 45) + F.floor(F.col("rank") / F.col("fits"))
    ).withColumn("offset", F.pmod("rank", "fits") * F.col("length"))

    order = Window.orderBy(F.desc("length"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    laid = ranked.filter(~full).withColumn("at", F.coalesce(F.sum("length").over(order), F.lit(0)))
    sequence = F.explode(F.sequence(F.floor(F.col("at") / capacity), F.floor((F.col("at") + F.col("length") - 1) / capacity)))
    low = F.greatest(F.col("at"), F.col("number_of") * capacity)
    high = F.least(F.col("at") + F.col("length"), (F.col("number_of") + 1) * capacity)
    last = (
        laid.withColumn("number_of", sequence).withColumn("low", low).withColumn("high", high)
        .select(
            "doc_id",
            (F.col("start") + F.col("low") - F.col("at")).alias("start"),
            (F.col("high") - F.col("low")).alias("length"),
            "doc_tokens",
            (F.lit(LAST) + F.col("number_of")).alias("sequence_id"),
            (F.col("low") - F.col("number_of") * capacity).alias("offset"),
            F.substring("ids", (4 * (F.col("low") - F.col("at")) + 1).cast("int"), (4 * (F.col("high") - F.col("low"))).cast("int")).alias("ids"),
        )
    )
    return placed.unionByName(shared.select(keep)).unionByName(last)
