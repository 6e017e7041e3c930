"""Token-ID files: patched frame-of-reference blocks with an index of block starts.

A file set is a folder of Parquet files. A row is a segment: some whole documents, in
ascending order of their ids, with the ids of their tokens as one byte string. A shard
(one task's output) is a run of segments; shards are in order of document ids as well.

A segment's bytes, all integers little-endian:

    header  magic PFR1, number of ids, of documents, of blocks (u32 each)
    ends    end of each document in the segment's ids (u32)
    index   first byte of each block, and the end of the last (u32), counted from the data
    frames  least id (u32), width in bits (u8) and number of exceptions (u16) of each block
    data    blocks

A block has 256 ids (the last one is filled up with its least id): each id's difference
to the least one, its low bits packed at the block's width, which the 90th percentile of
the differences needs; then the positions (u8) of the ids that need more, and their
remaining high bits (u32).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from creditloom.llm.tables import small_batches
from creditloom.llm.tokens import TEXT_BYTES, shared_coder, vocabulary_path
from creditloom.llm.words import gathered

BLOCK = 256
MAGIC = b"PFR1"


def bit_width(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs (0 for 0)."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_segment(ids: np.ndarray, ends: np.ndarray, percentile: float = 0.9) -> bytes:
    """The bytes of a segment of unsigned 32-bit ids; ``ends``: where its documents end."""
    blocks = -(-len(ids) // BLOCK)
    x = np.zeros(blocks * BLOCK, dtype=np.uint32)
    x[: len(ids)] = ids
    x = x.reshape(blocks, BLOCK)
    used = np.arange(blocks * BLOCK).reshape(blocks, BLOCK) < len(ids)
    least = np.where(used, x, np.uint32(0xFFFFFFFF)).min(axis=1) if blocks else np.zeros(0, np.uint32)
    delta = np.where(used, x - least[:, None], np.uint32(0))
    width = bit_width(np.sort(delta, axis=1)[:, int(percentile * (BLOCK - 1))]) if blocks else np.zeros(0, np.int64)
    high = np.where(width[:, None] < 32, delta.astype(np.uint64) >> width[:, None].astype(np.uint64), 0).astype(np.uint32)
    odd = (high > 0).sum(axis=1)
    size = width * (BLOCK // 8) + odd * 5
    starts = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(int(starts[-1]), dtype=np.uint8)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            bits = np.unpackbits(delta[rows].astype("<u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2, bitorder="little", count=int(w))
            packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            data[starts[rows][:, None] + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(high)
    turn = np.arange(len(block)) - np.repeat(np.cumsum(odd) - odd, odd)
    at = starts[block] + width[block] * (BLOCK // 8)
    data[at + turn] = place
    data[(at + odd[block] + 4 * turn)[:, None] + np.arange(4)] = high[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return b"".join((
        MAGIC, struct.pack("<III", len(ids), len(ends), blocks), np.asarray(ends).astype("<u4").tobytes(), starts.astype("<u4").tobytes(),
        least.astype("<u4").tobytes(), width.astype(np.uint8).tobytes(), odd.astype("<u2").tobytes(), data.tobytes(),
    ))


class Segment:
    """Reads a segment's bytes: all of its ids, or those of single blocks and documents."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        self.n, docs, blocks = struct.unpack_from("<III", raw, 4)
        at = 16
        take = lambda kind, count: np.frombuffer(raw, kind, count, at)
        self.ends, at = take("<u4", docs).astype(np.int64), at + 4 * docs
        self.starts, at = take("<u4", blocks + 1).astype(np.int64), at + 4 * (blocks + 1)
        self.least, at = take("<u4", blocks), at + 4 * blocks
        self.width, at = take(np.uint8, blocks).astype(np.int64), at + blocks
        self.odd, at = take("<u2", blocks).astype(np.int64), at + 2 * blocks
        self.data = np.frombuffer(raw, np.uint8, offset=at)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of the blocks from ``first`` up to ``last``."""
        width, odd, starts = self.width[first:last], self.odd[first:last], self.starts[first:last]
        out = np.zeros((last - first, BLOCK), dtype=np.uint64)
        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            if w:
                packed = self.data[starts[rows][:, None] + np.arange(int(w) * (BLOCK // 8))]
                bits = np.zeros((len(rows), BLOCK, 32), dtype=np.uint8)
                bits[:, :, : int(w)] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, int(w))
                out[rows] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
        block = np.repeat(np.arange(last - first), odd)
        turn = np.arange(len(block)) - np.repeat(np.cumsum(odd) - odd, odd)
        at = starts[block] + width[block] * (BLOCK // 8)
        place = self.data[at + turn]
        high = np.ascontiguousarray(self.data[(at + odd[block] + 4 * turn)[:, None] + np.arange(4)]).view("<u4")[:, 0]
        out[block, place] |= high.astype(np.uint64) << width[block].astype(np.uint64)
        ids = (out + self.least[first:last, None]).astype(np.uint32).reshape(-1)
        return ids[: max(0, self.n - first * BLOCK)]

    def ids(self) -> np.ndarray:
        return self.blocks(0, len(self.width))

    def document(self, k: int) -> np.ndarray:
        """The ids of the segment's k-th document, from the blocks that hold it."""
        low, high = int(self.ends[k - 1]) if k else 0, int(self.ends[k])
        first = low // BLOCK
        return self.blocks(first, -(-high // BLOCK))[low - first * BLOCK : high - first * BLOCK]


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = 0, segment_ids: int = 65_536) -> None:
    """Encodes all texts and writes them to the folder ``path`` in ascending doc_id order.

    Every text is followed by the id ``end``; a null text is that id alone. Null ids come
    first; repeated ids are ordered by a hash of their texts. A segment is closed once it has
    ``segment_ids`` ids, so it holds that many plus one document at most.
    """
    schema = StructType([
        StructField("shard", IntegerType()), StructField("segment", IntegerType()), StructField("before", LongType()),
        StructField("n_ids", LongType()), StructField("doc_ids", ArrayType(docs.schema["doc_id"].dataType)), StructField("payload", BinaryType()),
    ])
    vocabulary = vocabulary_path(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard, segment, before = shared_coder(vocabulary), TaskContext.get().partitionId(), 0, 0
        names: list = []
        parts: list[np.ndarray] = []
        ends: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal segment, before
            raw = encode_segment(np.concatenate(parts), np.asarray(ends))
            row = [
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([before], pa.int64()), pa.array([ends[-1]], pa.int64()),
                pa.ListArray.from_arrays([0, len(names)], pa.array(names, id_type)), pa.array([raw], pa.binary()),
            ]
            segment, before = segment + 1, before + ends[-1]
            names.clear(), parts.clear(), ends.clear()
            return pa.RecordBatch.from_arrays(row, schema.names)

        for part in gathered(batches, "text", TEXT_BYTES):
            id_type = part.schema.field("doc_id").type
            ids, at = coder.encode_ending(part.column("text"), end)
            for k, name in enumerate(part.column("doc_id").to_pylist()):
                names.append(name)
                parts.append(ids[at[k] : at[k + 1]])
                ends.append((ends[-1] if ends else 0) + len(parts[-1]))
                if ends[-1] >= segment_ids:
                    yield close()
        if ends:
            yield close()

    # ranges are set from a sample of the keys, which holds no texts
    keyed = small_batches(docs).select("doc_id", "text", F.xxhash64("text").alias("turn"))
    placed = keyed.repartitionByRange("doc_id", "turn").sortWithinPartitions("doc_id", "turn", "text")
    placed.select("doc_id", "text").mapInArrow(work, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens and ids (little-endian u32).

    start counts the ids of all documents before it, over all shards.
    """
    rows = spark.read.parquet(path)
    doc_type = rows.schema["doc_ids"].dataType.elementType
    # a row per shard: as many as the writing tasks
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("shard_start"))
    schema = StructType([
        StructField("doc_id", doc_type), StructField("start", LongType()), StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment = Segment(batch.column("payload")[k].as_py())
                data = segment.ids().astype("<u4").tobytes()
                first = np.concatenate([[0], segment.ends[:-1]])
                start = batch.column("start")[k].as_py()
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_ids")[k].values, pa.array(start + first), pa.array(segment.ends - first),
                    pa.array([data[4 * a : 4 * b] for a, b in zip(first.tolist(), segment.ends.tolist(), strict=True)], pa.binary()),
                ], schema.names)

    return (
        rows.join(F.broadcast(shards), "shard")
        .select("doc_ids", "payload", (F.col("shard_start") + F.col("before")).alias("start"))
        .mapInArrow(work, schema)
    )
