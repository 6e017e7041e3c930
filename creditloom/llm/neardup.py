"""MinHash near-dedup with tensored banding.

A few collections of two minhashes each are computed; a table's key joins the hashes of
two collections, so c collections give c(c-1)/2 tables: 24 minhashes serve 66 tables of
four. A pair that shares a key in any table is a candidate, and links are confirmed on
full shingle sets.

Documents with equal sets are one node. Within a bucket (a key with several nodes) every
node is first compared with one centre, the one that meets most others over all buckets.
That joins large groups in a number of comparisons linear in their size. What remains
are pairs of a bucket that lie in different components; of these, pairs that cannot be
similar by set size or by the parity sketch are passed over, and the rest are compared.
So every candidate pair is compared, ruled out by a bound, or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from creditloom.llm.bitmaps import bitmap, id_hash, may_have
from creditloom.llm.graph import components
from creditloom.llm.tables import small_batches, stored
from creditloom.llm.words import LOWER, mix, repeats, slices, span_hashes, utf8, windows, word_bounds

COLLECTIONS = 12
PER_COLLECTION = 2
TABLES = list(combinations(range(COLLECTIONS), 2))
SKETCH_BITS = 1024
SEEDS = mix(np.arange(1, COLLECTIONS * PER_COLLECTION + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in ascending order, and the texts' offsets.

    A text with fewer words than a shingle has its whole sequence as its only one.
    """
    low = LOWER[data]
    starts, ends, words = word_bounds(low, at)
    hashes = span_hashes(low, starts, ends)
    out, owner, _ = windows(hashes, words, size)
    few = np.diff(words)
    for n in range(1, size):
        short = np.flatnonzero(few == n)
        if len(short):
            whole = np.zeros(len(short), dtype=np.uint64)
            for k in range(n):
                whole = mix(whole + hashes[words[short] + k] * np.uint64(2 * k + 1))
            out, owner = np.concatenate([out, mix(whole + np.uint64(n))]), np.concatenate([owner, short])
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    _, again = repeats(owner, out)
    out, owner = out[~again], owner[~again]
    return out, np.searchsorted(owner, np.arange(len(at)))


def signature(sets: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Digest, collections and sketch of each non-empty set, and which texts have one."""
    count = np.diff(at)
    full = np.flatnonzero(count)
    first = at[:-1][full]
    add = lambda x: np.add.reduceat(x, first) if len(full) else np.zeros(0, np.uint64)
    digest = np.stack([add(mix(sets + np.uint64(1))), add(mix(sets ^ np.uint64(0x5851F42D4C957F2D)))], axis=1)
    halves = np.zeros((len(full), COLLECTIONS), dtype=np.uint64)
    for k, seed in enumerate(SEEDS):
        least = np.minimum.reduceat(mix(sets ^ seed), first) if len(full) else np.zeros(0, np.uint64)
        c = k % COLLECTIONS
        halves[:, c] = mix(halves[:, c] * np.uint64(3) + least)
    owner = np.repeat(np.arange(len(full)), count[full])
    bits = np.bincount(owner * SKETCH_BITS + (sets >> np.uint64(32)).astype(np.int64) % SKETCH_BITS, minlength=len(full) * SKETCH_BITS)
    sketch = np.packbits((bits & 1).astype(np.uint8).reshape(len(full), SKETCH_BITS), axis=1).view(np.int64)
    return {"full": full, "digest": digest, "halves": halves.view(np.int64), "sketch": sketch}


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, digest, halves and sketch; the last three are null where n is 0."""
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n", LongType()), StructField("digest", BinaryType()),
        StructField("halves", ArrayType(LongType())), StructField("sketch", ArrayType(LongType())),
    ])

    def lists(rows: np.ndarray, texts: int, full: np.ndarray) -> pa.Array:
        width = rows.shape[1]
        ends = np.zeros(texts + 1, dtype=np.int32)
        ends[full + 1] = width
        has = np.zeros(texts, dtype=bool)
        has[full] = True
        return pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(rows.reshape(-1), pa.int64()), mask=pa.array(~has))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1_000_000):
                sets, at = shingle_sets(*utf8(part.column("text")), size)
                got, texts = signature(sets, at), part.num_rows
                digest = np.full(texts, None, dtype=object)
                for k, d in zip(got["full"], got["digest"], strict=True):
                    digest[k] = d.tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(digest, pa.binary()),
                    lists(got["halves"], texts, got["full"]), lists(got["sketch"], texts, got["full"]),
                ], schema.names)

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, schema)


def full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node and set (sorted 64-bit hashes, as bytes) for the documents named in ``nodes``.

    A few others, whose ids share a place of the bitmap, come along.
    """
    kind = docs.schema["doc_id"].dataType
    schema = StructType([StructField("node", kind), StructField("set", BinaryType())])
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select(id_hash(F.col("node")).alias("h")), "h"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.filter(pa.array(may_have(sent.value, batch.column("h").to_numpy())))
            for part in slices(found, "text", 1_000_000):
                sets, at = shingle_sets(*utf8(part.column("text")), size)
                data = sets.tobytes()
                cut = [data[8 * a : 8 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cut, pa.binary())], ["node", "set"])

    rows = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", id_hash(F.col("doc_id")).alias("h"))
    return rows.mapInArrow(work, schema)


def common_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b and the sizes of the common part and of the union of their sets."""
    for batch in batches:
        left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        common, union = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        for k, (x, y) in enumerate(zip(left, right, strict=True)):
            u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common[k] = len(np.intersect1d(u, v, assume_unique=True))
            union[k] = len(u) + len(v) - common[k]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common), pa.array(union)], ["a", "b", "common", "union"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have at least ``percent`` of their union in common."""
    kind = pairs.schema["a"].dataType
    wide = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    schema = StructType([StructField("a", kind), StructField("b", kind), StructField("common", LongType()), StructField("union", LongType())])
    return wide.mapInArrow(common_counts, schema).filter(100 * F.col("common") >= percent * F.col("union")).select("a", "b").distinct()


def table_keys(nodes: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """node, low, high, key: a row per table, named by its two collections.

    With a bitmap, only keys that may be in it.
    """
    schema = StructType([
        StructField("node", nodes.schema["node"].dataType), StructField("low", IntegerType()), StructField("high", IntegerType()), StructField("key", LongType()),
    ])
    sent = None if bits is None else nodes.sparkSession.sparkContext.broadcast(bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.asarray(TABLES, dtype=np.int32).T
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                halves = part.column("halves").flatten().to_numpy().view(np.uint64).reshape(-1, COLLECTIONS)
                keys = mix(halves[:, low] + mix(halves[:, high] + np.arange(len(TABLES), dtype=np.uint64))).view(np.int64)
                row, table = np.nonzero(np.ones(keys.shape, bool) if sent is None else may_have(sent.value, keys))
                columns = [part.column("node").take(pa.array(row)), pa.array(low[table]), pa.array(high[table]), pa.array(keys[row, table])]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return nodes.select("node", "halves").mapInArrow(work, schema)


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """Rows of ``table_keys`` for the keys that two or more nodes share, and their number."""
    shared = table_keys(nodes).groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stored(shared, "shared-keys")
    return table_keys(nodes, bitmap(shared, "key")).join(shared, "key")


def could_link(percent: int) -> Column:
    """Bounds on sizes x.n, y.n and sketches that every linked pair meets.

    Linked sets differ in at most (n + m)(100 - p)/(100 + p) elements, and each bit in
    which the parities of two sets differ stands for an element that only one has.
    """
    n, m = F.col("x.n"), F.col("y.n")
    parts = [F.bit_count(F.col("x.sketch")[k].bitwiseXOR(F.col("y.sketch")[k])) for k in range(SKETCH_BITS // 64)]
    apart = reduce(lambda a, b: a + b, parts)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart * (100 + percent) <= (n + m) * (100 - percent))


def first_table() -> Column:
    """Is the rows' table the first that x and y share? So a pair meets in one bucket only."""
    agree = [F.when(F.col("x.high") >= c, (F.col("x.halves")[c] == F.col("y.halves")[c]).cast("int")).otherwise(0) for c in range(COLLECTIONS)]
    return reduce(lambda a, b: a + b, agree) == 2


def links_by_id(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that hold texts of one doc_id."""
    several = known.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).filter("low <> high").select("doc_id")
    held = known.join(several, "doc_id", "left_semi").join(nodes.select("digest", "node"), "digest").select("doc_id", F.col("node").alias("a")).distinct()
    least = held.groupBy("doc_id").agg(F.min("a").alias("b"))
    return held.join(least, "doc_id").filter("a <> b").select("a", "b").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Sets are the distinct shingles of ``size`` words, A-Z in lower case; documents whose
    common shingles are at least ``percent`` per cent of their union are linked.
    component_id is the least doc_id reachable. Texts that are null or without words
    have no shingle and are linked with nothing. Rows with one doc_id are one document
    with several texts, which all belong to its component. A null doc_id is linked with nothing and kept. An empty table
    gives an empty result.
    """
    rows = stored(signatures(docs, size), "shingle-signatures")
    known = rows.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = stored(
        known.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "halves", "sketch")).alias("v")).select(
            "digest", F.col("v.doc_id").alias("node"), "v.n", "v.halves", "v.sketch"
        ),
        "shingle-nodes",
    )
    buckets = stored(bucket_rows(nodes), "buckets")

    meets = buckets.groupBy("node").agg(F.sum("members").alias("meets"))
    centres = buckets.join(meets, "node").groupBy("key").agg(F.max_by("node", F.struct("meets", "node")).alias("centre"))
    starred = stored(buckets.drop("members").join(centres, "key"), "starred-keys")
    star = starred.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    star = stored(star, "star-pairs")
    named = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node"))).distinct()
    sets = stored(full_sets(docs, named, size), "shingle-sets")
    links = stored(confirmed(star, sets, percent), "star-links")
    of_ids = stored(links_by_id(known, nodes), "id-links")
    joined = components(links.unionByName(of_ids))

    # what is left: pairs of a bucket in different components, one of them not linked to its centre
    facts = nodes.join(joined, "node", "left").select("node", "n", "sketch", "halves", F.coalesce("component", "node").alias("component"))
    held = (
        starred.join(links.select(F.col("a").alias("node"), F.col("b").alias("centre"), F.lit(True).alias("linked")), ["node", "centre"], "left")
        .select("key", "low", "high", "node", (F.coalesce("linked", F.lit(False)) | (F.col("node") == F.col("centre"))).alias("linked"), (F.col("node") == F.col("centre")).alias("is_centre"))
    )
    spread = held.join(facts.select("node", "component"), "node").groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    open_keys = spread.filter("least <> most").select("key")
    held = stored(held.join(open_keys, "key", "left_semi").join(facts, "node"), "open-keys")
    x, y = held.filter("NOT linked").alias("x"), held.filter("NOT is_centre").alias("y")
    once = (F.col("y.linked") | (F.col("x.node") < F.col("y.node"))) & first_table()
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & once & could_link(percent))
    rest = rest.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = stored(confirmed(rest, sets, percent), "other-links")
    if more.limit(1).count():
        joined = components(links.unionByName(of_ids).unionByName(more))

    of_set = nodes.select("digest", "node").join(joined, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    linked = known.select("doc_id", "n", "digest").join(of_set, "digest").select("doc_id", "n", "component_id")
    alone = rows.filter("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the one kept of its group."""
    gone = near_duplicates(docs, **options).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
