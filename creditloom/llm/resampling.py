"""Importance resampling of documents towards a target collection, by hashed n-grams.

A document's features are its runs of one to ``longest`` words, repeats counted, in
``buckets`` classes by CRC-32. A bucket's gain is the logarithm of its share in the
target over its share in the documents, both with one added, in thousandths. A document
weighs the mean gain of its features; Gumbel noise from a hash of its id turns the
highest scores into a sample without replacement.

Tasks work on Arrow columns: lower-case, split, dictionary indices. Shifted indices form
runs of words, of which each distinct one is hashed once, from the hashes of its words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from creditloom.llm.tables import small_batches, stored
from creditloom.llm.terms import encoded_terms
from creditloom.llm.words import slices

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _one_zero() -> np.ndarray:
    """CRC-32 register after one zero byte, for each value of each of its four bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    higher = [np.arange(256, dtype=np.uint32) << np.uint32(8 * (k - 1)) for k in (1, 2, 3)]
    return np.stack([table, *higher])


def _advance(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for k in (1, 2, 3):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Zeros:
    """CRC-32 of byte strings with any numbers of zero bytes behind them.

    The CRC of ``a + b`` is that of ``a`` with ``len(b)`` zeros, xor that of ``b``. Doubling
    gives tables for 1, 2, 4, ... zeros.
    """

    def __init__(self) -> None:
        self.tables = [_one_zero()]

    def after(self, crc: np.ndarray, count: np.ndarray) -> np.ndarray:
        out, k = crc.copy(), 0
        while len(count) and count.max() >> k:
            if k == len(self.tables):
                self.tables.append(_advance(self.tables[-1], self.tables[-1]))
            odd = np.flatnonzero((count >> k) & 1)
            out[odd] = _advance(self.tables[k], out[odd])
            k += 1
        return out


def run_buckets(codes: np.ndarray, at: np.ndarray, words: pa.Array, longest: int, buckets: int, zeros: Zeros) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run: the bucket of every run, and the offsets of each text's runs."""
    names = words.cast(pa.binary() if pa.types.is_string(words.type) else pa.large_binary()).to_pylist()
    behind = np.fromiter((zlib.crc32(b" " + w) for w in names), dtype=np.uint32, count=len(names))
    sizes = np.fromiter((len(w) + 1 for w in names), dtype=np.int64, count=len(names))
    crc = np.fromiter((zlib.crc32(w) for w in names), dtype=np.uint32, count=len(names))
    # kind: the number of the distinct run that begins at a word; first: those words
    kind, first = codes, np.arange(len(codes))
    yield (crc % np.uint32(buckets))[kind], at
    counts = np.diff(at)
    ends = np.repeat(at[1:], counts)
    for size in range(2, longest + 1):
        whole = first + size <= ends[first]
        kind, first = kind[whole], first[whole]
        coded = pc.dictionary_encode(pa.array(kind * len(names) + codes[first + size - 1]))
        runs = coded.dictionary.to_numpy()
        head, last = runs // max(1, len(names)), runs % max(1, len(names))
        crc = zeros.after(crc[head], sizes[last]) ^ behind[last]
        kind = coded.indices.to_numpy().astype(np.int64)
        yield (crc % np.uint32(buckets))[kind], np.searchsorted(first, at)


def bucket_counts(texts: DataFrame, longest: int = 2, buckets: int = 10_000) -> DataFrame:
    """How many features of all texts are in each bucket: bucket, n (buckets without any are left out)."""
    schema = StructType([StructField("bucket", IntegerType()), StructField("n", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros, total = Zeros(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for bucket, _ in run_buckets(*encoded_terms(part.column("text"), NO_WORD), longest, buckets, zeros):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    return small_batches(texts).select("text").mapInArrow(work, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = 2, buckets: int = 10_000) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down: a model of ``buckets`` integers."""
    here, there = (bucket_counts(t, longest, buckets).withColumnRenamed("n", n) for t, n in ((docs, "s"), (target, "t")))
    total = Window.partitionBy()  # over one row per bucket
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(here, "bucket", "left").join(there, "bucket", "left").fillna(0, ["s", "t"])
    share = ((F.col("t") + 1) * (F.sum("s").over(total) + buckets).cast("double")) / ((F.col("s") + 1) * (F.sum("t").over(total) + buckets).cast("double"))
    out = np.zeros(buckets, dtype=np.int64)
    for row in both.select("bucket", F.floor(1000 * F.ln(share)).alias("gain")).collect():
        out[row.bucket] = row.gain
    return out


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 2) -> DataFrame:
    """doc_id, n_words, n_features and weight of every text; without features the weight is 0."""
    schema = StructType([
        StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("weight", LongType()),
    ])
    # the model is a few numbers a bucket, whatever the input
    model = docs.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zeros, gain = Zeros(), model.value
        for batch in batches:
            for part in slices(batch, "text"):
                codes, at, words = encoded_terms(part.column("text"), NO_WORD)
                count, total = np.zeros(len(at) - 1, np.int64), np.zeros(len(at) - 1, np.int64)
                for bucket, runs in run_buckets(codes, at, words, longest, len(gain), zeros):
                    sums = np.zeros(len(bucket) + 1, dtype=np.int64)
                    np.cumsum(gain.take(bucket), out=sums[1:])
                    total += sums[runs[1:]] - sums[runs[:-1]]
                    count += np.diff(runs)
                mean = total // np.maximum(count, 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), pa.array(count), pa.array(mean)], schema.names)

    return small_batches(docs).select("doc_id", "text").mapInArrow(work, schema)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Noise in thousandths, from the first 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank (null: not drawn).

    Of the N documents with ``least_words`` words, floor(percent * N / 100) are drawn, by
    score and then smaller doc_id; ranks are 1, 2, 3... A null or empty text has no
    features and weighs 0; a null doc_id counts as an empty one in the noise and ranks
    before others of its score. Repeated rows count and rank once each. Texts of any length
    are read whole. An empty table of documents gives an empty result, an empty target
    makes every gain follow the documents' counts alone. Other columns are ignored.
    """
    weighed = weigh(docs, gains(docs, target, longest, buckets), longest)
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resampling-scores")
    # A score is a gain (at most 1000 * ln of two 64-bit numbers) and a noise of 32 bits, so
    # there are at most some hundred thousand scores, and a row of counts for each.
    able = scored.filter(F.col("n_words") >= least_words)
    counts = able.groupBy("score").agg(F.count("*").alias("n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    drawn = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)
    above = counts.select("score", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("above"), drawn.alias("drawn")).filter("above < drawn")
    placed = scored.join(above, "score", "left")
    chance = (F.col("n_words") >= least_words) & F.col("above").isNotNull()
    keep = ["doc_id", "n_words", "n_features", "weight", "score"]
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    front = placed.filter(chance).withColumn("place", place).select(*keep, F.when(F.col("place") <= F.col("drawn"), F.col("place")).alias("rank"))
    return front.unionByName(placed.filter(~chance).select(*keep, F.lit(None).cast("long").alias("rank")))


def resampled_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of the documents that ``resample`` draws, with all their columns.

    Rows go by doc_id, so all rows of a drawn id are returned, those of a null id too.
    """
    drawn = resample(docs, target, **options).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_drawn_id"))
    return docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["_drawn_id"]), "left_semi")
