"""Language ID by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from creditloom.llm.stats import bucket, crc_of_id
from creditloom.llm.tables import aside, small_batches, stored
from creditloom.llm.words import slices

UNKNOWN = "und"
ORDERS = (1, 2, 3)
MULTIPLIERS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def letter_table() -> np.ndarray:
    return np.fromiter((chr(k).isalpha() for k in range(0x110000)), dtype=bool, count=0x110000)


def text_list(column: pa.Array) -> list[str]:
    """Python strings; a null is empty and broken UTF-8 is replaced."""
    try:
        return [t or "" for t in column.to_pylist()]
    except UnicodeDecodeError:
        return [(t or b"").decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]


def grams(texts: list[str], letters: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all n-grams of all texts, and the offsets of each text's.

    Letters are lower-cased; a run of other characters is one blank. A text without a
    letter has no n-gram.
    """
    low = [f" {t.lower()} " for t in texts]
    at = np.cumsum([0, *map(len, low)])
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(letters[codes], codes, np.uint32(0))
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    kept = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(keep, out=kept[1:])
    codes, at = codes[keep], kept[at]
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    blocks, owners = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            h = (h ^ codes[k : k + size]) * MULTIPLIERS[k]
            h ^= h >> np.uint32(15)
        own = owner[:size]
        good = (own == owner[n - 1 :]) & (codes[:size] != 0 if n == 1 else True)
        blocks.append((h[good] >> np.uint32(32 - bits)).astype(np.int64))
        owners.append(own[good])
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    ids, own = np.concatenate(blocks), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return ids[order], np.searchsorted(own[order], np.arange(len(texts) + 1))


def count_grams(docs: DataFrame, bits: int) -> DataFrame:
    """lang, gram and n: occurrences of each n-gram bucket in the texts of each language."""
    schema = StructType([StructField("lang", StringType()), StructField("gram", LongType()), StructField("n", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for part in slices(batch, "text", 300_000):
                ids, at = grams(text_list(part.column("text")), letters, bits)
                langs = np.asarray(part.column("lang").to_pylist(), dtype=object)
                own = np.repeat(langs, np.diff(at))
                for lang in set(langs):
                    sums[lang] = sums.get(lang, 0) + np.bincount(ids[own == lang], minlength=1 << bits)
            for lang, counts in sums.items():
                full = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full), pa.array(counts[full])], ["lang", "gram", "n"])

    return small_batches(docs).select("lang", "text").mapInArrow(work, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def equal_share(sizes: list[int], total: int) -> float:
    """The limit at which sizes, cut down to it, sum to ``total``."""
    left = float(total)
    for k, size in enumerate(sorted(sizes)):
        share = left / (len(sizes) - k)
        if size >= share:
            return share
        left -= size
    return float(max(sizes, default=0))


def learning_rows(docs: DataFrame, max_rows: int = 20_000) -> tuple[list[str], DataFrame]:
    """The languages in order, and the lang and text of the rows to learn them from.

    About ``max_rows`` rows with text and language, chosen by a hash of the id (all, when
    there are fewer): of every language as many, or all it has, and at least the row with
    the least hash.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    turn = bucket(F.col("doc_id"), 7)
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(turn).alias("least")).collect()
    if sum(r["n"] for r in found) > max_rows:
        share = equal_share([r["n"] for r in found], max_rows)
        bounds = [(r["lang"], max(share / r["n"], r["least"])) for r in found]
        # a row per language, where the model has 2^bits cells for each
        limits = docs.sparkSession.createDataFrame(bounds, "lang string, bound double")
        rows = rows.withColumn("_turn", turn).select("lang", "text", "_turn").join(F.broadcast(limits), "lang").filter(F.col("_turn") <= F.col("bound"))
    return sorted(r["lang"] for r in found), rows.select("lang", "text")


def log_shares(langs: list[str], counts: DataFrame, bits: int, smoothing: float) -> np.ndarray:
    """Log-probability of each bucket (columns) in each of some languages (rows)."""
    table = counts.filter(F.col("lang").isin(langs)).toPandas()
    matrix = np.full((len(langs), 1 << bits), smoothing)
    if len(table):
        np.add.at(matrix, (np.searchsorted(np.asarray(langs, dtype=object), table["lang"].to_numpy(dtype=object)), table["gram"].to_numpy()), table["n"].to_numpy(dtype=float))
    return np.log(matrix) - np.log(matrix.sum(axis=1, keepdims=True))


def fit(docs: DataFrame, max_rows: int = 20_000, bits: int = 14, smoothing: float = 0.5, block: int = 256) -> list[tuple[list[str], np.ndarray]]:
    """Languages and their log-probabilities by bucket, ``block`` languages to a matrix.

    So a matrix has at most ``block`` times 2^``bits`` cells, however many languages there are.
    """
    langs, rows = learning_rows(docs, max_rows)
    if not langs:
        return []
    counts = count_grams(rows, bits)
    if len(langs) > block:
        counts = stored(counts, "language-counts")
    parts = [langs[k : k + block] for k in range(0, len(langs), block)]
    return [(part, log_shares(part, counts, bits, smoothing)) for part in parts]


def identify_language(
    docs: DataFrame,
    held_out: Column | None = None,
    max_rows: int = 20_000,
    bits: int = 14,
    learn_from: DataFrame | None = None,
    keep: list[str] | None = None,
    block: int = 256,
) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and held_out (like-named columns are replaced).

    score is the posterior probability of lang_pred under equal priors. A null text or
    one without a letter gets ``und`` and score 1; so does every text when nothing could
    be learned, with score 0. Texts are read whole, however long. Rows where ``held_out``
    is true (by default crc32(doc_id as text) mod 4 = 2) are not learned from. Repeated
    rows get a row each; an empty table gives an empty result. ``keep`` names the columns
    of ``docs`` that the result has (all by default). Languages beyond ``block`` are scored
    by further matrices in the same job; any number of them can be learned.
    """
    held = held_out if held_out is not None else crc_of_id() % 4 == 2
    models = fit((learn_from if learn_from is not None else docs).filter(~held), max_rows, bits, block=block)
    added = ("lang_pred", "score", "held_out")
    rest = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    # the text travels once, apart from the row, and comes back only for a further matrix or where it is kept
    slim = [c for c in rest if c.lower() != "text"]
    row = F.struct(F.lit(0).alias("_none"), *[docs[c].alias(c) for c in slim]).alias("row")
    rows = docs.select(row, docs["text"].alias("text"), held.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(None).cast("double").alias("top"), F.lit(0.0).alias("sum"))
    texts_kept = len(slim) < len(rest)
    for k, (langs, logs) in enumerate(models or [([], np.zeros((0, 1 << bits)))]):
        rows = _scored(rows, langs, logs, bits, texts_kept or k + 1 < len(models))
    score = F.when(F.col("top").isNotNull(), 1.0 / F.col("sum")).otherwise(F.col("sum"))
    columns = [F.col("text").alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in rest]
    return rows.select(*columns, "lang_pred", score.alias("score"), "held_out")


def _scored(rows: DataFrame, langs: list[str], logs: np.ndarray, bits: int, with_text: bool) -> DataFrame:
    """The rows with lang_pred, top and sum brought up to date by one matrix of languages.

    top is the log-likelihood of lang_pred, sum that of all languages met relative to it.
    A text without n-grams has no top, and the score itself as its sum.
    """
    model = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))
    names = np.asarray([*langs, UNKNOWN], dtype=object)
    fields = [f for f in rows.schema.fields if with_text or f.name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, logs = letter_table(), model.value
        for batch in batches:
            for part in slices(batch, "text", 300_000):
                ids, at = grams(text_list(part.column("text")), letters, bits)
                best, top, sums = classify(ids, at, logs)
                before = np.asarray(part.column("top").to_numpy(zero_copy_only=False), dtype=float)
                lead, relative = np.where(np.isnan(before), -np.inf, before), part.column("sum").to_numpy()
                newer = top > lead
                high = np.where(newer, top, lead)
                known = np.isfinite(high)
                calm = np.where(known, high, 0.0)
                total = np.where(known, relative * np.exp(lead - calm) + sums * np.exp(top - calm), sums)
                name = np.where(newer, names[best], part.column("lang_pred").to_numpy(zero_copy_only=False))
                now = {"lang_pred": pa.array(name, pa.string()), "top": pa.array(high, mask=~known), "sum": pa.array(total)}
                yield pa.RecordBatch.from_arrays([now[f.name] if f.name in now else part.column(f.name) for f in fields], [f.name for f in fields])

    return small_batches(rows).mapInArrow(work, StructType(fields))


def classify(ids: np.ndarray, at: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the likeliest language (the number of languages: unknown), its
    log-likelihood, and the sum of all likelihoods relative to it.

    Without n-grams the log-likelihood is minus infinite and the sum 1; without languages it is 0.
    """
    texts, langs = len(at) - 1, logs.shape[1]
    empty = np.diff(at) == 0
    nothing = np.full(texts, -np.inf)
    if not langs:
        return np.zeros(texts, np.int64), nothing, np.where(empty, 1.0, 0.0)
    total = np.zeros((texts, langs))
    full = np.flatnonzero(~empty)
    if len(full):
        for k in range(langs):
            total[full, k] = np.add.reduceat(logs[ids, k], at[:-1][full])
    best = total.argmax(axis=1)
    sums = np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return np.where(empty, langs, best), np.where(empty, nothing, total.max(axis=1)), np.where(empty, 1.0, sums)


def known_language(docs: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` whose language is predicted with a posterior of at least ``least``.

    Rows without a letter go, null and empty texts among them. lang becomes the predicted
    language; all other columns stay. Repeated rows stay or go together; an empty table
    gives an empty result.
    """
    rows, back = aside(docs, ("lang_pred", "score", "held_out"))
    known = identify_language(rows, **options).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return known.withColumn("lang", F.col("lang_pred")).select(*rows.columns).withColumnsRenamed(back)
