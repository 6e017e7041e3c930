"""How far the sources of a language differ in their words, by a cube of tasks.

A term's share in a group is counted in billionths, with one added to every count, in
exact integers. Two groups differ by the sum over all kept terms of (p - q)^2 / q, rounded
down term by term.

Groups are dealt into group blocks and terms into term blocks, by hash. The slice of a
group block and a term block is sent to every cell (group block, group block, term block)
it belongs to; a cell's task compares its groups over its terms only; the sums over the
term axis are an aggregate. So a task's work is bounded by the sizes of blocks, not by a
language, a source or the number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from creditloom.llm.tables import small_batches, stored
from creditloom.llm.terms import encoded_terms
from creditloom.llm.words import slices

NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
GROUP_BLOCK = 16
TERM_BLOCK = 4096
SLICE = 4_000_000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: a term's occurrences and documents in a group.

    Every group has one more row without a term, also when it has no terms. A null lang,
    source or text counts as an empty one; a row is a document.
    """
    schema = StructType([StructField(c, StringType()) for c in ("lang", "source", "term")] + [StructField(c, LongType()) for c in ("n", "docs")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                names = [part.column(c).dictionary_encode() for c in ("lang", "source")]
                wide = max(1, len(names[1].dictionary))
                groups, group = np.unique(names[0].indices.to_numpy().astype(np.int64) * wide + names[1].indices.to_numpy(), return_inverse=True)
                codes, at, terms = encoded_terms(part.column("text"), NO_TERM)
                wide_terms = max(1, len(terms))
                owner = np.repeat(np.arange(part.num_rows), np.diff(at))
                pair, times = np.unique(owner * wide_terms + codes, return_counts=True)  # a term of a document
                key, back = np.unique(group[pair // wide_terms] * wide_terms + pair % wide_terms, return_inverse=True)
                n = np.bincount(back, weights=times, minlength=len(key)).astype(np.int64)
                of, term = key // wide_terms, pa.array(key % wide_terms)
                everyone = np.concatenate([of, np.arange(len(groups))])  # and the rows without a term
                yield pa.RecordBatch.from_arrays([
                    names[0].dictionary.take(pa.array(groups[everyone] // wide)), names[1].dictionary.take(pa.array(groups[everyone] % wide)),
                    pa.concat_arrays([terms.take(term), pa.nulls(len(groups), terms.type)]),
                    pa.array(np.append(n, np.zeros(len(groups), np.int64))), pa.array(np.append(np.bincount(back, minlength=len(key)), np.zeros(len(groups), np.int64))),
                ], schema.names)

    whole = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = small_batches(whole).mapInArrow(work, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> Column:
    """1 + floor(10^9 * count / total) of two SQL expressions, exact for any 64-bit counts; 1 if the total is 0."""
    wide = f"CAST({count} AS DECIMAL(19,0)) * 1000000000BD DIV nullif(CAST({total} AS DECIMAL(19,0)), 0)"
    return F.expr(f"1 + coalesce({wide}, 0)")


DIFFER = "(p - q) * (p - q) DIV q"


def cell_sums(cells: DataFrame) -> DataFrame:
    """Partial divergences of the cells: lang, source, item, value.

    A cell's rows are its slices: shares p of terms in groups, and a row without a term
    for each group, with the share of a term that the group lacks and the number of kept
    terms (``vocabulary``) that the cell answers for, which is 0 in all term blocks but one.
    """
    schema = StructType([StructField(c, StringType()) for c in ("lang", "source", "item")] + [StructField("value", LongType())])

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        head = table.filter(table["term"].is_null())
        sources, block = head["source"].to_pylist(), head["block"].to_numpy()
        absent, vocabulary = head["p"].to_numpy(), head["vocabulary"].to_numpy()
        body = table.filter(table["term"].is_valid())
        terms = body["term"].combine_chunks().dictionary_encode()
        number = {name: k for k, name in enumerate(sources)}
        names = body["source"].combine_chunks().dictionary_encode()
        row = np.asarray([number[x] for x in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()]
        p = np.repeat(absent[:, None], len(terms.dictionary), axis=1)
        p[row, terms.indices.to_numpy()] = body["p"].to_numpy()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        left, right, value = [], [], []
        for a in range(len(sources)):
            others = np.flatnonzero(block != block[a]) if low != high else np.delete(np.arange(len(sources)), a)
            if not len(others):
                continue
            q, gap = p[others], p[a][None, :] - p[others]
            base = absent[a] - absent[others]
            base = base * base // absent[others]
            # terms that neither group has count alike, wherever they are
            sums = (gap * gap // q).sum(axis=1) + (vocabulary[a] - p.shape[1]) * base
            left.append(np.full(len(others), a)), right.append(others), value.append(sums)
        take = lambda parts: pa.array(sources, pa.string()).take(pa.array(np.concatenate(parts) if parts else [], pa.int64()))
        n = sum(map(len, left))
        lang = pa.array([table["lang"][0].as_py()] * n, pa.string())
        return pa.Table.from_arrays([lang, take(left), take(right), pa.array(np.concatenate(value) if value else [], pa.int64())], schema.names)

    return cells.groupBy("lang", "low", "high", "term_block").applyInArrow(work, schema)


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the divergence of a source from each other one of its language. Part
    ``term``: the ``top`` terms that a source has more of than its language. Ranks go by
    value, then by the item's bytes. A term is kept if ``least_docs`` documents of the
    language have it. Null lang, source and text are empty ones; a group without terms
    is compared like any other; a language without kept terms differs by 0 everywhere; a
    language of one source has no pairs. Repeated rows are documents of their own, texts
    of any length are read whole, an empty table gives an empty result, and other
    columns are ignored. The result has a row per ordered pair of sources.
    """
    counts = stored(term_counts(docs), "divergence-counts")
    terms = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = stored(
        counts.filter("term IS NOT NULL").drop("docs").join(terms.filter(F.col("docs") >= least_docs).drop("docs"), ["lang", "term"]), "divergence-kept"
    )
    once = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = counts.filter("term IS NULL").select("lang", "source")
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / group_block).alias("blocks"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    heads = stored(
        groups.join(sizes, "lang").join(once, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["v", "lang_total", "total"])
        .withColumn("term_blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / term_block)))
        .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))),
        "divergence-groups",
    )

    shares = kept.join(heads, ["lang", "source"]).withColumn("p", share("n + 1", "total + v"))
    slices_ = shares.select(
        "lang", "source", "term", "p", F.lit(0).cast("long").alias("vocabulary"), "block", "blocks", F.pmod(F.xxhash64("term"), F.col("term_blocks")).alias("term_block")
    )
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("term_block")
    unfolded = heads.select("*", turn)
    empty = unfolded.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), share("1", "total + v").alias("p"),
        F.when(F.col("term_block") == 0, F.col("v")).otherwise(0).alias("vocabulary"), "block", "blocks", "term_block",
    )
    copies = slices_.unionByName(empty).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = copies.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("blocks", "other")
    pairs = cell_sums(cells).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    more = shares.withColumn("q", share("lang_n + 1", "lang_total + v")).filter("p > q").withColumn("value", F.expr(DIFFER))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    most = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).select("lang", "source", "part", "item", "value", "rank").unionByName(most)
