"""Quality rules: fixed rules first, then boosted trees over document statistics.

The trees are fitted on labelled documents, flattened into numpy node arrays and
scored for whole Arrow batches. Chosen features are monotonic: more symbols, repeated
lines or repeated words never raise a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from creditloom.llm.stats import document_statistics, features, labelled_sample
from creditloom.llm.tables import stored
from creditloom.llm.trees import Forest, boost, flatten

MONOTONE = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "echo_share": -1, "distinct_share": 1}


def fit(statistics: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees: int = 60, depth: int = 3) -> Forest:
    """Boosted trees for quality 1, from at most ``max_rows`` labelled documents.

    The sample is chosen by a hash of the id, so that it is the same in every run.
    Without labels of both classes the forest is a constant.
    """
    names = list(features())
    sample = labelled_sample(statistics, labels, "quality", max_rows).select(
        *[c.cast("double").alias(n) for n, c in features().items()], "label"
    )
    rows = sample.toPandas()
    x, y = rows[names].to_numpy(dtype=float).reshape(-1, len(names)), rows["label"].to_numpy(dtype=float)
    grown, base = boost(x, y, [MONOTONE.get(n, 0) for n in names], trees, depth)
    return flatten(grown, depth, base)


def scored(statistics: DataFrame, forest: Forest) -> DataFrame:
    """The statistics with a column ``score``, the forest's probability of quality 1."""
    names = list(features())
    wide = statistics.select("*", F.array(*[c.cast("double") for c in features().values()]).alias("_x"))
    schema = StructType([*statistics.schema.fields, StructField("score", DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))
            score = np.concatenate([forest.score(x[k : k + 4096]) for k in range(0, len(x), 4096)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*batch.schema.names[:-1], "score"])

    return wide.mapInArrow(work, schema)


def quality_rules(
    docs: DataFrame, labels: DataFrame, min_words: int = 10, max_repeat_percent: int = 20, threshold: float = 0.5, max_rows: int = 20_000
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, base_failed, score, kept.

    base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` of
    them in 5-word windows that occur twice or more. kept: not base_failed and a score
    of at least ``threshold``. Null and empty texts have no words and fail the base
    rules; repeated rows get a row each; an empty table gives an empty result.
    """
    statistics = stored(document_statistics(docs), "quality-statistics")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (
        scored(statistics, fit(statistics, labels, max_rows))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )
