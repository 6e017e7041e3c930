"""Reading the given tables, and scratch tables that end a plan's lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.session import scratch_dir


BATCH_ROWS = "1000"


def small_batches(docs: DataFrame) -> DataFrame:
    """The frame, in a session that hands texts to tasks a thousand rows at a time.

    Spark's default of ten thousand is meant for narrow rows; of documents it makes
    buffers of tens of megabytes, several to a task.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """The frame's rows, written once to the shared scratch folder and read from there.

    A lost executor costs a repeat of its own tasks only, and later steps see the same
    rows whatever is repeated.
    """
    path = scratch_dir(frame.sparkSession, label)
    frame.write.option("compression", compression).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """The frame with the named columns out of the way, and how to name them back."""
    back = {f"_aside_{k}": c for k, c in enumerate(docs.columns) if c.lower() in names}
    return docs.withColumnsRenamed({c: k for k, c in back.items()}), back
