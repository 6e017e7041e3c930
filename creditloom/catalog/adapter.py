"""The given star-schema tables seen as loan-book tables.

The mapping uses integer and decimal arithmetic only, so that results are the
same in any SQL engine. See FIXTURES.md, section 4.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.settings import Settings
from creditloom.sources.sinks import COMPRESSED_ROWS

SNAPSHOTS = ("1997-12-31", "1998-12-31", "1999-12-31", "2000-12-31", "2001-12-31")
AS_OF = dt.date(2002, 3, 1)
SETTINGS = Settings()

MISFILED_EVERY = 50  # every 50th customer record carries a loan id that no loan has


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(value: Column, factor: Column | int | None = None) -> Column:
    cents = value.cast("decimal(18,2)")
    return cents if factor is None else (cents * factor).cast("decimal(20,2)")


def credit(
    spark: SparkSession, sf_dir: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row per order and reporting date from the order date on.

    The few reporting dates are literals unfolded in place: no join. ``prepare`` is
    applied to the orders first.
    """
    orders = table(spark, sf_dir, "orders")
    if prepare:
        orders = prepare(orders)
    order, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    dates = F.array(*[F.lit(s).cast("date") for s in SNAPSHOTS])
    balance = _money(F.col("o_totalprice"))
    base = orders.select(
        order.alias("loan_id"),
        F.explode(dates).alias("snapshot_date"),
        day.alias("sale_date"),
        F.when((status == "F") & (priority == "1-URGENT"), "Write Off")
        .when(status == "F", "Paid Off Loan")
        .when((status == "P") & (priority == "5-LOW"), "Returned")
        .otherwise("Existing Active")
        .alias("account_status_l1"),
        F.when(priority == "2-HIGH", "PAR 30")
        .when(priority == "3-MEDIUM", "PAR 7")
        .otherwise("Active")
        .alias("account_status_l2"),
        balance.alias("balance"),
    )
    days = ((F.col("loan_id") * 31 + F.datediff("snapshot_date", "sale_date")) % 240 - 120).cast(
        "bigint"
    )
    return base.filter("sale_date <= snapshot_date").select(
        "loan_id",
        "snapshot_date",
        F.col("snapshot_date").alias("date"),
        "sale_date",
        "account_status_l1",
        "account_status_l2",
        days.alias("days_past_due"),
        "balance",
        F.when(days > 0, F.col("balance"))
        .otherwise(F.lit(0).cast("decimal(18,2)"))
        .alias("arrears"),
        _money(F.col("balance"), 10).alias("total_due_today"),
        _money(F.col("balance"), (F.col("loan_id") % 11).cast("int")).alias("total_paid"),
        F.date_sub("snapshot_date", (F.col("loan_id") % 28).cast("int")).alias("max_payment_date"),
        F.col("balance").alias("closing_balance"),
    )


def customer_loan(order: Column) -> Column:
    """The loan id on the customer record of an order; misfiled ones are negative."""
    return F.when(order % MISFILED_EVERY == 0, -order).otherwise(order)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has a customer record."""
    key = F.col("c_custkey")
    who = table(spark, sf_dir, "customer").select(
        key,
        F.when(
            key % 5 != 0,
            F.date_add(F.lit("1935-01-01").cast("date"), (key * 37 % 20000).cast("int")),
        ).alias("date_of_birth"),
        _money(F.abs(F.col("c_acctbal").cast("decimal(18,2)")), 20).alias("received"),
        (key % 13).alias("duration"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("citizenship"),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(who, F.col("o_custkey") == key, "left").select(
        customer_loan(F.col("o_orderkey")).alias("loan_id"),
        F.to_date("o_orderdate").alias("sale_date"),
        "date_of_birth",
        "received",
        "duration",
        "gender",
        "citizenship",
    )


def export_files(rows: DataFrame, name: str, folder: str, compressed: bool = False) -> None:
    """Writes rows as CSV files named by the text column ``name``, as another system would leave them.

    Spark names its files itself, so they are written elsewhere and moved. A name gets as many
    files as the rows have partitions with it; all but the first have a number before the suffix.
    ``compressed`` files have ``.gz`` behind their name and are kept short, since one task reads each.
    """
    spark = rows.sparkSession
    draft = f"{folder}-draft-{uuid.uuid4().hex[:8]}"
    writer = rows.write.partitionBy(name).option("header", True).option("escape", '"')
    if compressed:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", COMPRESSED_ROWS)
    writer.csv(draft)
    jvm, hadoop = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    files = jvm.Path(draft).getFileSystem(hadoop)
    files.mkdirs(jvm.Path(folder))
    for value in files.listStatus(jvm.Path(draft)):
        if not value.isDirectory():
            continue
        title = value.getPath().getName().split("=", 1)[1]
        parts = [p.getPath() for p in files.listStatus(value.getPath())]
        for k, part in enumerate(sorted((p for p in parts if p.getName().startswith("part-")), key=str)):
            stem, dot, suffix = title.rpartition(".")
            target = jvm.Path(f"{folder}/{stem}{f' {k + 1}' if k else ''}{dot}{suffix}{'.gz' if compressed else ''}")
            files.delete(target, False)
            files.rename(part, target)


def delete_files(spark: SparkSession, glob: str) -> None:
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(glob).getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(jvm.Path(glob)):
        files.delete(found.getPath(), False)


LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_TIES = ("l_partkey", "l_suppkey", "l_extendedprice")


def nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey submission per order line; score 11 is out of range on purpose."""
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, *LINE_TIES, "l_shipdate", "l_quantity"
    )
    # line numbers repeat within an order, so a line's place among its equals is in its id
    place = F.row_number().over(
        Window.partitionBy(*LINE_KEY).orderBy(*[F.desc(c) for c in ("l_shipdate", *LINE_TIES, "l_quantity")])
    )
    return lines.withColumn("place", place).select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000 + F.col("place")).alias("submission_id"),
        F.col("l_orderkey").alias("loan_id"),
        F.to_date("l_shipdate").alias("submitted_at"),
        (F.col("l_quantity").cast("int") % 12).alias("nps_score"),
    )
