"""A key on a third of all rows: plans split it, results stay whole."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from creditloom.operators import dedupe, joins, profiling, rows
from creditloom.plans import cleaning

N = 300_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    # with few partitions the median one holds an eighth of the other rows
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(50_000)))
    spark.range(0, N, 1, 16).select(
        key.alias("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("t"), F.col("id").alias("i")
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dates(spark, hot, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "dates")
    times = F.explode(F.array(*[F.lit(t) for t in (0, 300, 600)]))
    hot.select("k").distinct().select("k", times.alias("rt")).withColumn(
        "p", F.col("rt") + 1
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_partitions(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_split_the_hot_key(spark, hot, dates, small_partitions):
    joined = joins.checked_left_join(hot, dates.filter("rt = 0"), ["k"])
    out = joined.agg(F.count("p").alias("n"), F.sum("i").alias("s"))
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert values(out) == [(N, N * (N - 1) // 2)]


def test_asof_join_spreads_the_hot_key(spark, hot):
    """2,000 times a key, of which no pairs are formed, and a key on a third of all rows in many partitions."""
    few = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("k")
    times = spark.range(2000).select(few, F.col("id").alias("rt"), (F.col("id") * 2).alias("p"))
    matched = joins.asof_join(hot, times, key="k", left_time="t", right_time="rt", payload=["p"], partitions=30)
    known = F.col("k") < 10
    right = F.when(known, (F.col("rt") == F.col("t")) & (F.col("p") == 2 * F.col("t"))).otherwise(F.col("rt").isNull() & F.col("p").isNull())
    assert values(matched.agg(F.count(F.lit(1)), F.count_if(right), F.count_if(known) > N / 4)) == [(N, N, True)]
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "rangepartitioning" in plan
    share = matched.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert share < N / 6


def test_dedupe_keeps_all_rows_of_the_hot_key(hot):
    kept = dedupe.keep_latest(hot, ["k"], ["t"])
    lost = dedupe.quarantine(hot, ["k"], ["t"])
    ids = kept.select("i").union(lost.select("i"))
    assert ids.count() == ids.distinct().count() == N
    newest = hot.groupBy("k").agg(F.max("t").alias("t"))
    assert kept.select("k", "t").exceptAll(newest).isEmpty() and kept.count() == newest.count()


def test_quarantine_spreads_copies_of_one_row(spark):
    """Exact copies share key and content; the input split still tells them apart."""
    copies = spark.range(0, 1000, 1, 10).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert dedupe.quarantine(copies, ["k"], []).count() == 999
    assert dedupe.keep_latest(copies, ["k"], []).count() == 1


def test_counts_on_a_hot_value(hot):
    assert values(profiling.exact_medians(hot, ["k", "i"]).orderBy("column_name"), "median")[0][0] == (N - 1) / 2
    top = profiling.top_values(hot.select(F.col("k").cast("string").alias("k")), top=1).first()
    assert top.value == "7" and top.n >= N // 3
    assert joins.coverage(hot, hot.filter("k = 7"), "k").first().matched == top.n
    assert rows.fixed_sample(hot, ["i"], 777).count() == 777


def test_quarantine_shuffles_its_rows_once(spark, hot, small_partitions):
    """Keys are counted, then whole rows are shuffled by key; only keys with very many rows are ranked apart."""
    few = hot.filter("k <> 7")
    lost = dedupe.quarantine(few, ["k"], ["t"], slice_rows=1000)
    assert len(values(lost)) == few.count() - few.select("k").distinct().count()
    final = lost._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the list of hot keys is empty, so its count is gone from the final plan
    assert final.count("Exchange hashpartitioning(k") == 1 and "_slice" not in final
    # null keys and exact copies among the hot ones
    odd = hot.select(F.when(F.col("k") != 7, F.col("k")).alias("k"), "t")
    lost = dedupe.quarantine(odd, ["k"], ["t"], slice_rows=1000)
    assert lost.count() == N - odd.distinct().select("k").distinct().count()
    assert lost.unionByName(dedupe.keep_latest(odd, ["k"], ["t"])).exceptAll(odd).isEmpty()


def test_outcomes_shuffle_their_rows_once(spark, hot, small_partitions):
    """Rows are ranked where one shuffle by key puts them; only keys with very many rows are ranked in slices."""
    best = [F.col(c).desc_nulls_last() for c in ("t", "i")]
    few = hot.filter("k <> 7")
    out = dedupe.ranked_outcomes(few, ["k"], best, ["t", "i"], 8, "o", slice_rows=1000)
    assert values(out.groupBy("o").count().orderBy("o"))[0] == ("kept", few.select("k").distinct().count())
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(k") == final.count("Exchange ") == 1 and "_slice" not in final
    # a key with very many rows, null this time, and every row is there once
    odd = hot.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    both = dedupe.ranked_outcomes(odd, ["k"], best, ["t", "i"], 8, "o", slice_rows=1000)
    kept = dedupe.keep_latest(odd, ["k"], ["t"], ["i"])
    assert both.filter("o = 'kept'").drop("o").exceptAll(kept).isEmpty() and both.drop("o").exceptAll(odd).isEmpty()
    assert values(both.groupBy("o").count().orderBy("o")) == [("kept", kept.count()), ("rejected", N - kept.count())]


def test_ties_are_decided_in_the_order_of_the_first_ranking(spark, small_partitions):
    """The rows that tie are aggregated as the first ranking left them: one shuffle, and one sort behind it."""
    rows = [(None if k % 31 == 0 else f"L{k % 30}", f"{1 + k % 3}/1/2024", None if k % 5 == 0 else str(k % 40), str(k % 7)) for k in range(900)]
    raw = spark.createDataFrame(rows, "LOAN_ID string, SALE_DATE string, CASH_PRICE string, SALE_ID string")
    raw = raw.repartition(5)
    source = cleaning.SOURCES["sales"]
    out = cleaning.clean(raw, source)
    typed = cleaning._typed(cleaning._keyed(raw, source), source)
    best = dedupe.keep_latest(typed, ["loan_id"], ["sale_date"])
    assert sorted(values(out, *best.columns), key=str) == sorted(values(best), key=str) and out.count() == 31
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    behind = final[: final.index("hashpartitioning(loan_id")]
    assert behind.count("Sort [") == 1 and "SortAggregate" in behind
