import datetime as dt
import random
import threading

import pytest
from conftest import values
from pyspark.sql import functions as F

from creditloom.operators import dedupe, joins, kpis, rows
from creditloom.operators.audit import AuditLog
from creditloom.session import side_by_side


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- headers and rows ------------------------------------------------------------


def test_headers_and_padding_columns(spark):
    df = spark.createDataFrame([("A", 1, 2, 3)], "`Loan Id ` string, `Unnamed: 28` int, balance int, _c3 int")
    assert rows.normalise_headers(df).columns == ["loan_id", "balance"]


def test_colliding_headers_raise(spark):
    df = spark.createDataFrame([(1, 2)], "`Loan Id` int, LOAN_ID int")
    with pytest.raises(ValueError, match="both become 'loan_id'"):
        rows.normalise_headers(df)


def test_blank_rows_by_key(spark):
    df = spark.createDataFrame([("A", 1), (None, None), ("B", 2), (None, 3)], "loan_id string, value int")
    assert [r[0] for r in rows.drop_blank_rows(df, ["loan_id"]).collect()] == ["A", "B"]
    assert rows.drop_blank_rows(df, ["absent"]).count() == 3
    assert rows.drop_blank_rows(df, ["loan_id", "value"]).count() == 3


def test_blank_row_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = plan(rows.drop_blank_rows(df, ["o_orderkey", "o_custkey"]))
    assert "PushedFilters: [Or(IsNotNull(o_orderkey),IsNotNull(o_custkey))]" in text


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2, 3.0)], "b int, c double")
    out = rows.union_aligned([a, b])
    assert out.columns == ["a", "b", "c"]
    assert sorted(values(out), key=lambda r: r[1]) == [("x", 1, None), (None, 2, 3.0)]
    with pytest.raises(ValueError):
        rows.union_aligned([])


def test_fixed_sample_ignores_partitioning(spark):
    df = spark.range(1000).withColumn("day", F.lit("d"))
    one = values(rows.fixed_sample(df.repartition(1), ["day", "id"], 50))
    many = values(rows.fixed_sample(df.repartition(7), ["day", "id"], 50))
    assert one == many and len(set(one)) == 50
    assert one == sorted(one, key=lambda r: r[0])
    assert values(rows.fixed_sample(df, ["day", "id"], 50, seed=1)) != one
    assert rows.fixed_sample(df.limit(10), ["day", "id"], 50).count() == 10


# --- dedupe ----------------------------------------------------------------------


def hot_rows(n=6000, seed=3):
    """A third of the rows share key 0, many of them exact copies; null keys and null times too."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(1, 1500))
        time = None if rng.random() < 0.05 else rng.randrange(40)
        out.append((key, time, rng.randrange(3)))
    return out


def test_keep_latest_and_quarantine_split_a_hot_key(spark):
    data = hot_rows()
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(13)
    best = {}
    for k, t, v in data:
        rank = (t is not None, t or 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    kept = values(dedupe.keep_latest(df, ["k"], ["t"]))
    lost = values(dedupe.quarantine(df, ["k"], ["t"]))
    assert sorted(kept, key=str) == sorted((r for _, r in best.values()), key=str)
    assert sorted(kept + lost, key=str) == sorted(data, key=str)


def test_keep_latest_last_input_row_wins_ties(spark):
    df = spark.createDataFrame([("A", 1, "x", 0), ("A", 1, "y", 1), ("B", None, "z", 2)], "k string, t int, v string, o int")
    assert sorted(values(dedupe.keep_latest(df, ["k"], ["t"], ["o"]), "k", "v")) == [("A", "y"), ("B", "z")]


def test_dedupe_limits_groups_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = plan(dedupe.keep_latest(df, ["l_orderkey"], ["l_shipdate"]))
    before, after = text.split("Exchange", 1)
    assert "WindowGroupLimit" in before and "Final" in before
    assert "WindowGroupLimit" in after and "Partial" in after


def test_rows_sharing_key_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("A", 1), ("B", 1), ("B", 2)], "k string, v int")
    assert sorted(values(dedupe.rows_sharing_key(df, ["k"])), key=str) == [("B", 1), ("B", 2), (None, 1), (None, 2)]


# --- joins -----------------------------------------------------------------------


def test_checked_join(spark):
    left = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("A", "x"), ("C", "y")], "k string, w string")
    out = joins.checked_left_join(left, right, ["k"])
    assert sorted(values(out), key=str) == [("A", 1, "x"), ("A", 2, "x"), ("B", 3, None), (None, 4, None)]
    twice = right.union(right)
    with pytest.raises(Exception, match="not unique on the right side"):
        joins.checked_left_join(left, twice, ["k"]).collect()
    with pytest.raises(Exception, match="not unique on the left side"):
        joins.checked_left_join(left, right, ["k"], "one_to_one").collect()
    assert joins.checked_left_join(left, twice, ["k"], None).count() == 6
    with pytest.raises(ValueError):
        joins.checked_left_join(left, right, ["k"], "many_to_many")


def test_key_violations_count_null_as_a_value(spark):
    df = spark.createDataFrame([(None,), (None,), ("A",)], "k string")
    assert values(joins.key_violations(df, ["k"])) == [(None, 2)]


def asof_data(spark):
    rng = random.Random(5)
    left = [
        (i, 7 if i % 3 == 0 else (None if i % 31 == 0 else rng.randrange(30)), None if i % 17 == 0 else rng.randrange(400))
        for i in range(900)
    ]
    right = {(7 if i % 3 == 0 else rng.randrange(40), rng.randrange(400)): i for i in range(700)}
    right = [(k, t, v) for (k, t), v in right.items()]
    return left, right


def asof_expected(left, right, when_missing=None):
    out = []
    for i, k, t in left:
        at = t if t is not None else when_missing
        hits = [(rt, v) for rk, rt, v in right if rk == k and at is not None and rt <= at]
        rt, v = max(hits, default=(None, None))
        out.append((i, k, t, rt, v))
    return out


def test_asof_join_against_brute_force(spark):
    left, right = asof_data(spark)
    a = spark.createDataFrame(left, "i int, k int, t int").repartition(5)
    b = spark.createDataFrame(right, "k int, rt int, v int").repartition(3)
    out = joins.asof_join(
        a, b, key="k", left_time=F.coalesce("t", F.lit(200)), right_time="rt", payload=["v"]
    )
    assert sorted(values(out)) == asof_expected(left, right, 200)


@pytest.mark.parametrize(("partitions", "batch"), [(1, 10_000), (7, 3), (60, 1)])
def test_asof_join_over_partition_and_batch_ends(spark, partitions, batch):
    left, right = asof_data(spark)
    a = spark.createDataFrame(left, "i int, k int, t int").repartition(5)
    b = spark.createDataFrame(right, "k int, rt int, v int").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = joins.asof_join(a, b, key="k", left_time="t", right_time="rt", payload=["v"], partitions=partitions)
        assert sorted(values(out)) == asof_expected(left, right)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_asof_join_of_odd_rows(spark):
    a = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, None, 5), (3, "a", None), (4, "z", 5), (5, "a", 0)], "i int, k string, t int")
    b = spark.createDataFrame([("a", 5, None), ("a", 5, 1), ("a", 1, 9), (None, 1, 1), ("b", None, 1)], "k string, rt int, v int")
    out = joins.asof_join(a, b, key="k", left_time="t", right_time="rt", payload=["v"])
    none = (None, None)
    assert sorted(values(out), key=str) == sorted([(1, "a", 5, 5, 1), (1, "a", 5, 5, 1), (2, None, 5, *none), (3, "a", None, *none), (4, "z", 5, *none), (5, "a", 0, *none)], key=str)
    assert values(joins.asof_join(a.limit(0), b, key="k", left_time="t", right_time="rt", payload=["v"])) == []
    assert {r.v for r in joins.asof_join(a, b.limit(0), key="k", left_time="t", right_time="rt", payload=["v"]).collect()} == {None}


def test_asof_join_merges_ordinary_keys_in_one_window(spark):
    """A count needs no merge, and ordinary rows do not pass Python."""
    left = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("t"))
    right = spark.range(1000).select((F.col("id") % 500).alias("k"), F.col("id").alias("rt"), F.col("id").alias("v"))
    out = joins.asof_join(left, right, key="k", left_time="t", right_time="rt", payload=["v"], partitions=4)
    expected = [(t, max(v for v in (t % 500, t % 500 + 500) if v <= t)) for t in range(2000)]
    assert sorted(values(out, "t", "v")) == expected
    counted = out.agg(F.count(F.lit(1)))
    assert values(counted) == [(2000,)]
    for frame, windows in ((out, True), (counted, False)):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert ("Window" in plan.split("EmptyRelation")[0]) == windows and "EmptyRelation" in plan


def test_asof_join_of_a_hot_key_behind_other_rows(spark):
    """The tasks of a union are numbered through; what is carried between partitions still finds its rows."""
    left = spark.range(3000).select(F.lit(7).alias("k"), F.col("id").alias("t"))
    right = spark.createDataFrame([(7, 10, 1), (7, 2500, 2)], "k int, rt long, v int")
    out = joins.asof_join(left, right, key="k", left_time="t", right_time="rt", payload=["v"], partitions=9)
    other = spark.range(0, 100, 1, 5).select(F.lit(0).alias("k"), F.lit(-1).cast("long").alias("t"), F.lit(None).cast("long").alias("rt"), F.lit(None).cast("int").alias("v"))
    # told apart here: a filter by key would leave the other rows' tasks out
    found = sorted((t, v) for k, t, v in values(other.unionByName(out), "k", "t", "v") if k == 7)
    assert found == [(t, None if t < 10 else 1 if t < 2500 else 2) for t in range(3000)]


def test_coverage_and_unmatched(spark):
    left = spark.createDataFrame([("A",), ("A",), ("B",), (None,), ("D",)], "k string")
    right = spark.createDataFrame([("A",), ("A",), ("C",), (None,)], "k string")
    assert values(joins.coverage(left, right, "k")) == [(4, 2, 0.5)]
    assert values(joins.coverage(left, right, "k", count_null_keys=True)) == [(5, 2, 0.4)]
    assert values(joins.unmatched_keys(left, right, "k")) == [("B",), ("D",)]
    assert values(joins.unmatched_keys(left, right, "k", 1)) == [("B",)]
    assert values(joins.coverage(left.limit(0), right, "k")) == [(0, 0, None)]


def test_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert joins.missing_columns(df, ["b", "c", "a", "d"]) == ["c", "d"]


# --- KPIs --------------------------------------------------------------------------


def facts(spark):
    day1, day2 = dt.date(2025, 1, 1), dt.date(2025, 3, 30)
    data = [
        (day1, 0, 1, 0, 0, None, "Unknown", 100.0, 0.0, 10.0, 0.0, "Low"),
        (day1, 45, 0, 0, 1, None, None, 300.0, 50.0, 20.0, 0.0, "High"),
        (day1, 61, 0, 1, 0, "18-25", "150,000+", 200.0, None, 5.0, 0.0, "Critical"),
        (day2, 10, 0, 0, 0, "18-25", "5,000-9,999", 50.0, -3.0, 10.0, 40.0, "Medium"),
    ]
    return spark.createDataFrame(
        data,
        "snapshot_date date, days_past_due int, is_paid_off int, is_write_off int, is_returned int, age_band string, "
        "avg_monthly_income_band string, balance double, arrears double, total_paid double, total_due_today double, "
        "risk_category string",
    )


def test_health(spark):
    first, second = kpis.portfolio_health(facts(spark)).collect()
    assert (first.accounts, first.portfolio_balance, first.avg_balance) == (3, 600.0, 200.0)
    assert first.delinquency_rate == pytest.approx(2 / 3)
    assert first.par60_rate == pytest.approx(1 / 3)
    assert first.collection_rate is None and second.collection_rate == 0.25
    assert first.avg_arrears == 50.0 and second.avg_arrears is None


def test_unknown_band_is_one_group(spark):
    by_income = kpis.kpis_by_income_band(facts(spark)).collect()
    assert [(r.income_band, r.accounts) for r in by_income][:2] == [("150,000+", 1), ("Unknown", 2)]


def test_risk_rows_are_worst_first_and_add_up(spark):
    by_risk = kpis.kpis_by_risk(facts(spark)).collect()
    assert [r.risk_category for r in by_risk] == ["Critical", "High", "Low", "Medium"]
    assert sum(r.accounts for r in by_risk) == 4


def test_pivots_and_mix(spark):
    by_age = kpis.kpis_by_age_band(facts(spark))
    out = kpis.delinquency_pivot(by_age, "age_band", ["2025-01-01", "2025-03-30"])
    assert values(out) == [("18-25", 100.0, 100.0)]
    by_income = kpis.kpis_by_income_band(facts(spark))
    order = ["5,000-9,999", "150,000+", "never"]
    out = kpis.delinquency_pivot(by_income, "income_band", ["2025-01-01"], order)
    assert values(out, "income_band") == [("5,000-9,999",), ("150,000+",)]
    mix = values(kpis.risk_mix_percent(kpis.kpis_by_risk(facts(spark))))
    assert mix[1] == (dt.date(2025, 3, 30), 0.0, 0.0, 100.0, 0.0)
    assert sum(mix[0][1:]) == pytest.approx(100)


def test_headlines(spark):
    ends = {r.kpi: (r.first_value, r.last_value) for r in kpis.first_and_last(kpis.portfolio_health(facts(spark))).collect()}
    assert ends["collection_rate"] == (None, 0.25) and ends["delinquency_rate"][1] == 1.0
    assert values(kpis.kpis_by_risk(kpis.latest_rows(facts(spark))), "risk_category") == [("Medium",)]


def test_plain_mean_of_means(spark):
    buckets = spark.createDataFrame(
        [("0 (current)", 7.0), ("31-60", 6.0), ("61-90", 5.0), ("90+", 1.0), ("no_match", 9.0), ("1-7", 3.0)],
        "dpd_bucket string, avg_nps double",
    )
    assert values(kpis.nps_spread(buckets)) == [(7.0, 4.0, 3.0)]
    assert kpis.matched_buckets(buckets).count() == 5
    bands = spark.createDataFrame(
        [("a", 0.2), ("a", 0.4), ("b", 0.9), ("Unknown", 1.0), ("c", 0.1), ("d", 0.0)],
        "age_band string, delinquency_rate double",
    )
    assert [r[0] for r in kpis.worst_segments(bands, "age_band").collect()] == ["b", "a", "c"]


def test_monitoring(spark):
    delta = kpis.row_count_delta(facts(spark)).orderBy("snapshot_date")
    assert values(delta, "rows", "previous_rows", "delta") == [(3, None, None), (1, 3, -2)]
    drift = kpis.null_rate_drift(facts(spark), ["age_band"]).orderBy("snapshot_date").collect()
    assert drift[0].drift is None and drift[1].drift == pytest.approx(-2 / 3)


def test_audit_counts_rows_in_passing(spark, tmp_path):
    ticks = iter([1.0, 3.5])
    log = AuditLog("r1", clock=lambda: next(ticks))
    with log.step("load"):
        log.watch(spark.range(10), "load").write.parquet(str(tmp_path / "t"))
    log.append_to(spark, str(tmp_path / "log"))
    got = {(r.step, r.metric): r.value for r in spark.read.json(str(tmp_path / "log")).collect()}
    assert got == {("load", "started"): 1, ("load", "rows"): 10, ("load", "duration_seconds"): 2.5}


def test_steps_side_by_side(spark, tmp_path):
    """Calls overlap, keep their order and the caller's local properties; logs of parts count their own rows."""
    meet = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("side.by.side", "yes")
    log = AuditLog("r1")
    parts = [log.part(), log.part()]

    def work(k):
        with parts[k].step(f"step{k}"):
            meet.wait()
            parts[k].watch(spark.range(10 + k), f"step{k}").write.parquet(str(tmp_path / f"t{k}"))
            meet.wait()
        return k, spark.sparkContext.getLocalProperty("side.by.side")

    assert side_by_side(spark, lambda: work(0), lambda: work(1)) == [(0, "yes"), (1, "yes")]
    for part in parts:
        log.take(part)
    kept = [r for r in values(log.frame(spark), "seq", "step", "metric", "value") if r[2] == "rows"]
    assert kept == [(1, "step0", "rows", 10.0), (4, "step1", "rows", 11.0)]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda: 1 / 0, lambda: 1)
