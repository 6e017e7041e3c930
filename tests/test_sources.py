import os
import datetime as dt
import time

import pytest
from conftest import values
from pyspark.sql import functions as F

from creditloom.operators.joins import missing_columns
from creditloom.plans import cleaning
from creditloom.plans.pipeline import Inputs, QualityGateError, Run, run_pipeline, select_stages
from creditloom.settings import Settings
from creditloom.sources import scans, sinks
from creditloom.operators import kpis
from creditloom.streaming.snapshots import ingest_new_snapshots

S = Settings()
HEADER = "LOAN_ID,DATE,SALE_DATE,MAX_PAYMENT_DATE,ARREARS,BALANCE,CLOSING_BALANCE,ACCOUNT_STATUS_L1,ACCOUNT_STATUS_L2,DAYS_PAST_DUE,CUSTOMER_AGE,TOTAL_PAID,TOTAL_DUE_TODAY"


def line(loan, paid, arrears, dpd=0, l1="Active", l2="Active", day="1/1/2025"):
    return f"{loan},{day},12/1/2024,{paid},{arrears},100,100,{l1},{l2},{dpd},31,50,100"


@pytest.fixture
def credit_dir(tmp_path):
    folder = tmp_path / "Credit Data"
    folder.mkdir()
    (folder / "Credit Data - 01-01-2025.csv").write_text(
        "\n".join([HEADER, line("L1", "1/5/2025", 10), line("L1", "1/10/2025", 0), line("L2", "1/3/2025", "5x"), "," * 12]) + "\n"
    )
    # a later file: columns in another order, one more, one unnamed
    (folder / "Credit Data - 30-03-2025.csv").write_text(
        "EXTRA," + HEADER + ",\n" + "e1," + line("L1", "3/1/2025", 7, 45, "Write Off", day="3/30/2025") + ",\n"
        "e2," + line("L3", "NA", 0, day="30-03-2025") + ",\n"
    )
    (folder / "notes.txt").write_text("no snapshot")
    return folder


def scan(spark, folder):
    return scans.scan_snapshots(spark, str(folder), S.snapshot_glob, S.snapshot_pattern, S.snapshot_format)


def test_files_in_name_order(spark, credit_dir):
    names = [p.rsplit("/", 1)[-1] for p in scans.list_files(spark, str(credit_dir), "*.csv")]
    assert len(names) == 2 and names == sorted(names)


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        scan(spark, tmp_path / "empty")


def test_name_without_a_date_raises(spark, credit_dir):
    (credit_dir / "Credit Data - soon.csv").write_text(HEADER + "\n" + line("L9", "1/1/2025", 0) + "\n")
    with pytest.raises(Exception, match="no snapshot date in file name Credit Data - soon.csv"):
        [f.collect() for f in scan(spark, credit_dir)]


def test_drifted_headers_do_not_shift_values(spark, credit_dir):
    out = cleaning.clean_all_credit(scan(spark, credit_dir))
    assert out.columns == sorted(out.columns) and "loan_age_days" in out.columns
    assert not any(c.startswith("_") for c in out.columns)
    got = sorted(values(out, "loan_id", "snapshot_date", "arrears", "extra", "days_past_due"), key=str)
    assert got == [
        ("L1", dt.date(2025, 1, 1), 0.0, None, 0.0),
        ("L1", dt.date(2025, 3, 30), 7.0, "e1", 45.0),
        ("L2", dt.date(2025, 1, 1), None, None, 0.0),
        ("L3", dt.date(2025, 3, 30), 0.0, "e2", 0.0),
    ]
    dated = {r.loan_id: r.max_payment_date for r in out.filter("snapshot_date = '2025-03-30'").collect()}
    assert dated == {"L1": dt.datetime(2025, 3, 1), "L3": None}


def test_quarantine_holds_the_older_row(spark, credit_dir):
    lost = [cleaning.quarantine_credit(f).select("loan_id", "arrears") for f in scan(spark, credit_dir)]
    assert [r for f in lost for r in values(f)] == [("L1", 10.0)]


def test_tables_keep_the_last_row_of_the_last_file(spark, tmp_path):
    folder = tmp_path / "gender"
    folder.mkdir()
    (folder / "a.csv").write_text("Loan Id,Citizenship,Gender\nA,kenya,m\nA,kenya,male\nB,,F\n")
    (folder / "b.csv").write_text("Loan Id,Citizenship,Gender\nB,côte d'ivoire,female\n,,\n")
    out = cleaning.clean_gender(scans.scan_table(spark, str(folder)))
    assert sorted(values(out)) == [("A", "Kenya", "Male"), ("B", "Côte D'Ivoire", "Female")]


def test_quotes_line_breaks_and_missing_texts(spark, tmp_path):
    folder = tmp_path / "nps"
    folder.mkdir()
    (folder / "s.csv").write_text(
        'Submission ID,Loan Id,Submitted at,"Using a scale from 0 to 10, how likely?",�Why?\n'
        's1,A,2025-07-07 13:38:00,10,"said ""fine""\nand left"\n'
        "s2,,7/8/2025,11,N/A\n"
        "s1,A,2025-07-09 13:38:00,6.5,\n"
    )
    out = cleaning.clean_nps(scans.scan_table(spark, str(folder)))
    got = {r.submission_id: r for r in out.collect()}
    assert (got["s1"].nps_score, got["s1"].nps_bucket, got["s1"].why) == (6.5, "Passive", None)
    assert (got["s2"].nps_bucket, got["s2"].why, got["s2"].loan_id) == (None, None, None)
    text = scans.scan_table(spark, str(folder)).filter("`Submitted at` LIKE '2025-07-07%'").first()
    assert text["�Why?"] == 'said "fine"\nand left'


def test_sales_without_loan_id_collapse_to_one_row(spark):
    df = spark.createDataFrame(
        [("S1", None, "1/1/2025", "1.0"), ("S2", None, "1/2/2025", "0.0"), ("S3", "A", None, None), ("S4", "A", "1/1/2024", "x"), (None, None, None, None)],
        "SALE_ID string, `Loan Id` string, SALE_DATE string, RETURNED string",
    )
    got = sorted(values(cleaning.clean_sales(df), "sale_id", "loan_id", "returned"))
    assert got == [("S2", None, False), ("S4", "A", None)]


def test_reload_touches_only_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    df = spark.createDataFrame([("A", "d1", 1), ("B", "d2", 2)], "k string, d string, v int")
    sinks.write_layer(df, path, partition_by="d")
    fixed = df.filter("d = 'd2'").withColumn("v", F.lit(9))
    sinks.write_layer(fixed, path, partition_by="d", keep_other_partitions=True)
    sinks.write_layer(df.limit(0), path, partition_by="d", keep_other_partitions=True)
    assert sorted(values(spark.read.parquet(path), "k", "v")) == [("A", 1), ("B", 9)]
    # a full load leaves nothing of the layer before it
    sinks.write_layer(fixed, path, partition_by="d")
    assert values(spark.read.parquet(path), "k", "v") == [("B", 9)]


def test_stored_tables_join_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wh")
    df = spark.range(100).withColumnRenamed("id", "loan_id").withColumn("v", F.lit(1))
    sinks.register_tables(spark, {"a": df, "b": df}, database="wh", bucket_by=(4, "loan_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("wh.a").join(spark.table("wh.b"), "loan_id")
        assert joined.count() == 100
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE wh CASCADE")


def test_stored_facts_are_read_by_snapshot(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wp")
    try:
        facts = spark.range(40).selectExpr("id AS loan_id", "date_add(DATE '2025-01-01', CAST(id % 4 AS INT)) AS snapshot_date")
        sinks.register_tables(spark, {"fct": facts}, database="wp", partition_by={"fct": "snapshot_date"})
        newest = kpis.latest_rows(spark.table("wp.fct"))
        assert newest.count() == 10
        assert "PartitionFilters: [isnotnull(snapshot_date" in newest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP DATABASE wp CASCADE")


# --- incremental pick-up -------------------------------------------------------------


def test_late_file_adds_only_its_snapshot(spark, credit_dir, tmp_path):
    layer, mark = str(tmp_path / "layer"), str(tmp_path / "mark")

    def load():
        ingest_new_snapshots(spark, str(credit_dir), layer, mark)
        out = scans.read_layer(spark, layer, merge_schema=True)
        return out, {str(r.snapshot_date): r["count"] for r in out.groupBy("snapshot_date").count().collect()}

    assert load()[1] == {"2025-01-01": 2, "2025-03-30": 2}
    assert load()[1] == {"2025-01-01": 2, "2025-03-30": 2}
    (credit_dir / "Credit Data - 30-06-2025.csv").write_text(HEADER + ",LATE\n" + line("L8", "6/1/2025", 1) + ",z\n")
    out, counts = load()
    assert counts == {"2025-01-01": 2, "2025-03-30": 2, "2025-06-30": 1}
    assert out.filter("late = 'z'").count() == 1


def test_old_and_corrected_files_are_loaded(spark, credit_dir, tmp_path):
    layer, mark, lost, audit = (str(tmp_path / n) for n in ("layer", "mark", "lost", "audit"))

    def load():
        days = ingest_new_snapshots(spark, str(credit_dir), layer, mark, quarantine=lost, audit=audit, days_per_batch=1)
        rows = scans.read_layer(spark, layer, merge_schema=True).select("snapshot_date", "loan_id", "arrears").collect()
        return [str(d) for d in days], {(str(r[0]), r[1]): r[2] for r in rows}

    assert load()[0] == ["2025-01-01", "2025-03-30"]
    assert load()[0] == []
    late = credit_dir / "Credit Data - 30-09-2024.csv"
    late.write_text(HEADER + "\n" + line("OLD", "9/1/2024", 7) + "\n" + line("OLD", "8/1/2024", 6) + "\n")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    days, rows = load()
    assert days == ["2024-09-30"] and ("2024-09-30", "OLD") in rows and len(rows) == 5
    assert spark.read.parquet(lost).filter("loan_id = 'OLD'").count() == 1
    late.write_text(HEADER + "\n" + line("NEW", "9/1/2024", 70) + "\n")
    days, rows = load()
    assert days == ["2024-09-30"] and ("2024-09-30", "NEW") in rows and ("2024-09-30", "OLD") not in rows and len(rows) == 5
    assert load()[0] == []
    counts = spark.read.json(audit).groupBy("metric").count().collect()
    assert {"in_rows", "out_rows", "rejected_rows"} <= {r.metric for r in counts}


# --- the whole run ----------------------------------------------------------------------


@pytest.fixture
def inputs(tmp_path, credit_dir):
    tables = {
        "sales": "SALE_ID,Loan Id,SALE_DATE,RETURN_DATE,RETURNED,CASH_PRICE,LOAN_PRICE\n"
        "S1,L1,1/1/2024,,0.0,10,12\nS2,L2,1/2/2024,,1.0,10,12\nS3,L2,1/3/2024,,0.0,11,12\n,,,,,,\n",
        "gender": "Loan Id,Citizenship,Gender\nL1,kenyan,male\nL2,kenyan,F\n,,\n",
        "dob": "_id,provider,date_of_birth,Loan Id ,createdAt UTC\n"
        "1,p,1990-01-01T00:00:00+03:00,L1,2024-01-01T09:39:38.340Z\n2,p,1980-01-01T00:00:00+03:00,L1,2024-02-01T09:39:38.340Z\n",
        "income": "Loan Id,Duration,Received,Persons Received From Total,Banks Received,Paybills Received Others\n"
        "L1,12,120000,1,2,3\nL2,0,5,1,2,3\n",
        "nps": "Submission ID,Respondent ID,Loan Id,Submitted at,Using a scale from 0 to 10?\n"
        "s1,r1,L1,2025-02-01 10:00:00,9\ns2,r2,L1,2025-04-01 10:00:00,3\ns3,r3,L2,2024-12-01 10:00:00,8\ns4,r4,L2,,7\n",
    }
    for name, text in tables.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.csv").write_text(text)
    return Inputs(str(credit_dir), *[str(tmp_path / n) for n in ("sales", "gender", "dob", "income", "nps")])


def test_a_run_leaves_no_shuffle_files_and_no_counts(spark, inputs, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for name in (files.apply(k).getName() for k in range(files.size())) if name.startswith("shuffle_")}

    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffled()
    was = spark.conf.get(key, None)
    run = Run(spark, inputs, str(tmp_path / "out"), dt.date(2025, 4, 30))
    run_pipeline(run, only=["profile", "clean"])
    until = time.monotonic() + 10  # files are deleted in the background
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(key, None) == was
    assert sorted(os.listdir(tmp_path / "out")) == ["audit", "cleaned", "outputs", "profiles", "staging"]
    kept = values(run.layer("staging/sales"), "loan_id", "cash_price")
    assert sorted(kept) == [("L1", 10.0), ("L2", 11.0)] and values(run.layer("quarantine/sales"), "loan_id", "cash_price") == [("L2", 10.0)]


def test_whole_run(spark, inputs, tmp_path):
    run = Run(spark, inputs, str(tmp_path / "out"), dt.date(2025, 4, 30))
    assert run_pipeline(run) == ["profile", "clean", "features", "warehouse", "quality", "analysis"]

    features = run.layer("curated/portfolio_features")
    got = {(r.loan_id, str(r.snapshot_date)): r for r in features.collect()}
    assert len(got) == 4 and not missing_columns(features, S.expected_columns)
    one = got["L1", "2025-03-30"]
    assert (one.risk_category, one.is_write_off, one.days_past_due, one.age_band) == ("Critical", 1, 45, "36-45" if one.customer_age_years < 46 else "46-55")
    assert one.avg_monthly_income == 10000.0 and one.avg_monthly_income_band == "10,000-19,999"
    assert got["L2", "2025-01-01"].avg_monthly_income is None
    assert one.sale_date == dt.datetime(2024, 12, 1) and one.customer_sale_date == dt.datetime(2024, 1, 1)

    joined = {r.submission_id: str(r.snapshot_date) for r in run.layer("curated/credit_x_nps").collect()}
    assert joined == {"s1": "2025-01-01", "s2": "2025-03-30", "s3": "None", "s4": "2025-01-01"}

    checks = {r.name: r.status for r in spark.read.json(run.path("outputs/dq_results")).collect()}
    assert len(checks) == 11 and checks["REFERENTIAL_INTEGRITY"] == "FAIL" and checks["UNIQUENESS"] == "PASS"
    alerts = spark.read.json(run.path("outputs/alerts")).collect()
    assert [a.title for a in alerts] == ["DQ FAIL: REFERENTIAL_INTEGRITY"]

    counts = {r.table_name: r.rows for r in spark.read.json(run.path("outputs/table_counts")).collect()}
    assert counts == {"fct_portfolio_snapshot": 4, "dim_customer": 2, "fct_sales": 2, "fct_nps": 4}
    assert spark.sql("SELECT sum(accounts) FROM v_portfolio_by_risk").first()[0] == 4

    profiles = {(r.dataset, r.column_name): r for r in run.layer("profiles").collect()}
    assert profiles["credit_2025-01-01", "LOAN_ID"].null_count == 1
    assert profiles["credit_2025-01-01", "BALANCE"].mean == 100.0
    assert profiles["sales_dob", "Loan Id "].top_values == {"L1": 2}

    audit = spark.read.json(run.path("audit")).filter("step = 'clean_credit'").groupBy("metric").agg(F.sum("value"))
    rows = dict(values(audit))
    assert rows["in_rows"] == 6 and rows["out_rows"] == 4
    assert values(run.layer("quarantine/credit"), "loan_id", "arrears") == [("L1", 10.0)]
    trend = spark.read.option("header", True).csv(run.path("outputs/kpi_trend"))
    assert trend.count() == 8

    # the gate: the layers are there, so quality can run alone, and it stops the run
    strict = Run(spark, inputs, str(tmp_path / "out"), dt.date(2025, 4, 30), fail_on_quality=True)
    with pytest.raises(QualityGateError):
        run_pipeline(strict, only=["quality"])


def test_stage_selection():
    assert select_stages(["features", "clean"]) == ["clean", "features"]
    assert select_stages(skip=["profile"])[0] == "clean"
    with pytest.raises(ValueError):
        select_stages(["nonsense"])
