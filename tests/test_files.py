"""Files at scale: headers in one job, filters that reach the reader, one pass for both outcomes, versions."""

import gzip
import os
import random
import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from creditloom.catalog import adapter
from creditloom.plans import cleaning
from creditloom.plans.views import create_stored_views, survey_sql
from creditloom.settings import Settings
from creditloom.sources import scans, sinks
from creditloom.streaming.versions import VersionedSnapshots


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f {k}.csv").write_text(("a,b" if k % 2 else "b,a,,\"q\n\"\"r\"\"\",a") + "\n1,2\n" * 50)
    (tmp_path / "empty.csv").write_text("")
    paths = scans.list_files(spark, str(tmp_path))
    spark.sparkContext.setJobGroup("headers", "")
    try:
        rows = scans.header_lines(spark, paths).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # the reader lists more than 32 paths in a job of its own
    assert len(rows) == 40 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 2
    assert {scans.header_names(r.header) for r in rows} == {("a", "b"), ("b", "a1", "_c2", 'q\n"r"', "a4")}
    frames = scans.read_csv_text(spark, paths, multi_line=True)
    assert sorted(f.count() for f in frames) == [1000, 1000]


def test_header_names_are_those_of_the_scan(spark, tmp_path):
    for k, header in enumerate(["a,A,a", ",x,", '"say ""hi""",b', "one"]):
        path = tmp_path / f"h{k}.csv"
        path.write_text(header + "\n1,2,3\n")
        (row,) = scans.header_lines(spark, [str(path)]).collect()
        assert list(scans.header_names(row.header)) == spark.read.option("header", True).option("escape", '"').csv(str(path)).columns


def test_other_encodings(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("Loan Id,Straße\nA,Müller\n".encode("latin-1"))
    out = scans.scan_table(spark, str(tmp_path), encoding="ISO-8859-1")
    assert values(out, "Straße") == [("Müller",)]
    assert Settings.from_mapping({"ingest": {"csv_read": {"encoding": "latin-1"}}}).encoding == "latin-1"


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_blank_rows_are_left_out_by_the_reader(spark, tmp_path, kind):
    rows = [(f"L{k}" if k % 3 else None, "x", str(k)) for k in range(30)] + [("L1", "y", "last")]
    df = spark.createDataFrame(rows, "`Loan Id` string, Citizenship string, Gender string").coalesce(1)
    path = str(tmp_path / kind)
    df.write.parquet(path) if kind == "parquet" else sinks.write_csv(df, path)
    raw = scans.scan_table(spark, path, file_format=kind, multi_line=False, present=("loan_id",))
    out = cleaning.clean_gender(raw)
    pushed = r"PushedFilters: \[IsNotNull\(`?Loan Id`?\)\]"
    assert re.search(pushed, plan_of(out))
    got = {r.loan_id: r.gender for r in out.collect()}
    assert len(got) == 20 and got["L1"] == "Last"
    if kind == "parquet":
        # also without being told, because the row's place does not stand in the way
        assert re.search(pushed, plan_of(cleaning.clean_gender(scans.scan_table(spark, path, file_format=kind))))


def test_losers_are_not_parsed(spark):
    df = spark.createDataFrame([("A", "1/1/2025", "x")], "LOAN_ID string, Max_Payment_Date string, SALE_DATE string")
    text = plan_of(cleaning.clean_credit_snapshot(df, "2025-01-01"))
    ahead = text[text.index("Exchange") :]
    # behind the first shuffle, seen from the reader, only the deciding date is parsed
    assert "_order_max_payment_date" in ahead and "sale_date" in ahead
    assert not any("timestamp" in line and " AS sale_date" in line for line in ahead.splitlines())


@pytest.mark.parametrize("slices", [1, 5])
def test_kept_and_rejected_in_one_pass(spark, tmp_path, slices):
    draw = random.Random(slices)
    rows = [(f"L{draw.randrange(30)}" if draw.random() < 0.9 else None, f"{draw.randrange(1, 12)}/1/2024", str(draw.randrange(100)), str(k)) for k in range(600)]
    df = spark.createDataFrame(rows, "`Loan Id` string, SALE_DATE string, CASH_PRICE string, SALE_ID string").repartition(7)
    path = str(tmp_path / "sales")
    sinks.write_csv(df, path)
    source = cleaning.SOURCES["sales"]
    for raw in (df, scans.scan_table(spark, path, multi_line=False)):
        both = cleaning.sorted_out(raw, source, slices=slices)
        columns = [c for c in both.columns if c != cleaning.OUTCOME]
        kept = sorted(values(both.filter("outcome = 'kept'"), *columns), key=str)
        lost = sorted(values(both.filter("outcome = 'rejected'"), *columns), key=str)
        assert kept == sorted(values(cleaning.clean(raw, source), *columns), key=str)
        assert lost == sorted(values(cleaning.rejected(raw, source), *columns), key=str)
        assert len(kept) == 31 and len(kept) + len(lost) == 600
    both.collect()
    final = plan_of(both).split("== Initial Plan ==")[0]
    assert final.count("FileScan csv") == 1


HEADER = "LOAN_ID,MAX_PAYMENT_DATE,BALANCE"


def test_versions_follow_the_folder(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()

    def put(day, *rows):
        (folder / f"Credit Data - {day}.csv").write_text("\n".join([HEADER, *rows]) + "\n")

    layer = VersionedSnapshots(spark, str(tmp_path / "layer"))

    def state(outcome="kept"):
        return sorted((str(r.snapshot_date), r.loan_id, r.balance) for r in layer.read(outcome).collect())

    with pytest.raises(FileNotFoundError):
        layer.read()
    put("01-02-2025", "A,1/2/2025,1", "A,1/1/2025,0", "B,1/1/2025,2")
    put("01-03-2025", "A,1/3/2025,3")
    assert [str(d) for d in layer.sync(str(folder), days_per_batch=1)] == ["2025-02-01", "2025-03-01"]
    assert layer.sync(str(folder)) == []
    assert state() == [("2025-02-01", "A", 1.0), ("2025-02-01", "B", 2.0), ("2025-03-01", "A", 3.0)]
    assert state("rejected") == [("2025-02-01", "A", 0.0)]

    # corrected, so that nothing is rejected any more; old, and late; deleted
    put("01-02-2025", "A,1/2/2025,10")
    put("01-01-2024", "Z,1/1/2024,9")
    (folder / "Credit Data - 01-03-2025.csv").unlink()
    held = layer.read()
    assert [str(d) for d in layer.sync(str(folder))] == ["2024-01-01", "2025-02-01", "2025-03-01"]
    assert state() == [("2024-01-01", "Z", 9.0), ("2025-02-01", "A", 10.0)] and state("rejected") == []
    # a reader from before the switch keeps its rows
    assert held.count() == 3

    # rows of a load that never reached the manifest are not seen
    layer.spark.createDataFrame([("X", 1.0)], "loan_id string, balance double").write.parquet(f"{layer.path}/data/load=999999-lost/outcome=kept/snapshot_date=2024-01-01")
    assert [r[1] for r in state()] == ["Z", "A"]
    put("01-03-2025", "A,1/3/2025,3")
    assert [str(d) for d in layer.sync(str(folder))] == ["2025-03-01"] and len(state()) == 3


def test_stored_views_equal_the_frames(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wv")
    try:
        facts = spark.range(200).selectExpr(
            "id % 40 AS loan_id", "date_add(DATE '2025-01-01', CAST(id DIV 40 AS INT) * 30) AS snapshot_date", "CAST(id % 90 AS BIGINT) AS days_past_due",
            "CAST(id % 2 AS INT) AS is_write_off", "CAST(id % 3 = 0 AS INT) AS is_paid_off", "0 AS is_returned", "CAST(id AS DECIMAL(18,2)) AS total_paid",
            "CAST(id % 7 AS DECIMAL(18,2)) AS total_due_today", "CAST(id % 5 AS DOUBLE) AS arrears", "CAST(id * 3 AS DECIMAL(18,2)) AS balance",
            "CASE WHEN id % 4 > 0 THEN '18-25' END AS age_band", "CAST(NULL AS STRING) AS avg_monthly_income_band", "element_at(array('Low', 'High', 'Odd'), CAST(id % 3 AS INT) + 1) AS risk_category",
            "'x' AS account_status_l2",
        )
        survey = spark.range(90).selectExpr(
            "id AS submission_id", "CASE WHEN id % 9 > 0 THEN id % 50 END AS loan_id", "CAST(id % 11 AS INT) AS nps_score", "'b' AS nps_bucket",
            "CASE WHEN id % 8 > 0 THEN CAST(date_add(DATE '2024-12-20', CAST(id * 2 AS INT)) AS TIMESTAMP_NTZ) END AS submitted_at",
        )
        sinks.register_tables(spark, {"fct_portfolio_snapshot": facts, "fct_nps": survey}, database="wv", partition_by={"fct_portfolio_snapshot": "snapshot_date"})
        from creditloom.operators import kpis
        from creditloom.plans.features import credit_x_nps

        stored = spark.table("wv.fct_portfolio_snapshot")
        frames = {
            "v_portfolio_health": kpis.portfolio_health(stored), "v_portfolio_by_age_band": kpis.kpis_by_age_band(stored), "v_portfolio_by_risk": kpis.kpis_by_risk(stored),
            "v_portfolio_by_income_band": kpis.kpis_by_income_band(stored), "v_credit_x_nps": credit_x_nps(spark.table("wv.fct_nps"), stored, "2025-04-01"),
        }
        assert create_stored_views(spark, "wv", "2025-04-01") == sorted(frames)
        other = spark.newSession()
        for name, frame in frames.items():
            view = other.table(f"wv.{name}")
            assert view.columns == frame.columns
            assert sorted(map(str, view.collect())) == sorted(map(str, frame.collect())), name
        newest = other.sql("SELECT * FROM wv.v_portfolio_health WHERE snapshot_date = DATE '2025-03-02'")
        assert newest.count() == 1 and "PartitionFilters: [isnotnull(snapshot_date" in plan_of(newest)
    finally:
        spark.sql("DROP DATABASE wv CASCADE")


def test_a_header_is_read_without_its_file(spark, tmp_path):
    """Of a file of many lines only the header's are decoded; a packed file is unpacked."""
    (tmp_path / "long.csv").write_bytes(b'a,"b\nc"\n' + b"1,2\n" * 1000 + b"\xff\n")
    with gzip.open(tmp_path / "p.csv.gz", "wt") as packed:
        packed.write("x,y\n1,2\n")
    spark.sparkContext.setJobGroup("first lines", "")
    try:
        rows = scans.header_lines(spark, [str(tmp_path / "long.csv"), str(tmp_path / "p.csv.gz")])
        plan = plan_of(rows)
        assert [r.header for r in rows.collect()] == ['a,"b\nc"', "x,y"]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # no scan of the files, whose rows all pass a task
    assert "FileScan" not in plan and "MapInArrow" not in plan


def test_stored_survey_view_shuffles_what_is_asked_for(spark):
    spark.sql("SELECT 1L AS loan_id, DATE '2025-01-01' AS snapshot_date, 3L AS days_past_due").createOrReplaceTempView("sv_facts")
    spark.sql(
        "SELECT id AS submission_id, 1L AS loan_id, 7 AS nps_score, 'Passive' AS nps_bucket, DATE '2025-01-02' AS submitted_at FROM range(3)"
    ).createOrReplaceTempView("sv_survey")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW sv AS {survey_sql('sv_facts', 'sv_survey', '2025-04-01', ['days_past_due'])}")
    assert values(spark.table("sv"), "nps_bucket", "days_past_due") == [("Passive", 3)] * 3
    counted = spark.sql("SELECT snapshot_date, count(*) FROM sv GROUP BY 1")
    assert [r[1] for r in counted.collect()] == [3]
    assert "nps_bucket" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_a_file_is_dated_once(spark, tmp_path):
    """The date of a file's name is joined to its rows; names with signs of their own are found too."""
    for name in ("Credit Data - 01-02-2025.csv", "Credit Data - 01-03-2025.csv"):
        (tmp_path / name).write_text(HEADER + "\nA,1/2/2025,1\nB,1/2/2025,1\n")
    for name in ("x%é+y 01-04-2025.csv", "x=1,'~ 01-05-2025.csv"):
        (tmp_path / name).write_text(HEADER + "\nA,1/2/2025,1\n")
    (frame,) = scans.scan_snapshots(spark, str(tmp_path), "*.csv", r"(\d{2}-\d{2}-\d{4})\.csv", "dd-MM-yyyy")
    days = frame.groupBy(scans.SNAPSHOT).count().orderBy(scans.SNAPSHOT)
    assert [(str(d), n) for d, n in values(days)] == [("2025-02-01", 2), ("2025-03-01", 2), ("2025-04-01", 1), ("2025-05-01", 1)]
    assert "BroadcastHashJoin" in plan_of(days)


def test_rows_are_written_where_they_lie(spark, tmp_path):
    rows = spark.range(40, numPartitions=4).selectExpr("id", "id % 2 AS half")
    for gather in (True, False):
        sinks.write_layer(rows, str(tmp_path / str(gather)), partition_by="half", gather=gather)
        assert sorted(values(scans.read_layer(spark, str(tmp_path / str(gather))))) == [(k, k % 2) for k in range(40)]
    files = {gather: [f for _, _, names in os.walk(tmp_path / gather) for f in names if f.endswith(".parquet")] for gather in ("True", "False")}
    assert len(files["True"]) == 2 and len(files["False"]) == 8


def test_compressed_exports_hold_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapter, "COMPRESSED_ROWS", 3)
    rows = spark.range(20, numPartitions=2).selectExpr(
        "string(id) AS LOAN_ID", "concat('say \"', id, '\", twice') AS NOTE", "concat('Credit Data - 3', id % 2, '-12-2001.csv') AS file"
    )
    for name, compressed in (("plain", False), ("short", True)):
        adapter.export_files(rows, "file", str(tmp_path / name), compressed)
    s = Settings()

    def read(name, glob):
        (frame,) = scans.scan_snapshots(spark, str(tmp_path / name), glob, r"Credit Data - (\d{2}-\d{2}-\d{4})", s.snapshot_format)
        return sorted(values(frame.select("LOAN_ID", "NOTE", F.col(scans.SNAPSHOT).cast("string"))))

    assert read("plain", "*.csv") == read("short", "*.csv.gz") and len(read("short", "*.csv.gz")) == 20
    shorts = [n for n in os.listdir(tmp_path / "short") if not n.startswith((".", "_"))]
    assert len(shorts) == 8 and all(n.endswith(".csv.gz") for n in shorts)
