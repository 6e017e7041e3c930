import datetime as dt

from conftest import values

from creditloom.operators import quality
from creditloom.settings import Settings

S = Settings()
DAY = dt.date(2025, 1, 1)
CREDIT = "loan_id string, snapshot_date date, date date, sale_date date, account_status_l1 string"


def credit(spark, rows):
    return spark.createDataFrame(rows, CREDIT)


def one(df):
    (row,) = df.collect()
    return row


def test_freshness(spark):
    df = credit(spark, [("A", DAY, DAY, DAY, "x")])
    r = one(quality.check_freshness(df, S, dt.date(2025, 4, 11)))
    assert (r.status, r.observed) == ("PASS", "latest=2025-01-01, age_days=100")
    assert one(quality.check_freshness(df, S, dt.date(2025, 4, 12))).status == "FAIL"
    assert one(quality.check_freshness(df, S, dt.date(2024, 1, 1))).observed.endswith("age_days=0")
    r = one(quality.check_freshness(df.limit(0), S, DAY))
    assert (r.severity, r.status, r.observed) == ("CRITICAL", "FAIL", "0")


def test_uniqueness(spark):
    twice = credit(spark, [("A", DAY, DAY, DAY, "x"), ("A", DAY, DAY, DAY, "y"), ("B", DAY, DAY, DAY, "x")])
    r = one(quality.check_uniqueness(twice, evidence_path="p"))
    assert (r.severity, r.status, r.observed, r.evidence_path) == ("CRITICAL", "FAIL", "2 duplicate rows", "p")
    assert sorted(values(quality.duplicate_evidence(twice), "account_status_l1")) == [("x",), ("y",)]
    m = one(quality.credit_metrics(twice))
    assert (m.row_count, m.duplicate_rows, m.duplicate_keys) == (3, 2, 1)
    r = one(quality.check_uniqueness(twice.filter("account_status_l1 = 'x'"), evidence_path="p"))
    assert (r.status, r.evidence_path) == ("PASS", None)


def test_referential_integrity(spark):
    df = credit(spark, [(k, DAY, DAY, DAY, "x") for k in ["A", "A", "B", None, "C"]])
    customers = spark.createDataFrame([("A",), ("A",)], "loan_id string")
    r = one(quality.check_referential_integrity(df, customers, S))
    assert (r.status, r.observed, r.expected) == ("FAIL", "coverage=50.000%", "coverage >= 95%")
    assert r.extra.sample_unmatched == ["B", "C"]
    assert one(quality.check_referential_integrity(df.limit(0), customers, S)).observed == "empty"


def test_ranges(spark):
    df = spark.createDataFrame([(25.0, 1), (200.0, None), (15.0, -1), (None, 5000)], "customer_age_years double, days_past_due int")
    r = one(quality.check_age_range(df, S))
    assert (r.status, r.observed) == ("FAIL", "2 out-of-range / 3 non-null")
    assert r.message == "2 ages outside [18,100]. min=15.0, max=200.0"
    assert one(quality.check_dpd_range(df, S)).observed == "2 out-of-range / 4"
    r = one(quality.check_age_range(df.filter("customer_age_years IS NULL"), S))
    assert (r.status, r.expected, r.observed) == ("WARN", "age in [18,100]", "no data")


def test_null_limits(spark):
    df = credit(spark, [("A", DAY, None, DAY, "x"), ("B", DAY, DAY, DAY, None)])
    got = {r.name: (r.severity, r.status, r.observed) for r in quality.check_null_limits(df, S).collect()}
    assert got == {
        "NULL_LOAN_ID": ("HIGH", "PASS", "0.000% null"),
        "NULL_DATE": ("HIGH", "FAIL", "50.000% null"),
        "NULL_SALE_DATE": ("HIGH", "PASS", "0.000% null"),
        "NULL_ACCOUNT_STATUS_L1": ("MEDIUM", "PASS", "50.000% null"),
        "NULL_ACCOUNT_STATUS_L2": ("HIGH", "FAIL", "column absent"),
    }


def test_all_checks_routing_and_gate(spark):
    df = credit(spark, [("A", DAY, DAY, DAY, "x")])
    customers = spark.createDataFrame([("A",)], "loan_id string")
    features = spark.createDataFrame([(None, 1)], "customer_age_years double, days_past_due int")
    results = quality.run_checks(df, customers, features, S, DAY)
    assert [r[0] for r in values(results, "name")] == [
        "FRESHNESS", "UNIQUENESS", "REFERENTIAL_INTEGRITY", "RANGE_CUSTOMER_AGE", "RANGE_DAYS_PAST_DUE",
        "NULL_LOAN_ID", "NULL_DATE", "NULL_SALE_DATE", "NULL_ACCOUNT_STATUS_L1", "NULL_ACCOUNT_STATUS_L2",
        "SCHEMA_DRIFT",
    ]
    alerts = {r.title: r.channels for r in quality.alerts(results, S.routing).collect()}
    assert alerts == {
        "DQ WARN: RANGE_CUSTOMER_AGE": ["email"],
        "DQ FAIL: NULL_ACCOUNT_STATUS_L2": ["email", "slack"],
        "DQ FAIL: SCHEMA_DRIFT": ["email", "slack", "pagerduty"],
    }
    assert quality.alert_deliveries(results, S.routing).count() == 6
    assert quality.alert_deliveries(results, {}).count() == 0
    assert quality.failures(results).count() == 3
    assert values(quality.gate(results)) == [(2, True)]
    only_warning = results.filter("status != 'FAIL'")
    assert values(quality.gate(only_warning)) == [(0, False)]
