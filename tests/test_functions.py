import datetime as dt
import re

import pytest
from conftest import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.functions import dates, numbers
from creditloom.functions.dates import age_years, parse_dates, parse_mixed
from creditloom.functions.text import missing_to_null, snake_header, title_case
from creditloom.settings import AtLeast, Band, OneOf, Rule, Settings


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}").orderBy("i")


def mapped(spark, items, expression, kind="string"):
    return [r[0] for r in column(spark, items, kind).select(expression(F.col("x"))).collect()]


# --- headers and text --------------------------------------------------------


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Loan Id ", "loan_id"),
        ("  Email ", "email"),
        ("Score?", "score"),
        ("(If Yes) �Q", "if_yes_q"),
        ("Crédit", "cre_dit"),
        ("A B", "a_b"),
        ("createdAt UTC", "createdat_utc"),
        ("???", ""),
        (None, ""),
    ],
)
def test_snake_header(raw, clean):
    assert snake_header(raw) == clean


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_snake_header_is_stable(raw):
    once = snake_header(raw)
    assert once == snake_header(once) or not once.isascii()
    assert not once.startswith("_") and not once.endswith("_")


def test_title_case_equals_python(spark):
    texts = ["male", " F ", "o'neil-smith", "MARY-JANE 3rd x2y", "", None, "a.b c"]
    expected = [t.strip().title() if t is not None else None for t in texts]
    assert mapped(spark, texts, title_case) == expected


def test_missing_texts(spark):
    got = mapped(spark, ["NA", "nan", "", "None", "n/a", "none", "0", None], missing_to_null)
    assert got == [None, None, None, None, None, "none", "0", None]


# --- dates -------------------------------------------------------------------

DATES = {
    "1/2/2025": "2025-01-02 00:00:00",
    "30-06-2025": "2025-06-30 00:00:00",
    "05-06-2025": "2025-05-06 00:00:00",
    "13/02/2025": "2025-02-13 00:00:00",
    "20250630": "2025-06-30 00:00:00",
    "2025-06": "2025-06-01 00:00:00",
    "2025/6/3": "2025-06-03 00:00:00",
    "1970-01-01T00:00:00+03:00": "1970-01-01 00:00:00",
    "2024-02-09T09:39:38Z": "2024-02-09 09:39:38",
    "2024-02-09 09:39:38": "2024-02-09 09:39:38",
    "1/5/2025 10:30": "2025-01-05 10:30:00",
    "1/5/2025 3:45 PM": "2025-01-05 15:45:00",
    "30/6/25": "2025-06-30 00:00:00",
    "1/1/74": "2074-01-01 00:00:00",
    "1/1/75": "1975-01-01 00:00:00",
    "June 3, 2025": "2025-06-03 00:00:00",
    "3 Jun 2025": "2025-06-03 00:00:00",
    "3-Sep-2025 05:06": "2025-09-03 05:06:00",
    "2/30/2025": None,
    "31/2/2025": None,
    "garbage": None,
    "45000": None,
    "202506": None,
    "12:30": None,
    "9999-01-01": None,
    "": None,
}


def test_mixed_dates(spark):
    got = mapped(spark, list(DATES), lambda x: parse_mixed(x).cast("string"))
    assert dict(zip(DATES, got)) == DATES


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(dt.date(1700, 1, 1), dt.date(2260, 12, 31)), min_size=1, max_size=20))
def test_month_first_round_trip(spark, days):
    got = mapped(spark, [f"{d.month}/{d.day}/{d.year}" for d in days], lambda x: F.to_date(parse_mixed(x)))
    assert got == days


def test_usual_spellings_are_read_as_they_are(spark):
    """Also with an offset; a column of them is not run through the patterns, and its code is short."""
    usual = ["1970-01-01T00:00:00+03:00", "2024-02-09T09:39:38.340Z", "1/2/2025", "2024-02-09 09:39:38", "1-2-2025 10:30-0330"]
    assert all(re.match(dates._PLAIN, text) for text in usual)
    assert not any(re.match(dates._PLAIN, text) for text in ("1/2/25", "2025/1/2", "20250102", "1/2/2025 3:45 PM", "Jan 1, 2025"))
    df = column(spark, usual).select(*[F.col("x").alias(f"c{k}") for k in range(6)])
    plan = parse_dates(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    # the respelling is a lambda, which is evaluated for other texts only
    assert all("transform(array(" in line for line in plan.splitlines() if "regexp_replace" in line and "Project" in line)


def test_parse_dates_of_mixed_column_kinds(spark):
    df = spark.createDataFrame(
        [("1/2/2025", dt.datetime(2025, 1, 2, 3)), (None, None)], "a string, b timestamp"
    )
    out = parse_dates(df, ["a", "b", "absent"])
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["timestamp_ntz"] * 2
    assert values(out)[0] == (dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 2, 3))


def test_age(spark):
    df = spark.createDataFrame(
        [(dt.date(1990, 1, 1),), (dt.date(2050, 1, 1),), (None,), (dt.date(1890, 1, 1),)], "b date"
    )
    ages = [r[0] for r in df.select(age_years(F.col("b"), F.lit(dt.date(2025, 1, 1)))).collect()]
    assert ages[0] == pytest.approx(35.0, abs=0.1)
    assert ages[1:] == [None, None, None]


# --- numbers, bands, rules -----------------------------------------------------


def test_to_number(spark):
    texts = ["12", " 12.5 ", "1,000", "1d", "2F", "1e3", "NaN", "abc", "", None, "-7"]
    assert mapped(spark, texts, numbers.to_number) == [
        12.0, 12.5, None, None, None, 1000.0, None, None, None, None, -7.0,
    ]


def test_to_flag(spark):
    got = mapped(spark, ["1.0", "0", "true", "2", "x", None], numbers.to_flag)
    assert got == [True, False, True, None, None, None]


def test_band_edges(spark):
    bands = [Band("18-25", 18, 26), Band("26-35", 26, 36), Band("55+", 56, None)]
    got = mapped(spark, [17, 18, 25, 26, 40, 56, 99, None], lambda x: numbers.band(x, bands), "int")
    assert got == [None, "18-25", "18-25", "26-35", None, "55+", "55+", None]


def test_overlapping_bands_last_wins(spark):
    bands = [Band("low", None, 10), Band("any")]
    assert mapped(spark, [1, 20, None], lambda x: numbers.band(x, bands), "int") == ["any", "any", None]
    bands = [Band("any"), Band("low", None, 10)]
    assert mapped(spark, [1, 20, None], lambda x: numbers.band(x, bands), "int") == ["low", "any", None]


RULES = (
    Rule("Critical", (OneOf("account_status_l1", ("Write Off",)),)),
    Rule("High", (AtLeast("days_past_due", 30), OneOf("account_status_l2", ("PAR 30",)))),
    Rule("Low", default=True),
    Rule("Never", (AtLeast("days_past_due", 0),)),
)


def test_first_rule_wins(spark):
    df = spark.createDataFrame(
        [("Write Off", None, 0), ("Active", "PAR 7", 45), ("Active", "PAR 30", None), ("write off", None, 29), (None, None, None)],
        "account_status_l1 string, account_status_l2 string, days_past_due int",
    )
    got = [r[0] for r in df.select(numbers.classify(RULES, df.columns)).collect()]
    assert got == ["Critical", "High", "High", "Low", "Low"]


def test_rule_on_absent_column_is_skipped(spark):
    df = spark.createDataFrame([(45,), (None,)], "days_past_due int")
    assert [r[0] for r in df.select(numbers.classify(RULES, df.columns)).collect()] == ["High", "Low"]
    assert [r[0] for r in df.select(numbers.classify(RULES[:2], df.columns)).collect()] == ["High", "Low"]


def test_dpd_and_income(spark):
    assert mapped(spark, [-5.0, 3.9, None, float("nan"), 1e300], numbers.clean_dpd, "double") == [0, 3, 0, 0, 0]
    df = spark.createDataFrame([(100.0, 4), (100.0, 0), (100.0, None), (None, 4), (1.0, -1)], "r double, d int")
    got = [r[0] for r in df.select(numbers.monthly_income(F.col("r"), F.col("d"))).collect()]
    assert got == [25.0, None, None, None, None]


def test_flags_look_inside_the_text(spark):
    texts = ["Write Off", "old WRITE_OFF x", "Returned", None]
    assert mapped(spark, texts, lambda x: numbers.text_flag(x, "write off|write_off")) == [1, 1, 0, 0]


def test_survey_classes(spark):
    got = mapped(spark, [-1.0, 0.0, 6.0, 6.5, 8.0, 9.0, 10.0, 11.0, None], numbers.nps_class, "double")
    assert got == [None, "Detractor", "Detractor", "Passive", "Passive", "Promoter", "Promoter", None, None]


def test_dpd_buckets(spark):
    got = mapped(spark, [None, 0, 1, 7, 8, 30, 31, 60, 61, 90, 91], numbers.dpd_bucket, "int")
    assert got == [
        "no_match", "0 (current)", "1-7", "1-7", "8-30", "8-30", "31-60", "31-60", "61-90", "61-90", "90+",
    ]


# --- configuration ---------------------------------------------------------------


def test_settings_from_mapping():
    doc = {
        "ingest": {"filename_date_format": "%Y-%m-%d"},
        "feature_engineering": {
            "age_bands": [{"label": "all", "min": None, "max": None}],
            "risk_category": {
                "rules": [{"name": "Bad", "status_in": ["x"], "days_min": 3}, {"name": "Ok", "default": True}]
            },
        },
        "quality": {"ranges": {"age_max": 90}, "freshness": {"max_days_between_snapshots": 7}},
        "alerting": {"severity_routing": {"high": ["pager"]}},
    }
    s = Settings.from_mapping(doc)
    assert s.snapshot_format == "yyyy-MM-dd"
    assert s.age_bands == (Band("all"),)
    assert s.risk_rules == (
        Rule("Bad", (OneOf("status", ("x",)), AtLeast("days", 3))), Rule("Ok", default=True),
    )
    assert s.age_range == (18, 90) and s.freshness_days == 7
    assert s.routing == {"HIGH": ("pager",)}
    assert s.income_bands == Settings().income_bands


def test_settings_from_json_file(tmp_path):
    path = tmp_path / "conf.json"
    path.write_text('{"quality": {"freshness": {"max_days_between_snapshots": 5}}}')
    assert Settings.from_file(str(path)).freshness_days == 5


def test_settings_from_yaml_file(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "conf.yaml"
    path.write_text("quality:\n  nulls:\n    customer_id_columns: {LOAN_ID: 0.25}\n")
    assert Settings.from_file(str(path)).null_limits == {"LOAN_ID": 0.25}
