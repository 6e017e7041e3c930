"""One query per operator of the survey, over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.catalog import adapter as A
from creditloom.functions.dates import age_years, parse_dates
from creditloom.functions.numbers import (
    band,
    classify,
    clean_dpd,
    monthly_income,
    nps_class,
    to_flag,
    to_number,
)
from creditloom.functions.text import title_case
from creditloom.operators import audit, dedupe, joins, kpis, profiling, quality, rows
from creditloom.plans import cleaning, features, warehouse
from creditloom.plans.pipeline import Inputs, Run, run_pipeline
from creditloom.session import scratch_dir, side_by_side
from creditloom.settings import INCOME_BANDS, AtLeast, Rule, Settings
from creditloom.sources import scans, sinks
from creditloom.sources.scans import SNAPSHOT
from creditloom.streaming.versions import VersionedSnapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SETTINGS = Settings()
STALE = dt.date(2002, 12, 31)
DIGITS = 6


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, because sums of doubles depend on their order."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles}) if doubles else df


# --- domain frames ------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the adapter's customers have one row per order key, as the orders do
    return features.build_feature_table(
        A.credit(spark, sf_dir), A.customers(spark, sf_dir), SETTINGS, validate=None
    )


def _credit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that need no customers: health and risk KPIs read these without a join."""
    return features.add_credit_features(A.credit(spark, sf_dir), SETTINGS)


def _survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.nps(spark, sf_dir).withColumn("nps_bucket", nps_class(F.col("nps_score")))


def _credit_x_nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.credit_x_nps(_survey(spark, sf_dir), _features(spark, sf_dir), A.AS_OF)


def _scored_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join for reports on days past due and risk: no customers needed."""
    facts = _credit_features(spark, sf_dir)
    return features.credit_x_nps(_survey(spark, sf_dir), facts, A.AS_OF)


def _credit_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credit table with every 97th loan's rows twice."""
    credit = A.credit(spark, sf_dir).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return credit.filter((F.col("_copy") == 0) | (F.col("loan_id") % 97 == 0)).drop("_copy")


def _holey_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credit table with some dates and statuses missing."""
    return A.credit(spark, sf_dir).withColumns(
        {
            "sale_date": F.when(F.col("loan_id") % 40 != 0, F.col("sale_date")),
            "account_status_l1": F.when(F.col("loan_id") % 3 == 0, F.col("account_status_l1")),
            "account_status_l2": F.when(
                (F.col("loan_id") + F.year("snapshot_date")) % 4 != 0, F.col("account_status_l2")
            ),
        }
    )


# --- KPIs ----------------------------------------------------------------------


@query
def portfolio_health(spark, sf_dir):
    return rounded(kpis.portfolio_health(_credit_features(spark, sf_dir)))


@query
def kpi_by_age_band(spark, sf_dir):
    return rounded(kpis.kpis_by_age_band(_features(spark, sf_dir)))


@query
def kpi_by_income_band(spark, sf_dir):
    return rounded(kpis.kpis_by_income_band(_features(spark, sf_dir)))


@query
def kpi_by_risk(spark, sf_dir):
    return rounded(kpis.kpis_by_risk(_credit_features(spark, sf_dir)))


@query
def kpi_trend_long(spark, sf_dir):
    return rounded(kpis.kpi_trend(kpis.portfolio_health(_credit_features(spark, sf_dir))))


@query
def pivot_age(spark, sf_dir):
    by_age = kpis.kpis_by_age_band(_features(spark, sf_dir))
    return rounded(kpis.delinquency_pivot(by_age, "age_band", A.SNAPSHOTS))


@query
def pivot_income(spark, sf_dir):
    by_income = kpis.kpis_by_income_band(_features(spark, sf_dir))
    order = [b.label for b in INCOME_BANDS]
    return rounded(kpis.delinquency_pivot(by_income, "income_band", A.SNAPSHOTS, order))


@query
def risk_mix_pct(spark, sf_dir):
    return rounded(kpis.risk_mix_percent(kpis.kpis_by_risk(_credit_features(spark, sf_dir))))


@query
def risk_mix_custom(spark, sf_dir):
    """Own class names and limits, one of them not listed in the report's order."""
    rules = (Rule("Severe", (AtLeast("days_past_due", 60),)), Rule("Watch", (AtLeast("days_past_due", 7),)), Rule("Fine", default=True))
    table = _credit_features(spark, sf_dir)
    named = table.withColumn("risk_category", classify(rules, table.columns))
    return rounded(kpis.risk_mix_percent(kpis.kpis_by_risk(named), ("Severe", "Fine"), rest="Other"))


@query
def first_last_kpis(spark, sf_dir):
    return rounded(kpis.first_and_last(kpis.portfolio_health(_credit_features(spark, sf_dir))))


@query
def worst_age_segments(spark, sf_dir):
    by_age = kpis.kpis_by_age_band(_features(spark, sf_dir))
    return rounded(kpis.worst_segments(by_age, "age_band"))


@query
def worst_income_segments(spark, sf_dir):
    by_income = kpis.kpis_by_income_band(_features(spark, sf_dir))
    return rounded(kpis.worst_segments(by_income, "income_band"))


@query
def latest_risk_mix(spark, sf_dir):
    return rounded(kpis.kpis_by_risk(kpis.latest_rows(_credit_features(spark, sf_dir))))


# --- feature columns -------------------------------------------------------------


@query
def age_band_per_loan(spark, sf_dir):
    return rounded(
        _features(spark, sf_dir).select(
            "loan_id", "snapshot_date", "customer_age_years", "age_band"
        )
    )


@query
def age_years_bounds(spark, sf_dir):
    """Ages from dates shifted out of the plausible range: negative and too old give null."""
    shift = (F.col("l_orderkey") % 400 - 100) * 365
    born = F.date_sub(F.to_date("l_shipdate"), shift.cast("int"))
    lines = A.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("ref_date"),
        age_years(born, F.to_date("l_shipdate")).alias("age"),
    )
    return rounded(lines)


@query
def monthly_income_band(spark, sf_dir):
    customers = A.customers(spark, sf_dir).select(
        "loan_id", monthly_income(F.col("received"), F.col("duration")).alias("avg_monthly_income")
    )
    return rounded(
        customers.withColumn(
            "avg_monthly_income_band", band(F.col("avg_monthly_income"), SETTINGS.income_bands)
        )
    )


@query
def dpd_clean(spark, sf_dir):
    """Days past due from text with unreadable and missing values."""
    raw = (
        F.when(F.col("loan_id") % 17 == 0, "n/a")
        .when(F.col("loan_id") % 19 == 0, None)
        .otherwise(F.concat(F.lit(" "), F.col("days_past_due").cast("string")))
    )
    return A.credit(spark, sf_dir).select(
        "loan_id", "snapshot_date", clean_dpd(to_number(raw)).alias("days_past_due")
    )


@query
def status_flags(spark, sf_dir):
    return _credit_features(spark, sf_dir).select(
        "loan_id", "snapshot_date", *features.STATUS_FLAGS, "is_delinquent"
    )


@query
def risk_classify(spark, sf_dir):
    return _credit_features(spark, sf_dir).select("loan_id", "snapshot_date", "risk_category")


@query
def risk_classify_without_status(spark, sf_dir):
    """Rules on columns the table lacks are skipped; here only days past due is there."""
    days = A.credit(spark, sf_dir).select(
        "loan_id", "snapshot_date", clean_dpd(F.col("days_past_due")).alias("days_past_due")
    )
    return days.withColumn("risk_category", classify(SETTINGS.risk_rules, days.columns))


@query
def feature_coverage(spark, sf_dir):
    return rounded(kpis.feature_coverage(_features(spark, sf_dir)))


@query
def risk_distribution(spark, sf_dir):
    return kpis.risk_distribution(_credit_features(spark, sf_dir))


@query
def nps_bucket(spark, sf_dir):
    return _survey(spark, sf_dir).select("submission_id", "nps_score", "nps_bucket")


# --- text to types ---------------------------------------------------------------


@query
def mixed_dates(spark, sf_dir):
    """Order dates written in eight styles, one of them unreadable."""
    style, day = F.col("o_orderkey") % 8, F.to_date("o_orderdate")
    text = (
        F.when(style == 0, F.date_format(day, "M/d/yyyy"))
        .when(style == 1, F.date_format(day, "dd-MM-yyyy"))
        .when(style == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T09:30:15+03:00")))
        .when(style == 4, F.date_format(day, "yyyyMMdd"))
        .when(style == 5, F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 14:05")))
        .when(style == 6, F.date_format(day, "MMMM d, yyyy"))
        .otherwise(F.concat(F.lit("on "), F.date_format(day, "yyyy")))
    )
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parsed = F.col("parsed")
    return parse_dates(orders.select("o_orderkey", text.alias("parsed")), ["parsed"]).select(
        "o_orderkey",
        F.to_date(parsed).alias("parsed_date"),
        (F.hour(parsed) * 3600 + F.minute(parsed) * 60 + F.second(parsed)).alias("second_of_day"),
    )


@query
def numeric_coerce(spark, sf_dir):
    style = F.col("o_orderkey") % 5
    text = (
        F.when(style == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".5 ")))
        .when(style == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(",000")))
        .when(style == 2, F.concat(F.lit("-"), F.col("o_custkey").cast("string")))
        .when(style == 3, F.col("o_orderpriority"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("d")))
    )
    return A.table(spark, sf_dir, "orders").select("o_orderkey", to_number(text).alias("number"))


@query
def flag_to_boolean(spark, sf_dir):
    text = (
        F.when(F.col("l_returnflag") == "R", "1.0")
        .when(F.col("l_returnflag") == "A", "0")
        .otherwise("?")
    )
    flags = A.table(spark, sf_dir, "lineitem").select(to_flag(text).alias("returned"))
    return flags.groupBy("returned").agg(F.count(F.lit(1)).alias("n"))


@query
def title_case_text(spark, sf_dir):
    c = F.concat(
        F.lit("  o'"), F.col("c_name"), F.lit(" "), F.col("c_mktsegment"), F.lit("-sur-MER ")
    )
    return A.table(spark, sf_dir, "customer").select("c_custkey", title_case(c).alias("titled"))


# --- cleaning ----------------------------------------------------------------------


def _raw_credit(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """The credit table as exported text: raw headers, padding, older copies, blank rows; ``more`` of its columns."""
    credit = A.credit(spark, sf_dir)
    loan = F.col("loan_id")
    # up to three rows per loan: the row itself, an older copy, a blank row
    kind = F.col("kind")
    wanted = (kind == 0) | ((kind == 1) & (loan % 7 == 0)) | ((kind == 2) & (loan % 10 == 0))
    keyed = kind != 2

    def cell(value):
        return F.when(keyed, value.cast("string"))

    paid = F.date_sub("max_payment_date", F.when(kind == 1, 40).otherwise(0))
    sold = (
        F.when(loan % 3 == 0, F.date_format("sale_date", "M/d/yyyy"))
        .when((loan % 3 == 1) & (F.day("sale_date") > 12), F.date_format("sale_date", "dd-MM-yyyy"))
        .otherwise(F.date_format("sale_date", "yyyy-MM-dd"))
    )
    days = F.when(loan % 17 == 0, "n/a").otherwise(F.col("days_past_due").cast("string"))
    each = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    return credit.withColumn("kind", each).filter(wanted).select(
        cell(loan).alias("LOAN_ID"),
        F.date_format("snapshot_date", "M/d/yyyy").alias(" DATE "),
        cell(sold).alias("SALE_DATE"),
        cell(F.date_format(paid, "M/d/yyyy")).alias("Max Payment Date"),
        cell(F.concat(F.lit(" "), "account_status_l1", F.lit("  "))).alias("ACCOUNT_STATUS_L1"),
        cell(F.col("account_status_l2")).alias("ACCOUNT_STATUS_L2"),
        cell(days).alias("Days Past Due?"),
        cell(F.col("arrears")).alias("ARREARS"),
        cell(F.col("balance") + kind).alias("BALANCE"),
        cell(F.col("closing_balance")).alias("CLOSING_BALANCE"),
        cell(F.datediff("snapshot_date", "sale_date")).alias("CUSTOMER_AGE"),
        *[cell(F.col(c)).alias(c.upper()) for c in more],
        F.lit(None).cast("string").alias("Unnamed: 28"),
        F.col("snapshot_date").alias(SNAPSHOT),
    )


def _credit_view(df: DataFrame) -> DataFrame:
    dates = {c: F.to_date(F.col(c)) for c in ("date", "sale_date", "max_payment_date")}
    return df.withColumns(dates)


@query
def clean_credit(spark, sf_dir):
    return _credit_view(cleaning.clean_credit_snapshot(_raw_credit(spark, sf_dir)))


@query
def credit_quarantine(spark, sf_dir):
    """The rows the credit cleaner leaves out."""
    return _credit_view(cleaning.quarantine_credit(_raw_credit(spark, sf_dir))).select(
        "loan_id", "snapshot_date", "max_payment_date", "balance"
    )


@query
def sheet_quarantine(spark, sf_dir):
    """Rows of the customer sheets that lose their loan to another row, per loan."""
    sheets = {"sales": _raw_sales, "dob": _raw_dob, "income": _raw_income}
    lost = [
        cleaning.rejected(raw(spark, sf_dir), cleaning.SOURCES[name]).groupBy("loan_id").agg(F.count(F.lit(1)).alias("rejected")).withColumn("sheet", F.lit(name))
        for name, raw in sheets.items()
    ]
    return reduce(DataFrame.unionByName, lost)


@query
def drop_blank_rows(spark, sf_dir):
    """Orders with their padding rows (every value missing) taken out again."""
    orders = A.table(spark, sf_dir, "orders")
    pad = F.col("pad")
    padded = (
        orders.withColumn("pad", F.explode(F.array(F.lit(0), F.lit(1))))
        .filter((pad == 0) | (F.col("o_orderkey") % 4 == 0))
        .select(*[F.when(pad == 0, F.col(c)).alias(c) for c in orders.columns])
    )
    return (
        rows.drop_blank_rows(padded, ["o_orderkey", "o_custkey"])
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("keys"))
    )


_LINES = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "lineitem").select(
        *_LINES, "l_discount", "l_tax", F.to_date("l_shipdate").alias("ship_date")
    )


@query
def dedupe_latest(spark, sf_dir):
    return dedupe.keep_latest(_lines(spark, sf_dir), A.LINE_KEY, ["ship_date"])


@query
def dedupe_quarantine(spark, sf_dir):
    return dedupe.quarantine(_lines(spark, sf_dir), A.LINE_KEY, ["ship_date"])


def _sheet(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    """A raw customer sheet with several rows per loan, from the order lines."""
    return _lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("Loan Id "), *columns
    )


def _raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sale = F.concat(F.lit("S"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"),
                    F.lit("-"), F.col("l_linenumber").cast("string"))
    return _sheet(
        spark,
        sf_dir,
        sale.alias("SALE_ID"),
        F.date_format("ship_date", "M/d/yyyy").alias("SALE_DATE"),
        F.date_format(F.date_add("ship_date", 30), "yyyy-MM-dd").alias("RETURN_DATE"),
        F.when(F.col("l_quantity") < 5, "1.0").otherwise("0.0").alias("RETURNED"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("CASH_PRICE"),
        F.concat(F.lit(" p"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("PRODUCT_NAME"),
    )


def _raw_dob(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_sub("ship_date", ((F.col("l_suppkey") % 60 + 18) * 365).cast("int"))
    made = F.concat(F.date_format("ship_date", "yyyy-MM-dd"), F.lit("T09:39:"),
                    F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(".340Z"))
    return _sheet(
        spark,
        sf_dir,
        F.concat(F.date_format(born, "yyyy-MM-dd"), F.lit("T00:00:00+03:00")).alias("date_of_birth"),
        made.alias("createdAt UTC"),
    )


def _raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return _sheet(
        spark,
        sf_dir,
        F.col("l_quantity").cast("int").cast("string").alias("Duration"),
        F.when(F.col("l_partkey") % 23 == 0, "unknown").otherwise(price).alias("Received"),
        F.col("l_suppkey").cast("string").alias("Persons Received From Total"),
        F.col("l_linenumber").cast("string").alias("Banks Received"),
        F.col("l_partkey").cast("string").alias("Paybills Received Others"),
    )


def _raw_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; the order key stands for the row's place in the file."""
    orders = A.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("Loan Id"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("Citizenship"),
        F.col("o_orderstatus").alias("Gender"),
    )


@query
def dedupe_sales(spark, sf_dir):
    sales = cleaning.clean_sales(_raw_sales(spark, sf_dir))
    return sales.select(
        "loan_id", F.to_date("sale_date").alias("sale_date"), "sale_id", "returned", "cash_price",
        "product_name",
    )


@query
def dedupe_dob(spark, sf_dir):
    dob = cleaning.clean_dob(_raw_dob(spark, sf_dir))
    return dob.select(
        "loan_id",
        F.to_date("date_of_birth").alias("date_of_birth"),
        F.to_date("createdat_utc").alias("created_date"),
        F.second("createdat_utc").alias("created_second"),
    )


@query
def dedupe_income(spark, sf_dir):
    return cleaning.clean_income(_raw_income(spark, sf_dir))


@query
def dedupe_keep_last(spark, sf_dir):
    """The last event of each user, where the event id is the place in the file."""
    return dedupe.keep_latest(
        A.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value"),
        ["user_id"],
        [],
        ["event_id"],
    )


def _raw_nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey export: long question header, text scores, several rows per submission."""
    question = "Using a scale from 0 (not likely) to 10 (very likely), how likely are you to recommend us?"
    lines = A.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_suppkey"
    )
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("Submission ID"),
        F.col("l_orderkey").cast("string").alias("Loan Id"),
        F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd").alias("Submitted at"),
        F.when(F.col("l_partkey") % 29 == 0, "ten")
        .otherwise((F.col("l_quantity").cast("int") % 12).cast("string"))
        .alias(question),
        F.col("l_suppkey").cast("string").alias("� Any other feedback?"),
    )


@query
def clean_nps(spark, sf_dir):
    return cleaning.clean_nps(_raw_nps(spark, sf_dir)).withColumn("submitted_at", F.to_date("submitted_at"))


@query
def union_aligned(spark, sf_dir):
    """Snapshots as separate frames, the later ones with one more column."""
    credit = A.credit(spark, sf_dir).select("loan_id", "snapshot_date", "balance", "closing_balance")
    parts = []
    for i, day in enumerate(A.SNAPSHOTS):
        part = credit.filter(F.col("snapshot_date") == F.lit(day).cast("date"))
        parts.append(part if i >= 2 else part.drop("closing_balance"))
    return rows.union_aligned(parts)


# --- joins and membership --------------------------------------------------------


@query
def customer_master(spark, sf_dir):
    # inputs come straight from the cleaners, so they are unique by construction
    master = cleaning.build_customer_master(
        cleaning.clean_sales(_raw_sales(spark, sf_dir)),
        cleaning.clean_gender(_raw_gender(spark, sf_dir)),
        cleaning.clean_dob(_raw_dob(spark, sf_dir)),
        cleaning.clean_income(_raw_income(spark, sf_dir)),
        validate=None,
    )
    return master.withColumns(
        {c: F.to_date(F.col(c)) for c in ("sale_date", "date_of_birth")}
    )


@query
def feature_table(spark, sf_dir):
    """The whole feature table, with the customers' uniqueness checked in the same run."""
    return rounded(
        features.build_feature_table(A.credit(spark, sf_dir), A.customers(spark, sf_dir), SETTINGS)
    )


@query
def credit_x_nps_asof(spark, sf_dir):
    return _credit_x_nps(spark, sf_dir)


@query
def asof_events(spark, sf_dir):
    """Each purchase with the same user's newest view before it; many views per user."""
    events = A.table(spark, sf_dir, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("event_id").alias("view_id")
    )
    out = joins.asof_join(
        purchases,
        views,
        key="user_id",
        left_time="ts",
        right_time="view_ts",
        payload=["view_id"],
    )
    return out.select("event_id", "user_id", "view_id")


@query
def nps_by_dpd_bucket(spark, sf_dir):
    return rounded(kpis.nps_by_dpd_bucket(_scored_credit(spark, sf_dir)))


@query
def nps_by_risk(spark, sf_dir):
    return rounded(kpis.nps_by_risk(_scored_credit(spark, sf_dir)))


@query
def nps_by_dpd_matched(spark, sf_dir):
    return rounded(kpis.matched_buckets(kpis.nps_by_dpd_bucket(_scored_credit(spark, sf_dir))))


@query
def nps_spread(spark, sf_dir):
    return rounded(kpis.nps_spread(kpis.nps_by_dpd_bucket(_scored_credit(spark, sf_dir))))


@query
def ri_coverage(spark, sf_dir):
    return rounded(joins.coverage(A.credit(spark, sf_dir), A.customers(spark, sf_dir), "loan_id"))


@query
def ri_unmatched(spark, sf_dir):
    return joins.unmatched_keys(A.credit(spark, sf_dir), A.customers(spark, sf_dir), "loan_id")


@query
def join_cardinality(spark, sf_dir):
    return joins.key_violations(A.table(spark, sf_dir, "lineitem"), A.LINE_KEY)


@query
def canonical_columns(spark, sf_dir):
    """Expected columns that a snapshot does not have, by name; a value is not asked for."""
    credit = A.credit(spark, sf_dir)
    wanted = F.array(*[F.lit(c) for c in (*SETTINGS.expected_columns, "credit_expiry")])
    missing = F.array_except(wanted, F.array(*[F.lit(c) for c in credit.columns]))
    # one row per snapshot, so that a snapshot table without rows reports nothing
    return credit.select("snapshot_date").distinct().select(F.explode(missing).alias("column_name")).distinct()


# --- profiling ---------------------------------------------------------------------


def _profiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "orders": A.table(spark, sf_dir, "orders"),
        "customer": A.table(spark, sf_dir, "customer"),
        "events": A.table(spark, sf_dir, "events"),
        "documents": A.table(spark, sf_dir, "documents"),
        "nps_customers": A.customers(spark, sf_dir),
    }


@query
def profile_columns(spark, sf_dir):
    return profiling.count_columns(_profiled(spark, sf_dir)).drop("distinct_count", "distinct_pct")


@query
def profile_distinct(spark, sf_dir):
    counts = profiling.count_columns(_profiled(spark, sf_dir)).filter("distinct_count > 0")
    return counts.select("dataset", "column_name", "distinct_count")


@query
def profile_numeric(spark, sf_dir):
    return rounded(profiling.number_columns(_profiled(spark, sf_dir)).drop("exact"), 3)


@query
def profile_exact(spark, sf_dir):
    """Extremes and medians of whole and decimal numbers with all their digits, also beyond those of doubles."""
    orders = A.table(spark, sf_dir, "orders")
    large = orders.select((F.col("o_orderkey") + 9007199254740993).alias("big"), F.col("o_custkey").cast("decimal(30,4)").alias("decimal"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    texts = profiling.number_columns({"orders": orders.select("o_orderkey", "o_custkey"), "large": large, "customers": A.customers(spark, sf_dir)})
    return texts.select("dataset", "column_name", F.col("exact.min").alias("min"), F.col("exact.max").alias("max"), F.col("exact.median").alias("median"))


@query
def profile_top_values(spark, sf_dir):
    return profiling.top_columns(_profiled(spark, sf_dir))


def _full_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What findings and the hot list read: null and distinct shares per column."""
    tables = {
        "credit": _raw_credit(spark, sf_dir).drop(SNAPSHOT),
        "events": A.table(spark, sf_dir, "events"),
        "nps_survey": A.customers(spark, sf_dir)
        .withColumnRenamed("gender", "?gender")
        .withColumnRenamed("citizenship", "citizen�ship"),
    }
    return profiling.count_columns(tables)


@query
def profile_findings(spark, sf_dir):
    return profiling.findings(_full_profiles(spark, sf_dir))


@query
def profile_null_hotlist(spark, sf_dir):
    return profiling.null_hotlist(_full_profiles(spark, sf_dir))


# --- quality checks -----------------------------------------------------------------


def _as_text(results: DataFrame) -> DataFrame:
    """Nested parts as text, for comparison by value."""
    ids = F.concat_ws(",", F.col("extra.sample_unmatched"))
    return results.withColumn("sample_unmatched", ids).drop("extra")


@query
def dq_freshness(spark, sf_dir):
    return _as_text(quality.check_freshness(A.credit(spark, sf_dir), SETTINGS, A.AS_OF))


@query
def dq_freshness_stale(spark, sf_dir):
    return _as_text(quality.check_freshness(A.credit(spark, sf_dir), SETTINGS, STALE))


@query
def dq_uniqueness(spark, sf_dir):
    credit = _credit_with_copies(spark, sf_dir)
    return _as_text(quality.check_uniqueness(credit, evidence_path="evidence/dq_duplicates"))


@query
def dq_uniqueness_counts(spark, sf_dir):
    """Duplicate rows and duplicate keys side by side."""
    return quality.credit_metrics(_credit_with_copies(spark, sf_dir)).select(
        "row_count", "duplicate_rows", "duplicate_keys"
    )


@query
def dq_uniqueness_evidence(spark, sf_dir):
    return quality.duplicate_evidence(_credit_with_copies(spark, sf_dir)).select(
        "loan_id", "snapshot_date", "balance"
    )


@query
def dq_referential_integrity(spark, sf_dir):
    return _as_text(
        quality.check_referential_integrity(
            A.credit(spark, sf_dir), A.customers(spark, sf_dir), SETTINGS
        )
    )


@query
def dq_range_age(spark, sf_dir):
    return _as_text(quality.check_age_range(_features(spark, sf_dir), SETTINGS))


@query
def dq_range_dpd(spark, sf_dir):
    """On the uncleaned days past due, where negative values are out of range."""
    return _as_text(quality.check_dpd_range(A.credit(spark, sf_dir), SETTINGS))


@query
def dq_range_income(spark, sf_dir):
    return _as_text(quality.check_income_range(_features(spark, sf_dir), SETTINGS))


@query
def dq_nulls(spark, sf_dir):
    return _as_text(quality.check_null_limits(_holey_credit(spark, sf_dir), SETTINGS))


@query
def dq_schema_drift(spark, sf_dir):
    return _as_text(quality.check_schema_drift(A.credit(spark, sf_dir).drop("arrears"), SETTINGS))


def _all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(
        _credit_with_copies(spark, sf_dir),
        A.customers(spark, sf_dir),
        _features(spark, sf_dir),
        SETTINGS,
        STALE,
        evidence_path="evidence/dq_duplicates",
        include_income=True,
    )


@query
def dq_all(spark, sf_dir):
    return _as_text(_all_checks(spark, sf_dir))


@query
def dq_alerts(spark, sf_dir):
    return quality.alert_deliveries(_all_checks(spark, sf_dir), SETTINGS.routing)


@query
def dq_failures(spark, sf_dir):
    return quality.failures(_all_checks(spark, sf_dir))


@query
def dq_gate(spark, sf_dir):
    return quality.gate(_all_checks(spark, sf_dir))


# --- monitoring ------------------------------------------------------------------------


@query
def snapshot_row_delta(spark, sf_dir):
    return kpis.row_count_delta(A.credit(spark, sf_dir))


@query
def null_rate_drift(spark, sf_dir):
    columns = ["sale_date", "account_status_l1", "account_status_l2"]
    return rounded(kpis.null_rate_drift(_holey_credit(spark, sf_dir), columns))


# --- sources, sinks, tables ------------------------------------------------------------


@query
def table_counts(spark, sf_dir):
    return rows.table_counts(
        {
            "fct_portfolio_snapshot": A.credit(spark, sf_dir),
            "dim_customer": A.customers(spark, sf_dir),
            "fct_sales": A.table(spark, sf_dir, "orders"),
            "fct_nps": A.nps(spark, sf_dir),
        }
    )


@query
def sample_fixed(spark, sf_dir):
    """5,000 credit rows (the operator's size), the same ones on every run."""
    credit = A.credit(spark, sf_dir).select("snapshot_date", "loan_id", "balance")
    return rows.fixed_sample(credit, ["snapshot_date", "loan_id"], 5000)


@query
def snapshot_reload(spark, sf_dir):
    """Write all snapshots, then one again with corrected balances: only it changes."""
    path = scratch_dir(spark, "snapshot-reload")
    credit = A.credit(spark, sf_dir).select("loan_id", "snapshot_date", "balance")
    sinks.write_layer(credit, path, partition_by="snapshot_date")
    last = credit.filter(F.col("snapshot_date") == F.lit(A.SNAPSHOTS[-1]).cast("date"))
    fixed = last.withColumn("balance", (F.col("balance") + 1).cast("decimal(18,2)"))
    sinks.write_layer(fixed, path, partition_by="snapshot_date", keep_other_partitions=True)
    return (
        spark.read.parquet(path)
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("balance").alias("balance"))
    )


_FILES = Settings(snapshot_pattern=r"Credit Data - (\d{2}-\d{2}-\d{4})(?: \d+)?\.csv")


def _export_credit(raw: DataFrame, folder: str, compressed: bool = False) -> None:
    """Raw credit rows as dated CSV files. From 2000 on they have one more column, in another order."""
    name = F.concat(F.lit("Credit Data - "), F.date_format(SNAPSHOT, "dd-MM-yyyy"), F.lit(".csv")).alias("file")
    texts = [c for c in raw.columns if c != SNAPSHOT]
    late = F.col(SNAPSHOT) >= F.lit("2000-01-01").cast("date")
    A.export_files(raw.filter(~late).select(*texts, name), "file", folder, compressed)
    A.export_files(raw.filter(late).select(F.lit("x").alias("Extra"), *reversed(texts), name), "file", folder, compressed)


@query
def csv_snapshot_scan(spark, sf_dir):
    """Dated snapshot files with two kinds of header, scanned, cleaned and aligned."""
    folder = scratch_dir(spark, "snapshot-files")
    _export_credit(_raw_credit(spark, sf_dir), folder)
    frames = scans.scan_snapshots(spark, folder, "*.csv", _FILES.snapshot_pattern, _FILES.snapshot_format)
    return _credit_view(cleaning.clean_all_credit(frames))


@query
def late_snapshot_load(spark, sf_dir):
    """A layer kept in step with its files: one wrong file is corrected, an old one comes late, the last is deleted."""
    base = scratch_dir(spark, "late-files")
    raw, day = _raw_credit(spark, sf_dir), F.col(SNAPSHOT).cast("string")
    wrong = raw.withColumn("BALANCE", F.when(day == A.SNAPSHOTS[1], "1").otherwise(F.col("BALANCE")))
    _export_credit(wrong.filter(day > A.SNAPSHOTS[0]), f"{base}/files")
    layer = VersionedSnapshots(spark, f"{base}/layer", _FILES)
    layer.sync(f"{base}/files", days_per_batch=2)
    _export_credit(raw.filter(day <= A.SNAPSHOTS[1]), f"{base}/files")
    A.delete_files(spark, f"{base}/files/Credit Data - 31-12-2001*.csv")
    layer.sync(f"{base}/files")
    parts = [
        layer.read(outcome).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("balance").cast("decimal(18,2)")).alias("balance"))
        .withColumn("outcome", F.lit(outcome))
        for outcome in ("kept", "rejected")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def sheet_scan(spark, sf_dir):
    """A padded customer sheet as CSV and as Parquet: of a loan's two rows the last in the file stays."""
    base = scratch_dir(spark, "sheets")
    row = F.col("row")
    sheet = A.table(spark, sf_dir, "orders").withColumn("row", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        F.when(row < 2, F.col("o_orderkey").cast("string")).alias("Loan Id"),
        F.when(row == 0, "old").when(row == 1, F.lower("o_orderpriority")).alias("Citizenship"),
        F.when(row == 1, F.col("o_orderstatus")).alias("Gender"),
    )
    sinks.write_csv(sheet, f"{base}/csv")
    sheet.write.parquet(f"{base}/parquet")
    read = {
        kind: cleaning.clean_gender(scans.scan_table(spark, f"{base}/{kind}", file_format=kind, multi_line=False, present=("loan_id",)))
        for kind in ("csv", "parquet")
    }
    return reduce(DataFrame.unionByName, [df.withColumn("file_format", F.lit(kind)) for kind, df in read.items()])


@query
def drop_all_null_rows(spark, sf_dir):
    """Events and padding rows, of which those without any value go; there is no key to go by."""
    events = A.table(spark, sf_dir, "events")
    pad = F.col("pad")
    padded = events.withColumn("pad", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).select(
        *[F.when((pad == 0) | ((pad == 1) & F.lit(c == "value")), F.col(c)).alias(c) for c in events.columns]
    )
    return rows.drop_blank_rows(padded).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"))


@query
def ri_coverage_null_keys(spark, sf_dir):
    """As ri_coverage, where every 13th loan has no id and counts as unmatched."""
    credit = A.credit(spark, sf_dir).withColumn("loan_id", F.when(F.col("loan_id") % 13 != 0, F.col("loan_id")))
    return rounded(joins.coverage(credit, A.customers(spark, sf_dir), "loan_id", count_null_keys=True))


@query
def sink_roundtrip(spark, sf_dir):
    """The risk KPI table through the Parquet, CSV and JSON sinks and back."""
    base = scratch_dir(spark, "sinks")
    mix = kpis.kpis_by_risk(_credit_features(spark, sf_dir)).select(
        "snapshot_date", "risk_category", "accounts"
    )
    sinks.write_layer(mix, f"{base}/parquet")
    stored = spark.read.parquet(f"{base}/parquet")
    sinks.write_csv(stored, f"{base}/csv", single_file=True)
    sinks.write_json(stored, f"{base}/json", single_file=True)
    schema = stored.schema
    back = {
        "parquet": stored,
        "csv": spark.read.schema(schema).option("header", True).csv(f"{base}/csv"),
        "json": spark.read.schema(schema).json(f"{base}/json"),
    }
    return profiling.union_profiles(
        [df.withColumn("file_format", F.lit(name)) for name, df in back.items()]
    )


@query
def views_roundtrip(spark, sf_dir):
    """Warehouse tables and analyst views, read back by name in SQL."""
    warehouse.load_warehouse(
        spark,
        features=_features(spark, sf_dir),
        customers=A.customers(spark, sf_dir),
        sales=A.table(spark, sf_dir, "orders"),
        nps=_survey(spark, sf_dir),
        as_of=A.AS_OF,
    )
    return spark.sql(
        """
        SELECT 'v_portfolio_by_age_band' AS view_name, SUM(accounts) AS n FROM v_portfolio_by_age_band
        UNION ALL SELECT 'v_portfolio_by_income_band', SUM(accounts) FROM v_portfolio_by_income_band
        UNION ALL SELECT 'v_portfolio_by_risk', SUM(accounts) FROM v_portfolio_by_risk
        UNION ALL SELECT 'v_portfolio_health', SUM(accounts) FROM v_portfolio_health
        UNION ALL SELECT 'v_credit_x_nps', COUNT(*) FROM v_credit_x_nps
        """
    )


@query
def stored_views(spark, sf_dir):
    """The views of a database, read by name in a session that never made them."""
    database = f"warehouse_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'warehouse')}'")
    warehouse.load_warehouse(
        spark, features=_features(spark, sf_dir), customers=A.customers(spark, sf_dir), sales=A.table(spark, sf_dir, "orders"),
        nps=_survey(spark, sf_dir), as_of=A.AS_OF, database=database,
    )
    other = spark.newSession()
    health = rounded(other.sql(f"SELECT * FROM {database}.v_portfolio_health"))
    matched = other.sql(f"SELECT snapshot_date, count(*) AS respondents FROM {database}.v_credit_x_nps GROUP BY 1")
    ages = other.sql(f"SELECT snapshot_date, count(*) AS age_bands FROM {database}.v_portfolio_by_age_band GROUP BY 1")
    incomes = other.sql(f"SELECT snapshot_date, count(*) AS income_bands FROM {database}.v_portfolio_by_income_band GROUP BY 1")
    risks = other.sql(f"SELECT snapshot_date, sum(accounts) AS by_risk FROM {database}.v_portfolio_by_risk GROUP BY 1")
    out = health.join(matched, "snapshot_date", "full")
    for part in (ages, incomes, risks):
        out = out.join(part, "snapshot_date", "left")
    return out


@query
def whole_run(spark, sf_dir):
    """The staged run over exported files: snapshots, sheets and survey; row counts of all it leaves."""
    base = scratch_dir(spark, "run")
    sheets = {"sales": _raw_sales, "gender": _raw_gender, "dob": _raw_dob, "income": _raw_income, "nps": _raw_nps}
    side_by_side(
        spark, lambda: _export_credit(_raw_credit(spark, sf_dir, "total_paid", "total_due_today"), f"{base}/credit", compressed=True),
        *[lambda name=name, raw=raw: sinks.write_csv(raw(spark, sf_dir), f"{base}/{name}", compressed=True) for name, raw in sheets.items()],
    )
    inputs = Inputs(f"{base}/credit", *[f"{base}/{n}" for n in ("sales", "gender", "dob", "income", "nps")])
    settings = replace(_FILES, snapshot_glob="*.csv.gz")
    run = Run(spark, inputs, f"{base}/out", A.AS_OF, settings=settings)
    run_pipeline(run)
    counts = spark.read.schema("table_name string, rows bigint").json(run.path("outputs/table_counts"))
    profiled = run.layer("profiles").groupBy("dataset").agg(F.max("row_count").alias("rows")).select(F.concat(F.lit("raw "), "dataset").alias("table_name"), "rows")
    lost = [
        run.layer(f"quarantine/{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(f"rejected {name}").alias("table_name"), "rows")
        for name in ("credit", "sales", "gender", "dob", "income", "nps")
    ]
    return reduce(DataFrame.unionByName, [counts, profiled, *lost])


@query
def audit_rows(spark, sf_dir):
    """Row counts of a cleaning step, counted while its layer is written."""
    log = audit.AuditLog("run")
    path = scratch_dir(spark, "audit")
    with log.step("clean_credit"):
        raw = log.watch(_raw_credit(spark, sf_dir), "clean_credit", "in_rows")
        out = log.watch(cleaning.clean_credit_snapshot(raw), "clean_credit", "out_rows")
        sinks.write_layer(out, f"{path}/credit")
    log.append_to(spark, f"{path}/log")
    return (
        spark.read.schema(audit.AUDIT_SCHEMA)
        .json(f"{path}/log")
        .filter("metric IN ('in_rows', 'out_rows')")
        .select("step", "metric", F.col("value").cast("bigint").alias("value"))
    )
