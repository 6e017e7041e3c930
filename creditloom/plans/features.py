"""The feature table: one row per loan and snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.dates import age_years
from creditloom.functions.numbers import (
    band,
    classify,
    clean_dpd,
    monthly_income,
    text_flag,
)
from creditloom.operators.joins import asof_join, checked_left_join
from creditloom.settings import Settings

# --- fixed values: columns taken from customers, leading columns, flag patterns ---
CUSTOMER_COLUMNS = (
    "loan_id",
    "sale_id",
    "sale_date",
    "sale_type",
    "seller",
    "seller_type",
    "product_name",
    "model",
    "loan_term",
    "business_model",
    "client_model",
    "cash_price",
    "loan_price",
    "returned",
    "citizenship",
    "gender",
    "date_of_birth",
    "duration",
    "received",
    "persons_received_from_total",
    "banks_received",
    "paybills_received_others",
)
LEADING_COLUMNS = (
    "loan_id",
    "snapshot_date",
    "sale_date",
    "date_of_birth",
    "customer_age_years",
    "age_band",
    "avg_monthly_income",
    "avg_monthly_income_band",
    "days_past_due",
    "arrears",
    "balance",
    "closing_balance",
    "account_status_l1",
    "account_status_l2",
    "risk_category",
    "is_delinquent",
    "is_write_off",
    "is_returned",
    "is_paid_off",
)
STATUS_FLAGS = {
    "is_write_off": "write off|write_off",
    "is_returned": "return",
    "is_paid_off": "paid off|paid_off",
}
SURVEY_COLUMNS = ("submission_id", "loan_id", "nps_score", "nps_bucket", "submitted_at")
SURVEY_FEATURES = (
    "days_past_due",
    "arrears",
    "balance",
    "risk_category",
    "age_band",
    "avg_monthly_income_band",
    "account_status_l2",
)
# --- end of fixed values -----------------------------------------------------------


def add_customer_features(df: DataFrame, settings: Settings) -> DataFrame:
    """Age and income with their bands."""
    return df.withColumns(
        {
            "customer_age_years": age_years(F.col("date_of_birth"), F.col("snapshot_date")),
            "avg_monthly_income": monthly_income(F.col("received"), F.col("duration")),
        }
    ).withColumns(
        {
            "age_band": band(F.col("customer_age_years"), settings.age_bands),
            "avg_monthly_income_band": band(F.col("avg_monthly_income"), settings.income_bands),
        }
    )


def add_credit_features(df: DataFrame, settings: Settings) -> DataFrame:
    """Days past due, risk class and status flags; needs no customer data.

    The rules look for whole status values, the flags for a text inside them.
    """
    cleaned = df.withColumn("days_past_due", clean_dpd(F.col("days_past_due")))
    return cleaned.withColumns(
        {
            "risk_category": classify(settings.risk_rules, df.columns),
            "is_delinquent": (F.col("days_past_due") > 0).cast("int"),
            **{
                flag: text_flag(F.col("account_status_l1"), pattern)
                for flag, pattern in STATUS_FLAGS.items()
            },
        }
    )


def build_feature_table(
    credit: DataFrame,
    customers: DataFrame,
    settings: Settings | None = None,
    *,
    validate: str | None = "many_to_one",
) -> DataFrame:
    """Credit snapshots with customer attributes and all derived features.

    Credit keeps ``sale_date``; the customers' one becomes ``customer_sale_date``.
    """
    settings = settings or Settings()
    attributes = customers.select(*[c for c in CUSTOMER_COLUMNS if c in customers.columns])
    clashes = [c for c in attributes.columns if c != "loan_id" and c in credit.columns]
    attributes = attributes.withColumnsRenamed({c: f"customer_{c}" for c in clashes})
    joined = checked_left_join(credit, attributes, ["loan_id"], validate)
    out = add_credit_features(add_customer_features(joined, settings), settings)
    leading = [c for c in LEADING_COLUMNS if c in out.columns]
    return out.select(*leading, *[c for c in out.columns if c not in LEADING_COLUMNS])


def credit_x_nps(nps: DataFrame, features: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Each submission with the loan's newest snapshot at or before it.

    A submission without a time is placed at ``as_of``. Credit features alone will
    do for reports that show no customer bands; the bands are then left out.
    """
    return asof_join(
        nps.select(*SURVEY_COLUMNS),
        features,
        key="loan_id",
        left_time=F.coalesce(F.col("submitted_at"), F.lit(as_of).cast("timestamp_ntz")),
        right_time="snapshot_date",
        payload=[c for c in SURVEY_FEATURES if c in features.columns],
    )
