"""Portfolio KPIs, segment mixes and the report frames built on them.

Facts are reduced to one row per snapshot (and segment) by map-side aggregation
first; everything after that works on those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.numbers import (
    band_order,
    dpd_bucket,
    mean,
    mean_positive,
    rate,
    ratio,
)
from creditloom.settings import (
    DPD_BUCKETS,
    DPD_NO_MATCH,
    DPD_REST,
    PAR30_BUCKETS,
    RISK_ORDER,
)

UNKNOWN = "Unknown"
TREND_KPIS = {
    "delinquency_rate": "Delinquency",
    "par30_rate": "PAR 30",
    "write_off_rate": "Write Off",
    "paid_off_rate": "Paid Off",
}
HEADLINE_KPIS = (*TREND_KPIS, "collection_rate")
BUCKET_ORDER = (*[name for name, _, _ in DPD_BUCKETS], DPD_REST, DPD_NO_MATCH)


def _overdue(days: int) -> Column:
    return rate(F.col("days_past_due") >= days)


def portfolio_health(features: DataFrame) -> DataFrame:
    """Snapshot-level KPIs."""
    return (
        features.groupBy("snapshot_date")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            _overdue(1).alias("delinquency_rate"),
            _overdue(30).alias("par30_rate"),
            _overdue(60).alias("par60_rate"),
            F.avg("is_write_off").alias("write_off_rate"),
            F.avg("is_paid_off").alias("paid_off_rate"),
            F.avg("is_returned").alias("return_rate"),
            ratio(F.col("total_paid"), F.col("total_due_today")).alias("collection_rate"),
            mean_positive(F.col("arrears")).alias("avg_arrears"),
            mean(F.col("balance")).alias("avg_balance"),
            F.sum("balance").alias("portfolio_balance"),
        )
        .orderBy("snapshot_date")
    )


def kpis_by_band(
    features: DataFrame, source: str, label: str, *, with_arrears: bool = True
) -> DataFrame:
    """KPIs by snapshot and band. Rows without a band and rows labelled Unknown are one group."""
    measures = [
        F.count(F.lit(1)).alias("accounts"),
        _overdue(1).alias("delinquency_rate"),
        _overdue(30).alias("par30_rate"),
        F.avg("is_write_off").alias("write_off_rate"),
        F.avg("is_paid_off").alias("paid_off_rate"),
        mean(F.col("balance")).alias("avg_balance"),
    ]
    if with_arrears:
        measures.append(mean_positive(F.col("arrears")).alias("avg_arrears"))
    return (
        features.groupBy("snapshot_date", F.coalesce(F.col(source), F.lit(UNKNOWN)).alias(label))
        .agg(*measures)
        .orderBy("snapshot_date", label)
    )


def kpis_by_age_band(features: DataFrame) -> DataFrame:
    return kpis_by_band(features, "age_band", "age_band")


def kpis_by_income_band(features: DataFrame) -> DataFrame:
    return kpis_by_band(features, "avg_monthly_income_band", "income_band", with_arrears=False)


def kpis_by_risk(features: DataFrame) -> DataFrame:
    """Mix by snapshot and risk class, worst class first."""
    return (
        features.groupBy("snapshot_date", "risk_category")
        .agg(
            F.count(F.lit(1)).alias("accounts"),
            F.sum("balance").alias("balance"),
            F.avg("days_past_due").alias("avg_dpd"),
            mean_positive(F.col("arrears")).alias("avg_arrears"),
        )
        .orderBy("snapshot_date", band_order(F.col("risk_category"), RISK_ORDER))
    )


def _survey_measures() -> list[Column]:
    score = F.col("nps_score")
    return [
        F.count(F.lit(1)).alias("respondents"),
        mean(score).alias("avg_nps"),
        rate(score >= 9).alias("promoter_rate"),
        rate(score <= 6).alias("detractor_rate"),
    ]


def nps_by_dpd_bucket(credit_x_nps: DataFrame) -> DataFrame:
    return (
        credit_x_nps.filter(F.col("nps_score").isNotNull())
        .groupBy(dpd_bucket(F.col("days_past_due")).alias("dpd_bucket"))
        .agg(*_survey_measures())
        .orderBy(band_order(F.col("dpd_bucket"), BUCKET_ORDER))
    )


def nps_by_risk(credit_x_nps: DataFrame) -> DataFrame:
    return (
        credit_x_nps.filter(F.col("nps_score").isNotNull())
        .groupBy(F.coalesce(F.col("risk_category"), F.lit(UNKNOWN)).alias("risk_category"))
        .agg(*_survey_measures())
        .orderBy("risk_category")
    )


# --- report frames over the KPI tables above --------------------------------


def kpi_trend(health: DataFrame) -> DataFrame:
    """Long form ``(snapshot_date, kpi, percent)`` of the four trend rates."""
    percents = [
        (F.col(c) * 100).alias(name) for c, name in TREND_KPIS.items()
    ]
    return health.select("snapshot_date", *percents).unpivot(
        ["snapshot_date"], list(TREND_KPIS.values()), "kpi", "percent"
    )


def delinquency_pivot(
    by_band: DataFrame, label: str, snapshots: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Mean delinquency percent, one row per band and one column per snapshot.

    Every band but Unknown is shown: those listed in ``order`` first and in that order,
    the others by name.
    """
    wide = (
        by_band.filter(F.col(label) != UNKNOWN)
        .withColumn("_snapshot", F.col("snapshot_date").cast("string"))
        .groupBy(label)
        .pivot("_snapshot", list(snapshots))
        .agg(F.avg("delinquency_rate") * 100)
    )
    declared = [band_order(F.col(label), order)] if order else []
    return wide.orderBy(*declared, label)


def risk_mix_percent(
    by_risk: DataFrame, order: Sequence[str] = RISK_ORDER, rest: str | None = None
) -> DataFrame:
    """Share of accounts per risk class in percent, one row per snapshot.

    ``order`` names the classes, as ``Settings.risk_classes`` has them. Shares are of all
    accounts, whatever their class; ``rest`` names a last column for classes not listed.
    """
    accounts = F.col("accounts").cast("double")
    cells = [(F.col("risk_category") == c, c) for c in order]
    if rest:
        cells.append((~F.coalesce(F.col("risk_category").isin(*order), F.lit(False)), rest))
    shares = [
        (F.try_divide(F.coalesce(F.sum(F.when(test, accounts)), F.lit(0.0)), F.sum(accounts)) * 100).alias(name)
        for test, name in cells
    ]
    return by_risk.groupBy("snapshot_date").agg(*shares).orderBy("snapshot_date")


def first_and_last(health: DataFrame, kpis: Sequence[str] = HEADLINE_KPIS) -> DataFrame:
    """Each headline KPI at the first and at the last snapshot."""
    ends = [
        end(F.col(k), F.col("snapshot_date")).alias(f"{k}{suffix}")
        for k in kpis
        for end, suffix in ((F.min_by, "_first"), (F.max_by, "_last"))
    ]
    rows = [
        F.struct(
            F.lit(k).alias("kpi"),
            F.col(f"{k}_first").alias("first_value"),
            F.col(f"{k}_last").alias("last_value"),
        )
        for k in kpis
    ]
    return health.agg(*ends).select(F.inline(F.array(*rows)))


def worst_segments(by_band: DataFrame, label: str, top: int = 3) -> DataFrame:
    """Bands with the highest plain mean of their snapshot delinquency rates."""
    return (
        by_band.filter(F.col(label) != UNKNOWN)
        .groupBy(label)
        .agg(F.avg("delinquency_rate").alias("mean_delinquency"))
        .orderBy(F.desc("mean_delinquency"), label)
        .limit(top)
    )


def nps_spread(by_bucket: DataFrame) -> DataFrame:
    """Current against 30+ days: plain means of the bucket means, and their difference."""
    bucket, score = F.col("dpd_bucket"), F.col("avg_nps")
    return by_bucket.agg(
        F.avg(F.when(bucket == BUCKET_ORDER[0], score)).alias("current_nps"),
        F.avg(F.when(bucket.isin(*PAR30_BUCKETS), score)).alias("par30_nps"),
    ).withColumn("spread", F.col("current_nps") - F.col("par30_nps"))


def latest_rows(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot.

    Apply it to the facts rather than to KPIs of all snapshots: the date is found
    from one column, and a layer partitioned by it is then read for that date only.
    """
    return df.filter(F.col(by) == df.agg(F.max(by)).scalar())


def matched_buckets(by_bucket: DataFrame) -> DataFrame:
    return by_bucket.filter(F.col("dpd_bucket") != DPD_NO_MATCH)


def feature_coverage(features: DataFrame) -> DataFrame:
    """Rows, and the share of rows that have an age band and an income band."""
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        rate(F.col("age_band").isNotNull()).alias("age_band_coverage"),
        rate(F.col("avg_monthly_income_band").isNotNull()).alias("income_band_coverage"),
    )


def risk_distribution(features: DataFrame) -> DataFrame:
    return features.groupBy("risk_category").agg(F.count(F.lit(1)).alias("rows"))


# --- monitoring -------------------------------------------------------------


def row_count_delta(facts: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Row count per snapshot and its change against the snapshot before."""
    # one row per snapshot is left, so the unpartitioned window is small
    before = F.lag("rows").over(Window.orderBy(by))
    return (
        facts.groupBy(by)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("previous_rows", before)
        .withColumn("delta", F.col("rows") - F.col("previous_rows"))
    )


def null_rate_drift(
    facts: DataFrame, columns: Sequence[str], by: str = "snapshot_date"
) -> DataFrame:
    """Null share per snapshot and column, and its change against the snapshot before."""
    shares = facts.groupBy(by).agg(*[rate(F.col(c).isNull()).alias(c) for c in columns])
    before = F.lag("null_rate").over(Window.partitionBy("column_name").orderBy(by))
    return (
        shares.unpivot([by], list(columns), "column_name", "null_rate")
        .withColumn("previous_rate", before)
        .withColumn("drift", F.col("null_rate") - F.col("previous_rate"))
    )
