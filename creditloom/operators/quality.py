"""Data-quality checks as result rows, alert routing and the gate.

Every check reduces its table to one row of counts and renders it as
``name, severity, status, expected, observed, message, evidence_path, extra``.
``run_checks`` shares scans: one for all credit checks, one for all feature
checks, one (with a join) for referential integrity.
"""

from __future__ import annotations

import datetime as dt
import string
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.dedupe import rows_sharing_key
from creditloom.operators.joins import coverage, missing_columns, unmatched_keys
from creditloom.settings import Settings

CREDIT_KEY = ("loan_id", "snapshot_date")

# --- fixed values: the texts of the results, as expected / observed / message ---
NO_SNAPSHOT = ("at least 1 snapshot", "0", "No snapshots present")
FRESHNESS = (
    "latest snapshot <= {limit} days old",
    "latest={latest}, age_days={age}",
    "Latest snapshot is {latest} ({age} days old).",
)
UNIQUENESS = (
    "0 duplicate ({key}) rows",
    "{rows} duplicate rows",
    "Found {rows} duplicate rows on primary key.",
)
NO_CREDIT = ("credit not empty", "empty", "No credit rows")
INTEGRITY = (
    "coverage >= {limit}",
    "coverage={share3}",
    "{share2} of credit loan_ids match a customer record.",
)
NO_VALUES = ("{noun} in [{lo},{hi}]", "no data", "No {column} observations available")
SPARSE_RANGE = (
    "{noun} in [{lo}, {hi}]",
    "{bad} out-of-range / {n} non-null",
    "{bad} {nouns} outside [{lo},{hi}]. min={low}, max={high}",
)
DPD_RANGE = (
    "days_past_due in [{lo}, {hi}]",
    "{bad} out-of-range / {n}",
    "{bad} DPD values outside [{lo},{hi}].",
)
NO_COLUMN = (
    "<= {limit} null",
    "column absent",
    "Required column `{column}` missing from credit",
)
NULL_SHARE = ("<= {limit} null", "{share3} null", "`{column}` is {share2} null.")
DRIFT_NONE = (
    "columns present: {expected}",
    "all present",
    "Canonical schema honoured by all snapshots.",
)
DRIFT = (
    "columns present: {expected}",
    "missing: {missing}",
    "Schema drift detected: {names}",
)
ALERT_TITLE = "DQ {status}: {name}"
# --- end of fixed values ---------------------------------------------------------

RESULT_COLUMNS = (
    "name",
    "severity",
    "status",
    "expected",
    "observed",
    "message",
    "evidence_path",
    "extra",
)


def _text(value: Column | str | None) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("string")


def _fill(template: str, parts: Mapping[str, Column | str | float]) -> Column:
    """A text template with column values in its places."""
    pieces: list[Column] = []
    for literal, place, _, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if place:
            value = parts[place]
            pieces.append(_text(value if isinstance(value, Column) else str(value)))
    return F.concat(*pieces)


def _result(
    name: str,
    severity: str,
    passed: Column | str,
    texts: tuple[str, str, str],
    *,
    evidence: Column | None = None,
    unmatched: Column | None = None,
    **parts: Column | str | float,
) -> Column:
    """One result row; ``passed`` is a predicate (null fails) or a fixed status."""
    status = F.when(passed, "PASS").otherwise("FAIL") if isinstance(passed, Column) else passed
    expected, observed, message = (_fill(t, parts) for t in texts)
    sample = unmatched if unmatched is not None else F.lit(None).cast("array<string>")
    return F.struct(
        _text(name).alias("name"),
        _text(severity).alias("severity"),
        _text(status).alias("status"),
        expected.alias("expected"),
        observed.alias("observed"),
        message.alias("message"),
        _text(evidence).alias("evidence_path"),
        F.struct(sample.alias("sample_unmatched")).alias("extra"),
    )


def _when_empty(empty: Column, then: Column, otherwise: Column) -> Column:
    return F.when(empty, then).otherwise(otherwise)


def _rows(metrics: DataFrame, results: Sequence[Column]) -> DataFrame:
    return metrics.select(F.inline(F.array(*results)))


def _pct(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", value * 100)


# --- one scan of the credit table -------------------------------------------


def credit_metrics(
    credit: DataFrame, null_columns: Sequence[str] = (), key: Sequence[str] = CREDIT_KEY
) -> DataFrame:
    """One row: rows, latest snapshot, duplicate rows and keys, nulls per column.

    Grouping by the key first gives the duplicate counts, and all other counts add
    up over the groups, so one scan and one narrow shuffle serve every check.
    """
    present = [c for c in null_columns if c in credit.columns]
    per_key = credit.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in present],
    )
    n = F.col("n")
    return per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("row_count"),
        F.max("snapshot_date").alias("latest"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(n > 1).alias("duplicate_keys"),
        *[F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(f"null_{c}") for c in present],
    )


def _freshness(settings: Settings, as_of: dt.date) -> Column:
    limit, latest = settings.freshness_days, F.col("latest").cast("date")
    # a snapshot dated after ``as_of`` is zero days old
    age = F.datediff(F.greatest(latest, F.lit(as_of).cast("date")), latest)
    return _when_empty(
        latest.isNull(),
        _result("FRESHNESS", "CRITICAL", "FAIL", NO_SNAPSHOT),
        _result(
            "FRESHNESS", "HIGH", age <= limit, FRESHNESS, limit=limit, latest=latest, age=age
        ),
    )


def _uniqueness(key: Sequence[str], evidence_path: str | None) -> Column:
    rows = F.col("duplicate_rows")
    evidence = F.when(rows > 0, F.lit(evidence_path))
    return _result(
        "UNIQUENESS",
        "CRITICAL",
        rows == 0,
        UNIQUENESS,
        evidence=evidence,
        key=", ".join(key),
        rows=rows,
    )


def _null_limits(columns: Sequence[str], settings: Settings) -> list[Column]:
    results = []
    for shown, limit in settings.null_limits.items():
        name, column = f"NULL_{shown}", shown.lower()
        if column not in columns:
            results.append(
                _result(name, "HIGH", "FAIL", NO_COLUMN, limit=f"{limit:.1%}", column=shown)
            )
            continue
        nulls, rows = F.col(f"null_{column}"), F.col("row_count")
        share = F.try_divide(nulls.cast("double"), rows.cast("double"))
        results.append(
            _result(
                name,
                "MEDIUM" if limit > 0 else "HIGH",
                share <= limit,
                NULL_SHARE,
                limit=f"{limit:.1%}",
                column=shown,
                share3=_pct(share, 3),
                share2=_pct(share, 2),
            )
        )
    return results


def _schema_drift(df: DataFrame, expected: Sequence[str]) -> Column:
    missing = missing_columns(df, expected)
    return _result(
        "SCHEMA_DRIFT",
        "CRITICAL",
        "FAIL" if missing else "PASS",
        DRIFT if missing else DRIFT_NONE,
        expected=str(list(expected)),
        missing=str(missing),
        names=", ".join(missing),
    )


def check_freshness(credit: DataFrame, settings: Settings, as_of: dt.date) -> DataFrame:
    return _rows(credit.agg(F.max("snapshot_date").alias("latest")), [_freshness(settings, as_of)])


def check_uniqueness(
    credit: DataFrame, key: Sequence[str] = CREDIT_KEY, evidence_path: str | None = None
) -> DataFrame:
    return _rows(credit_metrics(credit, key=key), [_uniqueness(key, evidence_path)])


def duplicate_evidence(credit: DataFrame, key: Sequence[str] = CREDIT_KEY) -> DataFrame:
    """Every row that shares its key with another row."""
    return rows_sharing_key(credit, key)


def check_null_limits(credit: DataFrame, settings: Settings) -> DataFrame:
    columns = [c.lower() for c in settings.null_limits if c.lower() in credit.columns]
    counts = credit.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )
    return _rows(counts, _null_limits(credit.columns, settings))


def check_schema_drift(credit: DataFrame, settings: Settings) -> DataFrame:
    rows = credit.agg(F.count(F.lit(1)).alias("row_count"))
    return _rows(rows, [_schema_drift(credit, settings.expected_columns)])


# --- referential integrity --------------------------------------------------


def check_referential_integrity(
    credit: DataFrame, customers: DataFrame, settings: Settings, key: str = "loan_id"
) -> DataFrame:
    share, total = F.col("coverage"), F.col("total")
    # at most 25 ids, sorted; the set is compared in full before the cut
    sample = unmatched_keys(credit, customers, key).agg(
        F.sort_array(F.collect_list(F.col(key))).cast("array<string>").alias("ids")
    )
    metrics = coverage(credit, customers, key).withColumn("_sample", sample.scalar())
    checked = _result(
        "REFERENTIAL_INTEGRITY",
        "HIGH",
        share >= settings.min_coverage,
        INTEGRITY,
        unmatched=F.col("_sample"),
        limit=f"{settings.min_coverage:.0%}",
        share3=_pct(share, 3),
        share2=_pct(share, 2),
    )
    empty = _result("REFERENTIAL_INTEGRITY", "HIGH", "FAIL", NO_CREDIT)
    return _rows(metrics, [_when_empty(total == 0, empty, checked)])


# --- one scan of the feature table ------------------------------------------


def range_metrics(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row: rows, and per column its present, out-of-range, lowest and highest values."""
    measures = [F.count(F.lit(1)).alias("row_count")]
    for column, (lo, hi) in ranges.items():
        value = F.col(column)
        measures += [
            F.count(value).alias(f"{column}_n"),
            F.count_if((value < lo) | (value > hi)).alias(f"{column}_bad"),
            F.min(value).alias(f"{column}_min"),
            F.max(value).alias(f"{column}_max"),
        ]
    return df.agg(*measures)


def _optional_range(
    name: str, column: str, limits: tuple[float, float], noun: str, nouns: str
) -> Column:
    """Range of a sparse column: only present values count, and none at all is a warning."""
    bad, n = F.col(f"{column}_bad"), F.col(f"{column}_n")
    shown = {"noun": noun, "nouns": nouns, "column": column, "lo": limits[0], "hi": limits[1]}
    checked = _result(
        name,
        "MEDIUM",
        bad == 0,
        SPARSE_RANGE,
        bad=bad,
        n=n,
        low=F.format_string("%.1f", F.col(f"{column}_min").cast("double")),
        high=F.format_string("%.1f", F.col(f"{column}_max").cast("double")),
        **shown,
    )
    return _when_empty(n == 0, _result(name, "MEDIUM", "WARN", NO_VALUES, **shown), checked)


def _age_range(settings: Settings) -> Column:
    return _optional_range(
        "RANGE_CUSTOMER_AGE", "customer_age_years", settings.age_range, "age", "ages"
    )


def _income_range(settings: Settings) -> Column:
    return _optional_range(
        "RANGE_INCOME", "avg_monthly_income", settings.income_range, "income", "incomes"
    )


def _dpd_range(settings: Settings) -> Column:
    bad, (lo, hi) = F.col("days_past_due_bad"), settings.dpd_range
    return _result(
        "RANGE_DAYS_PAST_DUE",
        "HIGH",
        bad == 0,
        DPD_RANGE,
        bad=bad,
        n=F.col("row_count"),
        lo=lo,
        hi=hi,
    )


def check_age_range(features: DataFrame, settings: Settings) -> DataFrame:
    metrics = range_metrics(features, {"customer_age_years": settings.age_range})
    return _rows(metrics, [_age_range(settings)])


def check_dpd_range(features: DataFrame, settings: Settings) -> DataFrame:
    metrics = range_metrics(features, {"days_past_due": settings.dpd_range})
    return _rows(metrics, [_dpd_range(settings)])


def check_income_range(features: DataFrame, settings: Settings) -> DataFrame:
    metrics = range_metrics(features, {"avg_monthly_income": settings.income_range})
    return _rows(metrics, [_income_range(settings)])


# --- all checks, routing, gate ----------------------------------------------


def run_checks(
    credit: DataFrame,
    customers: DataFrame,
    features: DataFrame,
    settings: Settings,
    as_of: dt.date,
    *,
    evidence_path: str | None = None,
    include_income: bool = False,
) -> DataFrame:
    """All checks, one row per result, with their ``position`` in reporting order."""
    limits = _null_limits(credit.columns, settings)
    on_credit = _rows(
        credit_metrics(credit, [c.lower() for c in settings.null_limits]),
        _placed(
            [(1, _freshness(settings, as_of)), (2, _uniqueness(CREDIT_KEY, evidence_path))]
            + [(6 + i, r) for i, r in enumerate(limits)]
            + [(6 + len(limits), _schema_drift(credit, settings.expected_columns))]
        ),
    )
    ranges = {
        "customer_age_years": settings.age_range,
        "days_past_due": settings.dpd_range,
    }
    on_features = [(4, _age_range(settings)), (5, _dpd_range(settings))]
    if include_income:
        ranges["avg_monthly_income"] = settings.income_range
        on_features.append((7 + len(limits), _income_range(settings)))
    parts = [
        on_credit,
        check_referential_integrity(credit, customers, settings).select(
            F.lit(3).alias("position"), *RESULT_COLUMNS
        ),
        _rows(range_metrics(features, ranges), _placed(on_features)),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("position")


def _placed(results: Sequence[tuple[int, Column]]) -> list[Column]:
    return [
        F.struct(
            F.lit(position).alias("position"), *[row[c].alias(c) for c in RESULT_COLUMNS]
        )
        for position, row in results
    ]


def alerts(results: DataFrame, routing: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per FAIL or WARN result with the channels its severity routes to (maybe none)."""
    none = F.array().cast("array<string>")
    channels = none
    for severity, names in routing.items():
        listed = F.array(*[F.lit(n) for n in names]) if names else none
        channels = F.when(F.upper("severity") == severity.upper(), listed).otherwise(channels)
    return results.filter(F.col("status").isin("FAIL", "WARN")).select(
        F.upper("severity").alias("severity"),
        _fill(ALERT_TITLE, {"status": F.col("status"), "name": F.col("name")}).alias("title"),
        F.col("message").alias("body"),
        "expected",
        "observed",
        "evidence_path",
        channels.alias("channels"),
    )


def alert_deliveries(results: DataFrame, routing: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per alert and channel."""
    return alerts(results, routing).select(
        F.explode("channels").alias("channel"), "severity", "title", "body"
    )


def failures(results: DataFrame) -> DataFrame:
    """Everything that did not pass, with message and evidence."""
    return results.filter("status != 'PASS'").select(
        "name", "severity", "status", "message", "evidence_path"
    )


def gate(results: DataFrame) -> DataFrame:
    """One row: number of FAIL results and whether the gate is shut (a WARN does not shut it)."""
    failed = F.count_if(F.col("status") == "FAIL")
    return results.agg(failed.alias("failed_checks")).withColumn(
        "gate_failed", F.col("failed_checks") > 0
    )
