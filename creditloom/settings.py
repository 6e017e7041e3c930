"""Bands, rules, limits and routing.

Every operator takes these as arguments; ``Settings()`` is the default credit
configuration and ``Settings.from_mapping`` reads a configuration document.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class Band:
    """Values in ``[lo, hi)``; ``None`` leaves that end open."""

    label: str
    lo: float | None = None
    hi: float | None = None


@dataclass(frozen=True)
class OneOf:
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class AtLeast:
    column: str
    minimum: float


@dataclass(frozen=True)
class Rule:
    """``label`` applies when any condition holds; a default rule takes all that is left."""

    label: str
    any_of: tuple[OneOf | AtLeast, ...] = ()
    default: bool = False


# --- fixed values -----------------------------------------------------------
# Band edges, rule tables, limits and names that results depend on.

AGE_BANDS = (
    Band("18-25", 18, 26),
    Band("26-35", 26, 36),
    Band("36-45", 36, 46),
    Band("46-55", 46, 56),
    Band("55+", 56, None),
)

INCOME_BANDS = (
    Band("Below 5,000", 0, 5000),
    Band("5,000-9,999", 5000, 10000),
    Band("10,000-19,999", 10000, 20000),
    Band("20,000-29,999", 20000, 30000),
    Band("30,000-49,999", 30000, 50000),
    Band("50,000-99,999", 50000, 100000),
    Band("100,000-149,999", 100000, 150000),
    Band("150,000+", 150000, None),
)

RISK_RULES = (
    Rule("Critical", (OneOf("account_status_l1", ("Write Off", "Blocked", "Default", "Lost")),)),
    Rule("Critical", (OneOf("account_status_l2", ("PAR 60", "PAR 90", "PAR 90+")),)),
    Rule("Critical", (AtLeast("days_past_due", 60),)),
    Rule("High", (OneOf("account_status_l2", ("PAR 30",)),)),
    Rule("High", (AtLeast("days_past_due", 30),)),
    Rule("Medium", (OneOf("account_status_l2", ("PAR 7",)),)),
    Rule("Medium", (AtLeast("days_past_due", 7),)),
    Rule("Low", default=True),
)

RISK_ORDER = ("Critical", "High", "Medium", "Low")

# Upper-inclusive edges of the survey score classes: (-1, 6], (6, 8], (8, 10].
NPS_CLASSES = ((-1, 6, "Detractor"), (6, 8, "Passive"), (8, 10, "Promoter"))

# Days-past-due buckets of the survey report, as whole days, both ends included.
DPD_BUCKETS = (
    ("0 (current)", 0, 0),
    ("1-7", 1, 7),
    ("8-30", 8, 30),
    ("31-60", 31, 60),
    ("61-90", 61, 90),
)
DPD_REST = "90+"
DPD_NO_MATCH = "no_match"
PAR30_BUCKETS = ("31-60", "61-90", "90+")

NULL_LIMITS = {
    "LOAN_ID": 0.0,
    "DATE": 0.0,
    "SALE_DATE": 0.0,
    "ACCOUNT_STATUS_L1": 0.5,
    "ACCOUNT_STATUS_L2": 0.5,
}

EXPECTED_COLUMNS = (
    "loan_id",
    "date",
    "sale_date",
    "account_status_l1",
    "account_status_l2",
    "days_past_due",
    "arrears",
    "balance",
    "closing_balance",
)

SEVERITY_ROUTING = {
    "CRITICAL": ("email", "slack", "pagerduty"),
    "HIGH": ("email", "slack"),
    "MEDIUM": ("email",),
    "LOW": (),
}

SNAPSHOT_GLOB = "Credit Data - *.csv"
SNAPSHOT_NAME_PATTERN = r"Credit Data - (\d{2}-\d{2}-\d{4})\.csv"
SNAPSHOT_NAME_FORMAT = "dd-MM-yyyy"

# --- end of fixed values ----------------------------------------------------


def _bands(specs: Sequence[Mapping[str, Any]]) -> tuple[Band, ...]:
    return tuple(Band(s["label"], s.get("min"), s.get("max")) for s in specs)


def _rules(specs: Sequence[Mapping[str, Any]]) -> tuple[Rule, ...]:
    """Keys ``<column>_in`` and ``<column>_min`` become conditions on that column."""
    rules = []
    for spec in specs:
        terms: list[OneOf | AtLeast] = []
        for key, value in spec.items():
            if key.endswith("_in"):
                terms.append(OneOf(key[: -len("_in")], tuple(value)))
            elif key.endswith("_min"):
                terms.append(AtLeast(key[: -len("_min")], value))
        rules.append(Rule(spec["name"], tuple(terms), bool(spec.get("default"))))
    return tuple(rules)


@dataclass(frozen=True)
class Settings:
    age_bands: tuple[Band, ...] = AGE_BANDS
    income_bands: tuple[Band, ...] = INCOME_BANDS
    risk_rules: tuple[Rule, ...] = RISK_RULES
    snapshot_glob: str = SNAPSHOT_GLOB
    snapshot_pattern: str = SNAPSHOT_NAME_PATTERN
    snapshot_format: str = SNAPSHOT_NAME_FORMAT
    encoding: str = "UTF-8"
    freshness_days: int = 100
    null_limits: Mapping[str, float] = field(default_factory=lambda: dict(NULL_LIMITS))
    age_range: tuple[float, float] = (18, 100)
    dpd_range: tuple[float, float] = (0, 3650)
    income_range: tuple[float, float] = (0, 10_000_000)
    min_coverage: float = 0.95
    expected_columns: tuple[str, ...] = EXPECTED_COLUMNS
    routing: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(SEVERITY_ROUTING))

    @property
    def risk_classes(self) -> tuple[str, ...]:
        """Labels of the risk rules, worst first; what no rule holds is Low."""
        labels = [r.label for r in self.risk_rules]
        return tuple(dict.fromkeys(labels if any(r.default for r in self.risk_rules) else [*labels, RISK_ORDER[-1]]))

    @classmethod
    def from_mapping(cls, doc: Mapping[str, Any]) -> Settings:
        """Settings from a parsed configuration document; absent parts keep their defaults."""
        found: dict[str, Any] = {}

        def take(name: str, path: str, convert=lambda v: v) -> None:
            node: Any = doc
            for part in path.split("."):
                if not isinstance(node, Mapping) or part not in node:
                    return
                node = node[part]
            found[name] = convert(node)

        take("age_bands", "feature_engineering.age_bands", _bands)
        take("income_bands", "feature_engineering.income_bands", _bands)
        take("risk_rules", "feature_engineering.risk_category.rules", _rules)
        take("snapshot_glob", "paths.raw.credit_glob")
        take("snapshot_pattern", "ingest.filename_date_pattern")
        take("snapshot_format", "ingest.filename_date_format", spark_date_format)
        take("encoding", "ingest.csv_read.encoding")
        take("freshness_days", "quality.freshness.max_days_between_snapshots", int)
        take("null_limits", "quality.nulls.customer_id_columns", dict)
        take("min_coverage", "quality.referential_integrity.credit_to_sales_min_coverage", float)
        take(
            "expected_columns",
            "quality.schema_drift.credit_expected_columns",
            lambda names: tuple(n.lower() for n in names),
        )
        take(
            "routing",
            "alerting.severity_routing",
            lambda r: {k.upper(): tuple(v) for k, v in r.items()},
        )
        base = cls()
        limits = doc.get("quality", {}).get("ranges", {})
        for name, key in (
            ("age_range", "age"),
            ("dpd_range", "days_past_due"),
            ("income_range", "income"),
        ):
            lo, hi = getattr(base, name)
            found[name] = (limits.get(f"{key}_min", lo), limits.get(f"{key}_max", hi))
        return replace(base, **found)

    @classmethod
    def from_file(cls, path: str) -> Settings:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
        if path.endswith(".json"):
            return cls.from_mapping(json.loads(text))
        try:
            import yaml
        except ImportError as missing:
            raise RuntimeError("reading a YAML configuration needs PyYAML; use JSON") from missing
        return cls.from_mapping(yaml.safe_load(text))


def spark_date_format(fmt: str) -> str:
    """A ``strptime`` date format as a Spark pattern (day, month and year fields only)."""
    for old, new in (("%d", "dd"), ("%m", "MM"), ("%Y", "yyyy"), ("%y", "yy")):
        fmt = fmt.replace(old, new)
    if "%" in fmt:
        raise ValueError(f"unsupported date format field in {fmt!r}")
    return fmt
