"""Cleaners of the three source domains and the customer master."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.dates import parse_dates
from creditloom.functions.numbers import nps_class, to_flag, to_number
from creditloom.functions.text import title_case
from creditloom.operators.dedupe import keep_highest, keep_latest, keep_tied, quarantine, ranked_outcomes
from creditloom.operators.joins import checked_left_join
from creditloom.operators.rows import drop_blank_rows, normalise_headers, union_aligned
from creditloom.sources.scans import ORDINAL, SNAPSHOT, numbered

# --- fixed values: columns by role, and the survey question's prefix ---------
CREDIT_DATES = (
    "date",
    "sale_date",
    "return_date",
    "credit_expiry",
    "next_invoice_date",
    "max_payment_date",
)
CREDIT_TEXTS = (
    "balance_due_status",
    "account_status_l1",
    "account_status_l2",
    "credit_check_done",
)
CREDIT_NUMBERS = (
    "balance",
    "arrears",
    "days_past_due",
    "total_paid",
    "total_due_today",
    "closing_balance",
    "balance_due_to_date",
    "weekly_rate",
    "deposit",
    "discount",
)
SALES_TEXTS = (
    "seller",
    "seller_type",
    "sale_type",
    "product_name",
    "model",
    "business_model",
    "client_model",
    "loan_term",
)
INCOME_NUMBERS = (
    "duration",
    "received",
    "persons_received_from_total",
    "banks_received",
    "paybills_received_others",
)
SCORE_QUESTION = "using_a_scale_from_0"
# --- end of fixed values -----------------------------------------------------

CREDIT_KEY = ("loan_id", "snapshot_date")
OUTCOME = "outcome"


@dataclass(frozen=True)
class Source:
    """What a cleaner has to know about one kind of export.

    A row counts if it has a value in one of ``present``. Of the rows of one ``key``
    the one that is highest in ``newest`` stays, then the last one read. Columns that
    an export lacks are passed over.
    """

    present: tuple[str, ...]
    key: tuple[str, ...]
    newest: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    titles: tuple[str, ...] = ()
    names: Mapping[str, str] = field(default_factory=dict)  # by how a header begins
    derived: Mapping[str, tuple[str, Callable[[Column], Column]]] = field(default_factory=dict)
    flat: bool = False  # nested columns become text


SOURCES = {
    "credit": Source(
        ("loan_id",), CREDIT_KEY, ("max_payment_date",), CREDIT_DATES, CREDIT_NUMBERS, texts=CREDIT_TEXTS, names={"customer_age": "loan_age_days"}
    ),
    # sales without a loan id are one null key
    "sales": Source(
        ("sale_id", "loan_id"), ("loan_id",), ("sale_date",), ("sale_date", "return_date"), ("cash_price", "loan_price"), ("returned",), SALES_TEXTS
    ),
    "gender": Source(("loan_id",), ("loan_id",), titles=("citizenship", "gender")),
    "dob": Source(("loan_id",), ("loan_id",), ("createdat_utc",), ("date_of_birth", "createdat_utc")),
    "income": Source(("loan_id",), ("loan_id",), ("received",), numbers=INCOME_NUMBERS),
    "nps": Source(
        ("submission_id", "loan_id"), ("submission_id",), dates=("submitted_at",), numbers=("nps_score",), names={SCORE_QUESTION: "nps_score"},
        derived={"nps_bucket": ("nps_score", nps_class)}, flat=True,
    ),
}


def _keyed(df: DataFrame, source: Source, snapshot_date=None) -> DataFrame:
    """Normalised headers, no blank rows, the snapshot date if there is one; all text still."""
    out = numbered(drop_blank_rows(normalise_headers(df, keep=(ORDINAL, SNAPSHOT)), source.present))
    if snapshot_date is None and SNAPSHOT not in df.columns:
        return out
    stamp = F.col(SNAPSHOT) if snapshot_date is None else F.lit(snapshot_date)
    return out.withColumn("snapshot_date", F.to_date(stamp)).drop(SNAPSHOT)


def _typed(keyed: DataFrame, source: Source) -> DataFrame:
    """Every declared column converted, in one projection but for the dates."""
    renamed: dict[str, str] = {}
    for prefix, name in source.names.items():
        renamed |= {c: name for c in keyed.columns if c.startswith(prefix) and name not in renamed.values()}
    out = parse_dates(keyed.withColumnsRenamed(renamed), source.dates)
    kinds = ((source.numbers, to_number), (source.flags, to_flag), (source.texts, F.trim), (source.titles, title_case))
    new = {c: convert(F.col(c)) for names, convert in kinds for c in names if c in out.columns}
    if source.flat:
        complex_types = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
        new |= {f.name: F.col(f.name).cast("string") for f in out.schema if isinstance(f.dataType, complex_types) and f.name != ORDINAL}
    out = out.withColumns(new)
    return out.withColumns({name: make(F.col(c)) for name, (c, make) in source.derived.items() if c in out.columns})


_ORDER = "_order_"


def _with_order(keyed: DataFrame, source: Source) -> tuple[DataFrame, list[str]]:
    """The frame with the columns that decide between rows of a key typed under other names."""
    newest = [c for c in source.newest if c in keyed.columns]
    typed = {f"{_ORDER}{c}": F.col(c) for c in newest}
    out = parse_dates(keyed.withColumns(typed), [f"{_ORDER}{c}" for c in newest if c in source.dates])
    return out.withColumns({f"{_ORDER}{c}": to_number(F.col(f"{_ORDER}{c}")) for c in newest if c in source.numbers}), list(typed)


def clean(df: DataFrame, source: Source, snapshot_date=None) -> DataFrame:
    """One typed row per key. An export without the key columns is typed only.

    Only the columns that decide are typed ahead of the ranking, so rows that lose are
    never parsed. Without ``_ordinal``, rows tied there are ranked again by all their values.
    """
    keyed = _keyed(df, source, snapshot_date)
    if not set(source.key) <= set(keyed.columns):
        return _typed(keyed, source).drop(ORDINAL)
    ordered, deciding = _with_order(keyed, source)
    best = [F.col(c).desc_nulls_last() for c in deciding]
    if ORDINAL in keyed.columns:
        winners = keep_latest(ordered, source.key, deciding, [ORDINAL])
        return _typed(winners.drop(*deciding, ORDINAL), source)
    if not best:
        return keep_latest(_typed(ordered, source), source.key, [])
    return keep_highest(_typed(keep_tied(ordered, source.key, best).drop(*deciding), source), source.key)


def rejected(df: DataFrame, source: Source, snapshot_date=None) -> DataFrame:
    """The rows that ``clean`` leaves out for another row of their key, typed.

    The key needs no typing, so only rows that share theirs are parsed.
    """
    keyed = _keyed(df, source, snapshot_date)
    if not set(source.key) <= set(keyed.columns):
        return _typed(keyed, source).drop(ORDINAL).limit(0)
    newest, place = ([c for c in names if c in _typed(keyed, source).columns] for names in (source.newest, [ORDINAL]))
    return quarantine(keyed, source.key, newest, place or None, typed=lambda rows: _typed(rows, source)).drop(ORDINAL)


def sorted_out(df: DataFrame, source: Source, snapshot_date=None, slices: int | None = None) -> DataFrame:
    """All rows that count, typed, with ``outcome``: ``kept`` as by ``clean``, or ``rejected``.

    For writing both in one pass: the export is read, shuffled and parsed once. Without
    ``_ordinal`` ties are decided by all values, which are then typed ahead of the ranking.
    ``slices`` (by default the number of shuffle partitions) is among how many tasks the rows
    of one key may be spread.
    """
    keyed = _keyed(df, source, snapshot_date)
    if not set(source.key) <= set(keyed.columns):
        return _typed(keyed, source).drop(ORDINAL).withColumn(OUTCOME, F.lit("kept"))
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_place = ORDINAL in keyed.columns
    ordered, deciding = _with_order(keyed, source) if by_place else (_typed(keyed, source), [c for c in source.newest if c in keyed.columns])
    ties = [ORDINAL] if by_place else [c for c in ordered.columns if c not in source.key and c not in deciding]
    best = [F.col(c).desc_nulls_last() for c in [*deciding, *ties]]
    ranked = ranked_outcomes(ordered, list(source.key), best, [*deciding, *ties], slices, OUTCOME)
    if not by_place:
        return ranked
    out = _typed(ranked.drop(*deciding, ORDINAL), source)
    return out.select(*[c for c in out.columns if c != OUTCOME], OUTCOME)


def clean_credit_snapshot(df: DataFrame, snapshot_date=None) -> DataFrame:
    """One row per loan and snapshot, dated as given or by the scanned file's name."""
    return clean(df, SOURCES["credit"], snapshot_date)


def quarantine_credit(df: DataFrame, snapshot_date=None) -> DataFrame:
    return rejected(df, SOURCES["credit"], snapshot_date)


def clean_all_credit(frames: Sequence[DataFrame]) -> DataFrame:
    """Clean every raw snapshot frame and align them by name."""
    if not frames:
        raise FileNotFoundError("no credit files to clean")
    return union_aligned([clean_credit_snapshot(f) for f in frames])


def clean_sales(df: DataFrame) -> DataFrame:
    """Newest sale per loan."""
    return clean(df, SOURCES["sales"])


def clean_gender(df: DataFrame) -> DataFrame:
    """Title-cased attributes; the last row of the file per loan."""
    return clean(df, SOURCES["gender"])


def clean_dob(df: DataFrame) -> DataFrame:
    """Newest date-of-birth record per loan."""
    return clean(df, SOURCES["dob"])


def clean_income(df: DataFrame) -> DataFrame:
    """The record with the largest inflow per loan."""
    return clean(df, SOURCES["income"])


def clean_nps(df: DataFrame) -> DataFrame:
    """Survey responses: score and class, one row per submission, all else text."""
    return clean(df, SOURCES["nps"])


def build_customer_master(
    sales: DataFrame,
    gender: DataFrame,
    dob: DataFrame,
    income: DataFrame,
    *,
    validate: str | None = "one_to_one",
) -> DataFrame:
    """All customer attributes around the sales rows.

    The four joins share one key, so each input is shuffled once. Inputs straight
    from the cleaners are unique by construction and already clustered by the key:
    ``validate=None`` then saves the extra check.
    """
    out = sales.drop("return_date")
    for attributes in (
        gender.select("loan_id", "citizenship", "gender"),
        dob.select("loan_id", "date_of_birth"),
        income.select("loan_id", *INCOME_NUMBERS),
    ):
        out = checked_left_join(out, attributes, ["loan_id"], validate)
        # a one-to-one join leaves the left keys as they were: no need to test them again
        validate = validate and "many_to_one"
    return out
