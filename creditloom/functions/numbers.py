"""Coercion, bands, rules and flags."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.settings import (
    DPD_BUCKETS,
    DPD_NO_MATCH,
    DPD_REST,
    NPS_CLASSES,
    AtLeast,
    Band,
    OneOf,
    Rule,
)


def to_number(value: Column) -> Column:
    """Text or number to double; anything that is no number, NaN included, is null."""
    text = F.rtrim(value.cast("string"))
    # the JVM parser takes Java's type suffixes (``12d``), which are no numbers here
    last = F.substring(text, -1, 1)
    number = ~last.isin("d", "D", "f", "F") | ~text.rlike(r"[0-9.].$")
    return F.nullif(F.when(number, text.try_cast("double")), F.lit(float("nan")))


def as_double(value: Column) -> Column:
    """As ``to_number`` for columns that are numeric already: no detour over text."""
    return F.nullif(value.try_cast("double"), F.lit(float("nan")))


def to_flag(value: Column) -> Column:
    """0/1 (also as ``1.0``) or true/false to a nullable boolean."""
    number = to_number(value)
    return (
        F.when(number == 1, F.lit(True))
        .when(number == 0, F.lit(False))
        .otherwise(value.cast("string").try_cast("boolean"))
    )


def mean(value: Column) -> Column:
    """Mean as a double. Decimal money keeps its exact sum, so the result has no order effect."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def rate(predicate: Column) -> Column:
    """Share of rows where the predicate holds; null rows count in neither part."""
    return F.avg(predicate.cast("int"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``sum/sum``, null unless the denominator's sum is positive."""
    below = F.sum(denominator).cast("double")
    return F.when(below > 0, F.try_divide(F.sum(numerator).cast("double"), below))


def mean_positive(value: Column) -> Column:
    return mean(F.when(value > 0, value))


def within(value: Column, spec: Band) -> Column:
    """Lower bound included, upper bound excluded; an absent bound does not bind."""
    tests = [(operator.ge, spec.lo), (operator.lt, spec.hi)]
    return reduce(operator.and_, (test(value, edge) for test, edge in tests if edge is not None), value.isNotNull())


def band(value: Column, bands: Sequence[Band]) -> Column:
    """Label of the band holding the value, as one CASE over the bands from the last to the first.

    So the last band listed wins where bands overlap.
    """
    branches = [(within(value, spec), spec.label) for spec in reversed(bands)]
    if not branches:
        return F.lit(None).cast("string")
    return reduce(lambda case, branch: case.when(*branch), branches[1:], F.when(*branches[0]))


def band_order(label: Column, labels: Iterable[str]) -> Column:
    """Rank of a label in the declared order; unknown labels come last."""
    labels = list(labels)
    return reduce(
        lambda rest, pair: F.when(label == pair[1], F.lit(pair[0])).otherwise(rest),
        list(enumerate(labels))[::-1],
        F.lit(len(labels)),
    )


def _holds(condition: OneOf | AtLeast) -> Column:
    if isinstance(condition, OneOf):
        return F.coalesce(F.col(condition.column).isin(*condition.values), F.lit(False))
    return F.coalesce(F.col(condition.column), F.lit(0)) >= condition.minimum


def classify(rules: Sequence[Rule], columns: Iterable[str], *, leftover: str = "Low") -> Column:
    """First matching rule's label, as one CASE expression.

    Conditions on columns the table does not have are left out; a rule without
    any condition left never matches.
    """
    present = set(columns)
    branches: list[tuple[Column, str]] = []
    rest = leftover
    for rule in rules:
        if rule.default:
            rest = rule.label
            break
        terms = [_holds(c) for c in rule.any_of if c.column in present]
        if terms:
            branches.append((reduce(lambda a, b: a | b, terms), rule.label))
    case = F.lit(rest)
    for predicate, label in reversed(branches):
        case = F.when(predicate, label).otherwise(case)
    return case


def clean_dpd(value: Column) -> Column:
    """Days past due: unreadable, missing, out of range or negative is 0; whole days."""
    whole = as_double(value).try_cast("bigint")
    return F.greatest(F.coalesce(whole, F.lit(0)), F.lit(0)).cast("bigint")


def monthly_income(received: Column, months: Column) -> Column:
    """Inflow per month; null where the duration is missing or not positive."""
    duration = as_double(months)
    return F.when(duration > 0, F.try_divide(as_double(received), duration))


def text_flag(value: Column, pattern: str) -> Column:
    """1 where the text contains the pattern in any case, else 0 (null is 0)."""
    return F.coalesce(F.lower(value).rlike(pattern), F.lit(False)).cast("int")


def nps_class(score: Column) -> Column:
    label = F.lit(None).cast("string")
    for above, upto, name in NPS_CLASSES:
        label = F.when((score > above) & (score <= upto), name).otherwise(label)
    return label


def dpd_bucket(days: Column) -> Column:
    label = F.lit(DPD_REST)
    for name, lo, hi in DPD_BUCKETS[::-1]:
        label = F.when(days.between(lo, hi), name).otherwise(label)
    return F.when(days.isNull(), DPD_NO_MATCH).otherwise(label)


def with_double_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """The frame with a bigint that orders as the doubles of a column do; null for null and NaN.

    It is the number's bit pattern, put together from exponent and fraction, both exact: the
    logarithm only guesses the exponent, which is then corrected. -0.0 and 0.0 have one
    key. The steps are columns of their own, so that each is written and worked out once.
    """
    value, size, guess, low, e = (F.col(c) for c in (name, "_size", "_guess", "_low", "_e"))
    steps = df.withColumn("_size", F.abs(value))
    steps = steps.withColumn("_guess", F.greatest(F.least(F.floor(F.log2(size)), F.lit(1023)), F.lit(-1022)))
    steps = steps.withColumn("_low", F.pow(F.lit(2.0), guess))
    steps = steps.withColumn("_e", F.greatest(F.when(low > size, guess - 1).when(size >= low * 2, guess + 1).otherwise(guess), F.lit(-1022)))
    fraction = (size / F.pow(F.lit(2.0), e) - 1) * F.lit(2.0**52)
    small = (size * F.lit(2.0**537)) * F.lit(2.0**537)
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == F.lit(float("inf")), F.lit(2047 << 52))
        .when(size < F.lit(2.0**-1022), small.cast("long"))
        .otherwise((e + 1023) * F.lit(1 << 52) + fraction.cast("long"))
    )
    steps = steps.withColumn("_bits", bits)
    signed = F.when(value < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return steps.withColumn(key, F.when(~F.isnan(value), signed)).drop("_size", "_guess", "_low", "_e", "_bits")


def key_double(key: Column) -> Column:
    """The double of a key."""
    bits = F.abs(key)
    exponent, fraction = F.shiftright(bits, 52), bits.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    size = (
        F.when(exponent == 0, fraction * F.lit(2.0**-537) * F.lit(2.0**-537))
        .when(exponent == 2047, F.lit(float("inf")))
        .otherwise((fraction / F.lit(2.0**52) + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
    )
    return F.when(key < 0, -size).otherwise(size)
