"""Phone numbers and e-mail addresses with a named status for each outcome. Native expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import unicode_trim

# The names of outcomes.
MIGRATED, ALREADY, RESTORED, SHORT_01, INVALID, EMPTY = "migre", "deja_migre", "zero_restaure", "suspect_01_court", "invalide", "vide"
EMAIL_VALID, EMAIL_INVALID, EMAIL_EMPTY = "valide", "invalide", "vide"
VALID_PHONES = (ALREADY, MIGRATED, RESTORED)
EMAIL_PATTERN = r"^[a-z0-9][a-z0-9._%+\-]*@[a-z0-9][a-z0-9.\-]*\.[a-z]{2,}$"


@dataclass(frozen=True)
class NumberingPlan:
    """A country whose numbers of `old` digits got a prefix. Fixed values of the default: the published plan of 2024."""

    country: str = "229"
    prefix: str = "01"
    old: int = 8
    first_digits: str = "24569"

    @property
    def new(self) -> int:
        return self.old + len(self.prefix)


PLAN = NumberingPlan()


def digit_runs(text: Column) -> Column:
    """Runs of digits once white space, dots, dashes and brackets are gone; all else separates numbers."""
    return F.regexp_extract_all(F.regexp_replace(text, r"(?U)[\s.\-()]", ""), F.lit(r"(\d+)"), F.lit(1))


def without_country(digits: Column, plan: NumberingPlan = PLAN) -> Column:
    return (
        F.when(digits.startswith("00" + plan.country), F.substring(digits, F.lit(3 + len(plan.country)), F.length(digits)))
        .when(digits.startswith(plan.country) & (F.length(digits) > plan.new), F.substring(digits, F.lit(1 + len(plan.country)), F.length(digits)))
        .otherwise(digits)
    )


def classified(digits: Column, plan: NumberingPlan = PLAN) -> Column:
    """struct(national, status) of a run of digits without country code."""
    size = F.length(digits)
    outcome = lambda national, status: F.struct(national.alias("national"), F.lit(status).alias("status"))
    nothing = F.lit(None).cast("string")
    known = lambda d, at: F.substring(d, at, 1).isin(*plan.first_digits)
    lead = len(plan.prefix) + 1
    restored = F.concat(F.lit(plan.prefix[0]), digits)
    return (
        F.when((size == plan.new) & digits.startswith(plan.prefix), F.when(known(digits, lead), outcome(digits, ALREADY)).otherwise(outcome(nothing, INVALID)))
        .when((size == plan.new - 1) & digits.startswith(plan.prefix[1:]), F.when(known(restored, lead), outcome(restored, RESTORED)).otherwise(outcome(nothing, INVALID)))
        .when((size == plan.old) & digits.startswith(plan.prefix), outcome(nothing, SHORT_01))
        .when((size == plan.old) & known(digits, 1), outcome(F.concat(F.lit(plan.prefix), digits), MIGRATED))
        .otherwise(outcome(nothing, INVALID))
    )


def _result(digits: Column, plan: NumberingPlan) -> Column:
    # each transform binds its value once; written out, the expression would repeat it dozens of times
    found = F.transform(F.array(without_country(digits, plan)), lambda d: classified(d, plan))
    return F.get(F.transform(found, lambda r: F.struct(F.concat(F.lit("+" + plan.country), r["national"]).alias("e164"), r["status"].alias("status"))), 0)


def _fixed(status: str) -> Column:
    return F.struct(F.lit(None).cast("string").alias("e164"), F.lit(status).alias("status"))


def phone(raw: Column, plan: NumberingPlan = PLAN) -> Column:
    """struct(e164, status) of a text with one number."""
    text = unicode_trim(F.coalesce(raw, F.lit("")))
    runs = digit_runs(text)
    return F.when(text == "", _fixed(EMPTY)).when(F.size(runs) != 1, _fixed(INVALID)).otherwise(_result(F.get(runs, 0), plan))


def phones(raw: Column, plan: NumberingPlan = PLAN) -> Column:
    """array of struct(e164, status) of a text with any number of numbers: one element at least."""
    text = unicode_trim(F.coalesce(raw, F.lit("")))
    runs = digit_runs(text)
    return F.when(text == "", F.array(_fixed(EMPTY))).when(F.size(runs) == 0, F.array(_fixed(INVALID))).otherwise(F.transform(runs, lambda d: _result(d, plan)))


def is_valid(status: Column) -> Column:
    return status.isin(*VALID_PHONES)


def national(e164: Column, plan: NumberingPlan = PLAN) -> Column:
    return F.substring(e164, F.lit(2 + len(plan.country)), F.length(e164))


def best_phone(results: Column) -> Column:
    """The first valid result, else the first."""
    return F.coalesce(F.get(F.filter(results, lambda r: is_valid(r["status"])), 0), F.get(results, 0))


def email(raw: Column) -> Column:
    """struct(normalized, status): lower case without spaces, if that has the shape of an address."""
    text = unicode_trim(F.coalesce(raw, F.lit("")))
    candidate = F.replace(F.lower(text), F.lit(" "), F.lit(""))
    outcome = lambda value, status: F.struct(value.alias("normalized"), F.lit(status).alias("status"))
    nothing = F.lit(None).cast("string")
    return F.when(text == "", outcome(nothing, EMAIL_EMPTY)).when(candidate.rlike(EMAIL_PATTERN), outcome(candidate, EMAIL_VALID)).otherwise(outcome(nothing, EMAIL_INVALID))
