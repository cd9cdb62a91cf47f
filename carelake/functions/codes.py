"""Code maps, age rules and key clean-up as Column functions.

Every function takes and returns a Column, so all of it stays in generated JVM code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The labels and limits the reports are defined by.
KEY_PREFIX = "urn:uuid:"
MARITAL_LABELS = {"m": "Married", "s": "Single", "never married": "Never Married"}
CLASS_LABELS = {"IMP": "Inpatient", "AMB": "Ambulatory", "EMER": "Emergency"}
FINISHED = "finished"
AGE_GROUPS = ((18, "Child"), (40, "Young Adult"), (65, "Middle Aged"))
AGE_GROUP_REST = "Senior"
AGE_RANGES = ((18, "0-18"), (35, "19-35"), (50, "36-50"), (65, "51-65"))
AGE_RANGE_REST = "66+"
ADJUDICATION_LABELS = {
    "line submitted charge amount": "Submitted Charge",
    "line beneficiary coinsurance amount": "Coinsurance Amount",
    "line allowed charge amount": "Allowed Charge",
    "line provider payment amount": "Provider Payment",
    "line beneficiary part b deductible amount": "Part B Deductible",
}
UNKNOWN = "Unknown"
UNREPORTED_CATEGORIES = (UNKNOWN, "Part B Deductible")
REPORTED_CATEGORIES = tuple(
    label for label in ADJUDICATION_LABELS.values() if label not in UNREPORTED_CATEGORIES
)
OTHER_PROVIDERS = "Others"
SENIOR_AGE = 65
LABEL_AGE = 50
RISK_STATES = ("CA", "NY")
RISK_IN, RISK_OUT = 0.8, 0.4
# The four codes of the administrative-gender value set.
GENDERS = ("female", "male", "other", "unknown")
UNLISTED = "unlisted"


def _label(code: Column, labels: dict[str, str], rest: str) -> Column:
    """`labels[code]`, or `rest` for NULL and unlisted codes."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(rest))


def _band(value: Column, bands, rest: str, inclusive: bool) -> Column:
    """Name of the first band whose upper limit holds `value`; NULL falls through to `rest`."""
    out = None
    for limit, name in bands:
        inside = value <= limit if inclusive else value < limit
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out.otherwise(rest)


def folded(text: Column) -> Column:
    return F.trim(F.lower(text))


def marital_label(status: Column) -> Column:
    return _label(folded(status), MARITAL_LABELS, UNKNOWN)


def status_label(status: Column) -> Column:
    return _label(status, {FINISHED: "Completed"}, "In-Progress")


def class_label(code: Column) -> Column:
    return _label(code, CLASS_LABELS, UNKNOWN)


def category_label(display: Column) -> Column:
    """Adjudication category. The processing-indicator line carries no amount and stays Unknown."""
    return _label(folded(display), ADJUDICATION_LABELS, UNKNOWN)


def age_group(age: Column) -> Column:
    return _band(age, AGE_GROUPS, AGE_GROUP_REST, inclusive=False)


def age_range(age: Column) -> Column:
    return _band(age, AGE_RANGES, AGE_RANGE_REST, inclusive=True)


def provider_label(display: Column) -> Column:
    return F.when(display != "", display).otherwise(OTHER_PROVIDERS)


def is_senior(age: Column) -> Column:
    return F.when(age >= SENIOR_AGE, 1).otherwise(0)


def region_risk(state: Column, states=RISK_STATES) -> Column:
    return F.when(state.isin(*states), RISK_IN).otherwise(RISK_OUT)


def age_label(age: Column, over: int = LABEL_AGE) -> Column:
    return F.when(age > over, 1).otherwise(0)


def bare_key(reference: Column) -> Column:
    """The reference without its prefix; a reference that has none is kept as it is."""
    return F.replace(reference, F.lit(KEY_PREFIX), F.lit(""))


def key_after_prefix(reference: Column) -> Column:
    """What follows the prefix, NULL where the reference has none."""
    return F.get(F.split(reference, KEY_PREFIX), F.lit(1))


def age_by_year(birth_date: Column, as_of: str) -> Column:
    """Difference of the calendar years."""
    return F.year(F.lit(as_of).cast("date")) - F.year(birth_date.try_cast("date"))


def age_by_days(birth_date: Column, as_of: str) -> Column:
    """Completed years, counting 365.25 days to a year."""
    days = F.datediff(F.lit(as_of).cast("date"), birth_date.try_cast("date"))
    return (days / F.lit(365.25)).cast("int")


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60
