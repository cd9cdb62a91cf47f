"""Every limit of the code maps, and keys and ages."""

import pytest
from pyspark.sql import functions as F

from carelake.functions import codes


def apply(spark, function, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


CASES = {
    "marital": (
        codes.marital_label,
        "string",
        {"m": "Married", " M ": "Married", "S": "Single", "never MARRIED": "Never Married",
         "widowed": "Unknown", "": "Unknown", None: "Unknown"},
    ),
    "status": (
        codes.status_label,
        "string",
        {"finished": "Completed", "Finished": "In-Progress", "planned": "In-Progress", None: "In-Progress"},
    ),
    "class": (
        codes.class_label,
        "string",
        {"IMP": "Inpatient", "AMB": "Ambulatory", "EMER": "Emergency", "imp": "Unknown", None: "Unknown"},
    ),
    "age_group": (
        codes.age_group,
        "int",
        {0: "Child", 17: "Child", 18: "Young Adult", 39: "Young Adult", 40: "Middle Aged",
         64: "Middle Aged", 65: "Senior", None: "Senior"},
    ),
    "age_range": (
        codes.age_range,
        "int",
        {18: "0-18", 19: "19-35", 35: "19-35", 36: "36-50", 50: "36-50", 51: "51-65", 65: "51-65",
         66: "66+", None: "66+"},
    ),
    "provider": (codes.provider_label, "string", {"A": "A", "": "Others", None: "Others", " ": " "}),
    "category": (
        codes.category_label,
        "string",
        {" Line Submitted Charge Amount ": "Submitted Charge",
         "Line Beneficiary Coinsurance Amount": "Coinsurance Amount",
         "LINE ALLOWED CHARGE AMOUNT": "Allowed Charge",
         "Line Provider Payment Amount": "Provider Payment",
         "Line Beneficiary Part B Deductible Amount": "Part B Deductible",
         "Line Processing Indicator Code": "Unknown", None: "Unknown"},
    ),
    "senior": (codes.is_senior, "int", {64: 0, 65: 1, None: 0}),
    "risk": (codes.region_risk, "string", {"CA": 0.8, "NY": 0.8, "ON": 0.4, None: 0.4}),
    "label": (codes.age_label, "int", {50: 0, 51: 1, None: 0}),
    "bare": (codes.bare_key, "string", {"urn:uuid:a": "a", "a": "a", None: None}),
    "after": (codes.key_after_prefix, "string", {"urn:uuid:a": "a", "a": None, None: None}),
    "year": (
        lambda c: codes.age_by_year(c, "2024-12-01"),
        "string",
        {"2000-12-31": 24, "1999-01-01": 25, "bad": None, None: None},
    ),
    "days": (
        lambda c: codes.age_by_days(c, "2024-12-01"),
        "string",
        {"2000-12-01": 24, "2000-12-02": 23, "bad": None, None: None},
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_map(spark, name):
    function, kind, expected = CASES[name]
    assert apply(spark, function, list(expected), kind) == list(expected.values())


def test_minutes(spark):
    df = spark.sql("select timestamp'2020-01-01 00:00:00' a, timestamp'2020-01-02 00:00:30' b")
    assert df.select(codes.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1440.5
