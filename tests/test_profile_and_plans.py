"""The profile, and what the plans must and must not contain."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as book
from carelake.operators import profile
from carelake.plans import cost
from carelake.testbed.book import QUERIES, Lake


def test_profile(spark):
    df = spark.sql(
        """select * from values ('a', 1, array(1), 'x', cast(null as string)), ('a', 1, array(2), null, null),
           ('b', 1, array(3), 'x', null), ('b', 2, array(3), 'x', null), ('c', null, null, null, null)
           as t(kind, n, arr, half, none)"""
    )
    got = {(r.kind, r.column): (r.rows, r.nulls, r.has_value, r.varies) for r in profile.profile(df, "kind").collect()}
    assert got["a", "n"] == (2, 0, True, False)
    assert got["a", "arr"] == (2, 0, True, True)
    assert got["a", "half"] == (2, 1, True, True)
    assert got["a", "none"] == (2, 2, False, False)
    assert got["b", "n"] == (2, 0, True, True) and got["b", "arr"] == (2, 0, True, False)
    assert got["c", "n"] == (1, 1, False, False)
    exact = rows(profile.distinct_counts(df, "kind"))
    assert ("a", "arr", 2) in exact and ("a", "half", 1) in exact and ("c", "n", 0) in exact
    assert rows(profile.distinct_counts(df, "kind", approximate=True)) == exact


def test_sample_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("kind"), "id")
    got = rows(profile.sample_rows(df, "kind", ["id"], 3).select("kind", "id"))
    assert got == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


MODELS = re.compile(r"m1[4-9]|m2\d|m13_hold_out_rows")


def test_no_query_pairs_rows_without_a_key(spark, sf_dir):
    for name, run in QUERIES.items():
        if MODELS.match(name):
            continue  # these fit while they are built
        plan = plan_of(run(spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan, name


def test_features_shuffle_each_table_once(spark, sf_dir, tmp_path):
    from carelake.plans import features
    from carelake.sources import tables
    from carelake.testbed import star

    names = (
        "patient encounter claim condition procedure immunization diagnostic_report".split()
    )
    for n in names:
        tables.write_table(star.flat(spark, sf_dir, n), str(tmp_path), n)
    lake = {n: tables.read_table(spark, str(tmp_path), n) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(features.feature_table(lake, star.AS_OF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == len(names)
    assert plan.count("SortMergeJoin") == len(names) - 1
    # Only the columns that are aggregated are read.
    claim = next(x for x in plan.splitlines() if "FileScan" in x and "claim_id" in x)
    assert "[claim_id#" in claim and claim.split("Batched")[0].count("#") == 3


def test_hot_patient_is_split(spark):
    """A patient with most of the claims: the row-level join splits that partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n = F.col("id")
        claims = spark.range(0, 60000, 1, 8).select(
            F.when(n % 3 < 2, "urn:uuid:p0").otherwise(F.concat(F.lit("urn:uuid:p"), n % 500)).alias("patient_id"),
            F.concat(F.lit("c"), n).alias("claim_id"),
            n.cast("double").alias("total_amount"),
            F.lit("CAD").alias("currency"),
            F.sha2(n.cast("string"), 256).alias("insurance_coverage_display"),
        )
        patients = spark.range(500).select(
            F.concat(F.lit("p"), "id").alias("patient_id"), F.lit("male").alias("gender"), F.lit("1990-01-01").alias("birth_date")
        )
        joined = cost.claims_with_patients(claims, patients)
        got = joined.groupBy(F.isnull("matched_patient_id").alias("missed")).count()
        assert rows(got) == [(False, 60000)]
        assert "skew=true" in plan_of(got)
    finally:
        for name in settings:
            spark.conf.unset(name)


QUICK = (
    "r02_encounter r05_claim r11_immunization g03_claim_fan_out s12_profile k03_encounter_class x10_x12_ages"
    " c02_joined_rows c04_costliest_claims c05_cost_by_encounter_type c08_cost_by_gender d07_age_box"
    " d11_class_by_gender d15_long_inpatient_stays d20_duration_by_class_and_age_group d26_benefit_amounts"
    " d36_value_by_category_and_demographics i05_encounter_costs i09_frequent_reasons m11_risk_features"
    " m13_hold_out_share m19_state_codes"
).split()


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sf_dir, name):
    """One or two of each family; tools/check.py compares all."""
    duckdb = pytest.importorskip("duckdb")
    from tools.check import TABLES, rows_of

    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wanted = duck.execute(book.oracle_sql()[name]).fetch_df()
    got = book.queries()[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows_of(got) == rows_of(wanted)


def test_contract(spark):
    assert set(book.oracle_sql()) <= set(book.queries())
    assert book.entry(spark).columns == ["class_code", "age_group", "avg_duration"]
    assert Lake(spark, "x").sf_dir == "x"


def test_unlisted_genders_have_a_column(spark):
    from carelake.plans import disparity

    rows = [("AMB", "0-18", g, m, 1) for g, m in (("female", 20.0), ("M", 10.0), (None, 30.0))]
    totals = spark.createDataFrame(rows, "class_code string, age_group string, gender string, minutes double, timed long")
    out = disparity.duration_by_class_age_group_and_gender(totals).first()
    assert (out["female"], out["male"], out["unlisted"]) == (20.0, 0.0, 20.0)


def test_resource_profile_sees_undeclared_fields(spark, tmp_path):
    from carelake import jobs

    texts = [
        '{"entry": [{"resource": {"resourceType": "A", "id": "1", "odd field": {"x": [1, 2]}, "same": true, "gone": null}}, {"resource": null}]}',
        '{"entry": [{"resource": {"resourceType": "A", "id": "2", "odd field": {"x": [1, 3]}, "same": true}},\n {"resource": {"id": "3"}}]}',
        '{"entry": []}', "{}", "not a document", "",
    ]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    results = jobs.profile_results(spark, str(tmp_path))
    got = {(r.resource_type, r.column): (r.rows, r.nulls, r.has_value, r.varies) for r in results["fields"].collect()}
    assert got[("A", "odd field")] == (2, 0, True, True) and got[("A", "same")] == (2, 0, True, False)
    assert got[("A", "gone")] == (2, 2, False, False) and got[("", "id")] == (1, 0, True, False)
    assert got[("", "odd field")] == (1, 1, False, False) and len(got) == 2 * 5
    lists = {r.resource_type: r.informative_columns for r in results["field_lists"].collect()}
    assert lists == {"A": ["id", "odd field"], "": []}


def test_features_of_bucketed_tables_need_no_shuffle(spark, sf_dir):
    import uuid

    from carelake.plans import features
    from carelake.testbed import star

    names = ("patient", *features.REFERENCES)
    sources = {n: star.flat(spark, sf_dir, n) for n in names}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = features.bucketed(sources, f"b{uuid.uuid4().hex[:8]}", 4)
        made = features.feature_table(kept, star.AS_OF, span=True)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "Exchange" in features.feature_table(sources, star.AS_OF)._jdf.queryExecution().executedPlan().toString()
        assert rows(made) == rows(features.feature_table(sources, star.AS_OF, span=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
