"""The weighted forms against the joins they stand for, laid out row by row on a small fixture in which
one patient owns most rows, and keys are missing and repeated."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake.functions import codes
from carelake.plans import cost, disparity as d
from carelake.sources import tables


@pytest.fixture(scope="module")
def cost_tables(spark):
    claims, encounters, procedures = [], [], []
    for i in range(60):
        p = "urn:uuid:hot" if i % 3 else f"urn:uuid:p{i}"
        claims += [(p, f"c{i}", None if i % 7 == 0 else 10.25 * i, "CAD", "Plan")] * (1 + i % 2)
        encounters += [(f"e{i}", p if i % 4 else None, "2020", "2021", "o", ["A", "", None][i % 3], ["x", "y", None][i % 3 - 1])] * (1 + i % 3)
    claims += [(None, "c_none", 5.0, "CAD", "Plan"), ("urn:uuid:alone", "c_alone", 7.5, "CAD", None)]
    for i in range(80):
        procedures.append((f"r{i}", f"e{i % 70}" if i % 9 else None, ["X", "Y", None][i % 3]))
    return (
        spark.createDataFrame(claims, "patient_id string, claim_id string, total_amount double, currency string, insurance_coverage_display string"),
        spark.createDataFrame(encounters, "encounter_id string, patient_id string, start_time string, end_time string, service_provider_id string, service_provider_display string, type_text string"),
        spark.createDataFrame(procedures, "procedure_id string, encounter_id string, procedure_code_display string"),
    )


def costs(df, key):
    return df.groupBy(key).agg(
        F.avg("total_amount").alias("avg_cost"),
        F.sum("total_amount").alias("total_cost"),
        F.count("total_amount").alias("num_encounters"),
    )


def test_claims_with_encounters(cost_tables):
    claims, encounters, _ = cost_tables
    full = claims.join(encounters, "patient_id", "left")
    weighted = cost.claims_with_encounters(claims, encounters)
    assert weighted.count() == claims.count()
    assert rows(weighted.groupBy("claim_id").agg(F.sum("copies"))) == rows(full.groupBy("claim_id").count())


def test_cost_reports(cost_tables):
    claims, encounters, _ = cost_tables
    full = claims.join(encounters, "patient_id", "left")
    assert rows(cost.cost_by_encounter_type(claims, encounters)) == rows(costs(full, "type_text"))
    named = full.withColumn("service_provider_display", codes.provider_label(F.col("service_provider_display")))
    assert rows(cost.cost_by_provider(claims, encounters)) == rows(costs(named, "service_provider_display"))


@pytest.mark.parametrize("k", [1, 10, 500])
def test_costliest_claims(cost_tables, k):
    claims, encounters, _ = cost_tables
    full = claims.join(encounters, "patient_id", "left").select(
        *claims.columns, *(c for c in encounters.columns if c != "patient_id")
    )
    wanted = cost.top(full, k, "total_amount", *cost.CLAIM_ORDER, *cost.ENCOUNTER_ORDER)
    assert rows(cost.costliest_claims(claims, encounters, k)) == rows(wanted)


def test_procedures(cost_tables):
    claims, encounters, procedures = cost_tables
    full = procedures.join(claims.join(encounters, "patient_id", "left"), "encounter_id", "left")
    weighted = cost.procedures_with_claims(procedures, claims, encounters)
    wanted = full.groupBy("procedure_id").agg(F.count("*"), F.sum("total_amount"))
    assert rows(weighted.select("procedure_id", "copies", "joined_amount")) == rows(wanted)
    wanted = full.groupBy("procedure_code_display").agg(
        F.sum("total_amount"), F.avg("total_amount"), F.count("procedure_code_display")
    )
    assert rows(cost.cost_by_procedure(procedures, claims, encounters)) == rows(wanted)


@pytest.fixture(scope="module")
def benefit_tables(spark):
    line = "struct<amount:struct<value:double,currency:string>,category:struct<coding:array<struct<code:string,display:string>>>>"
    names = ["Line Submitted Charge Amount", "line allowed charge amount ", "Line Provider Payment Amount", "Line Processing Indicator Code"]
    eob = []
    for i in range(40):
        p = "urn:uuid:hot" if i % 3 else f"urn:uuid:p{i % 9}"
        lines = [((float(i + j), "CAD") if j < 3 else None, ([(str(j), names[j])],)) for j in range(1 + i % 4)]
        eob += [(f"b{i % 25}", p, "2020" if i % 2 else None, lines if i % 5 else None)] * (1 + i % 2)
    patients = [(p, g, a, m) for p, g, a, m in zip(["hot", "p0", "p3", "p6", "gone"], ["male", "female", None, "male", "male"], [30, 70, None, 5, 6], ["Married"] * 5)]
    encounters = [(p, c, t) for i in range(30) for p, c, t in [("hot" if i % 2 else f"p{i % 9}", ["Inpatient", "Ambulatory"][i % 2], None if i % 11 == 0 else 40000.0 * (i % 4))]]
    return (
        spark.createDataFrame(eob, f"eob_id string, patient_reference string, billable_period_start string, adjudication array<{line}>"),
        spark.createDataFrame(patients, "patient_id string, gender string, age int, marital_status string"),
        spark.createDataFrame(encounters, "patient_reference string, class_code string, encounter_duration double"),
    )


def full_lines(eob, patients, encounters):
    lines = d.adjudication_lines(eob).drop("category_code")
    joined = lines.join(eob.select("eob_id", "billable_period_start"), "eob_id")
    joined = joined.withColumn("patient_reference", codes.bare_key(F.col("patient_reference")))
    known = encounters.join(patients, F.col("patient_reference") == F.col("patient_id"))
    known = known.withColumn("age_group", codes.age_group(F.col("age")))
    return joined.join(known.select("patient_reference", *d.DEMOGRAPHICS), "patient_reference")


def test_lines(benefit_tables):
    eob, patients, encounters = benefit_tables
    usual = d.without_outliers(encounters)
    full = full_lines(eob, patients, usual)
    weights = d.patient_weights(usual, patients)
    weighted = d.lines_with_demographics(d.lines_with_claims(d.adjudication_lines(eob), eob), weights)
    columns = [c for c in weighted.columns if c != "copies"]
    wanted = full.groupBy(*columns).agg(F.count("*").alias("copies"))
    got = weighted.groupBy(*columns).agg(F.sum("copies").alias("copies"))
    assert full.count() > weighted.count() and rows(got) == rows(wanted)


@pytest.mark.parametrize("keys", [(), ("gender",), ("gender", "age_group", "marital_status")])
def test_mean_values(benefit_tables, keys):
    eob, patients, encounters = benefit_tables
    usual = d.without_outliers(encounters)
    full = d.reported_lines(full_lines(eob, patients, usual))
    wanted = full.groupBy("category_display", *keys).agg(F.avg("value").alias("avg_value"))
    totals = d.category_totals(eob, d.patient_weights(usual, patients))
    assert rows(d.mean_values(totals, *keys)) == rows(wanted)


def test_totals_read_the_benefits_once(benefit_tables, tmp_path):
    eob, patients, encounters = benefit_tables
    kept = tables.kept(eob, str(tmp_path), "benefits")
    weights = d.patient_weights(d.without_outliers(encounters), patients)
    plan = d.category_totals(kept, weights)._jdf.queryExecution().optimizedPlan().toString()
    alone = weights._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [eob_id") == 1 and plan.count("Join ") == alone.count("Join ") + 1


def test_benefits_without_lines_or_id(benefit_tables, spark):
    eob, patients, encounters = benefit_tables
    usual = d.without_outliers(encounters)
    odd = eob.withColumn("adjudication", F.expr("if(hash(eob_id) % 2 = 0, null, adjudication)"))
    odd = odd.unionByName(eob.withColumn("eob_id", F.lit(None).cast("string")))
    full = d.reported_lines(full_lines(odd, patients, usual))
    wanted = full.groupBy("category_display").agg(F.avg("value").alias("avg_value"))
    assert rows(d.mean_values(d.category_totals(odd, d.patient_weights(usual, patients)))) == rows(wanted)


def test_durations(benefit_tables):
    _, patients, encounters = benefit_tables
    known = encounters.join(patients, F.col("patient_reference") == F.col("patient_id"))
    known = known.withColumn("age_group", codes.age_group(F.col("age")))
    totals = d.encounter_totals(encounters, patients)
    for keys in (("gender",), ("class_code", "age_group")):
        wanted = known.groupBy(*keys).agg(F.avg("encounter_duration").alias("avg_duration"))
        assert rows(d.mean_durations(totals, *keys)) == rows(wanted)
    wanted = known.groupBy("class_code").agg(F.avg("encounter_duration"), F.max("encounter_duration"))
    assert rows(d.mean_and_longest(totals, "class_code")) == rows(wanted)
    assert d.overlap(encounters, patients).first()[0] == known.count()


def test_outlier_rules(spark):
    cases = [("Inpatient", 86400.0), ("Inpatient", 86401.0), ("Inpatient", None), ("Ambulatory", 90000.0), ("Unknown", None), ("Inpatient", 1440.0), ("Inpatient", 1441.0)]
    df = spark.createDataFrame(cases, "class_code string, encounter_duration double")
    assert rows(d.without_outliers(df)) == sorted(
        [c for c in cases if c[0] != "Inpatient" or (c[1] is not None and c[1] <= 86400)], key=repr
    )
    assert rows(d.outliers(df)) == [("Ambulatory", 90000.0), ("Inpatient", 86401.0)]
    assert rows(d.long_inpatient_stays(df)) == [("Inpatient", 1441.0), ("Inpatient", 86400.0), ("Inpatient", 86401.0)]


def test_pivots_hold_the_long_form(benefit_tables):
    _, patients, encounters = benefit_tables
    totals = d.encounter_totals(encounters, patients)
    long = {(r.class_code, r.age_group): r.avg_duration for r in d.mean_durations(totals, "class_code", "age_group").collect()}
    for r in d.duration_by_class_and_age_group(totals).collect():
        for group in d.AGE_GROUPS:
            assert r[group] == (long.get((r.class_code, group)) or 0.0)
    sets = d.mean_durations_by_sets(totals, [("class_code",), ("class_code", "age_group")])
    got = sets.filter("keys = 'class_code,age_group'").select("class_code", "age_group", "avg_duration")
    assert rows(got) == rows(d.mean_durations(totals, "class_code", "age_group"))


def test_shares_sum_to_one(cost_tables, spark):
    claims, _, _ = cost_tables
    patients = spark.createDataFrame([("hot", "male", "1990-01-01"), ("p0", "female", None)], "patient_id string, gender string, birth_date string")
    shares = cost.cost_by_gender(claims, patients)
    assert abs(shares.agg(F.sum("share")).first()[0] - 1) < 1e-9
    # p0 has one claim, without an amount: no total, listed last.
    assert [r.gender for r in shares.collect()] == ["male", None, "female"]
    once = cost.one_row_each(claims)
    assert once.count() == claims.select("claim_id").distinct().count()


def test_age_box(spark):
    df = spark.createDataFrame([(a,) for a in (1, 2, 2, 3, 4, 5, 100, None)], "age int")
    box = d.age_box(df).first().asDict()
    assert box == {"lowest": 1, "whisker_low": 1, "q1": 2.25, "median": 3.5, "q3": 4.75, "whisker_high": 5, "highest": 100, "outliers": 1}


def test_distinct_counts(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id") % 500).alias("v"))
    assert d.distinct_count(df, "v", "n").first().n == 501  # NULL is one
    assert abs(d.approx_distinct_count(df, "v", "n").first().n - 500) < 40


def test_claim_lines_are_the_joined_lines(benefit_tables, spark):
    eob, _, _ = benefit_tables
    odd = eob.withColumn("adjudication", F.expr("if(hash(eob_id) % 3 = 0, null, adjudication)"))
    odd = odd.unionByName(eob.withColumn("eob_id", F.lit(None).cast("string")))
    odd = odd.unionByName(eob.limit(9).withColumn("patient_reference", F.lit(None).cast("string")))
    for table in (eob, odd, eob.limit(0)):
        wanted = d.lines_with_claims(d.adjudication_lines(table), table)
        assert d.claim_lines(table).columns == wanted.columns
        assert rows(d.claim_lines(table)) == rows(wanted)


def test_lines_are_not_broadcast(benefit_tables):
    """A table with few bytes can hold very many lines."""
    eob, patients, encounters = benefit_tables
    weights = d.patient_weights(encounters, patients)
    for lines in (d.claim_lines(eob), d.lines_with_claims(d.adjudication_lines(eob), eob)):
        for result in (lines, d.lines_with_demographics(lines, weights).select("category_display").distinct()):
            plan = result._jdf.queryExecution().sparkPlan().toString()
            # the weights' own join is of one row a patient
            assert plan.count("BroadcastHashJoin") <= (result is not lines) and "SortMergeJoin" in plan
