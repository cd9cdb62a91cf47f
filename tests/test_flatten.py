"""Hand-made bundle files, read by the real reader."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from carelake import jobs
from carelake.operators import flatten
from carelake.sources import bundles, tables
from carelake.testbed import star


def concept(code, display=None, text=None):
    return {"coding": [{"system": "s", "code": code, "display": display}], "text": text}


def money(value):
    return {"value": value, "currency": "CAD"}


def line(display, value):
    out = {"category": concept(display.lower(), display)}
    return {**out, "amount": money(value)} if value is not None else out


GEO = {
    "url": flatten.GEOLOCATION,
    "extension": [{"url": "latitude", "valueDecimal": 51.5}, {"url": "longitude", "valueDecimal": -113.25}],
}
CLAIM = {
    "resourceType": "Claim",
    "status": "active",
    "type": concept("institutional"),
    "use": "claim",
    "patient": {"reference": "urn:uuid:p1", "display": "Ann"},
    "total": money(27.2),
    "insurance": [{"focal": True, "coverage": {"display": "Plan"}}],
}
ITEM = {
    "productOrService": concept("i1", "Item"),
    "encounter": [{"reference": "urn:uuid:e1"}],
    "net": money(13.6),
}

FIRST = [
    {
        "resourceType": "Patient",
        "id": "p1",
        "identifier": [{"system": "x", "value": "1"}, {"value": "2", "type": concept("MR", "Record")}],
        "name": [{"use": "official", "family": "A", "given": ["B"]}],
        "gender": "female",
        "birthDate": "1980-02-03",
        "address": [{"city": "Calgary", "state": "AB", "country": "CA", "postalCode": "T1", "extension": [{"url": "other"}, GEO]}],
        "telecom": [{"value": "555"}],
        "maritalStatus": {"text": "M"},
        "extension": [
            {"url": "a", "valueString": "Maiden"},
            {"url": "b", "valueAddress": {"city": "Regina", "state": "SK", "country": "CA"}},
            {"url": "c", "valueDecimal": 0.5},
            {"url": "d", "valueDecimal": 40},
        ],
        "multipleBirthBoolean": False,
        "communication": [{"language": {"text": "English"}}, {"language": {"text": "French"}}],
    },
    {
        "resourceType": "Encounter",
        "id": "e1",
        "status": "finished",
        "class": {"code": "AMB"},
        "type": [concept("185349003", "Check up", "Check up text")],
        "subject": {"reference": "urn:uuid:p1"},
        "period": {"start": "2018-12-11T05:16:00-05:00", "end": "2018-12-11T05:31:00-05:00"},
        "serviceProvider": {"reference": "Organization?identifier=o|1", "display": "Clinic"},
        "participant": [
            {"individual": {"reference": "Practitioner?identifier=n|1", "display": "Dr A"}, "type": [concept("PPRF", "primary performer")]},
            {"individual": {"reference": "Practitioner?identifier=n|2", "display": "Dr B"}},
        ],
    },
    {"resourceType": "Encounter", "id": "e2", "subject": {"reference": "urn:uuid:p1"}},
    {
        "resourceType": "Condition",
        "id": "d1",
        "clinicalStatus": concept("active"),
        "verificationStatus": concept("confirmed"),
        "code": concept("1", "Sinusitis", "Chronic sinusitis"),
        "subject": {"reference": "urn:uuid:p1"},
        "encounter": {"reference": "urn:uuid:e1"},
        "onsetDateTime": "2018-01-01",
        "recordedDate": "2018-01-02",
    },
    {
        "resourceType": "MedicationRequest",
        "id": "m1",
        "status": "active",
        "intent": "order",
        "medicationCodeableConcept": concept("2", "Ibuprofen"),
        "subject": {"reference": "urn:uuid:p1"},
        "requester": {"reference": "r", "display": "Dr A"},
        "encounter": {"reference": "urn:uuid:e1"},
        "authoredOn": "2018-01-01",
        "dosageInstruction": [{"text": "one"}, {"text": "two"}],
    },
    # 2 items x 2 diagnoses x 1 supporting information x 1 insurance
    {
        **CLAIM,
        "id": "c1",
        "item": [ITEM, {**ITEM, "net": money(1.5)}],
        "diagnosis": [{"diagnosisReference": {"reference": "urn:uuid:d1"}}, {"diagnosisReference": {"reference": "urn:uuid:d2"}}],
        "supportingInfo": [{"category": concept("info"), "valueReference": {"reference": "urn:uuid:v"}}],
    },
    {**CLAIM, "id": "c2", "item": [ITEM]},
    {
        "resourceType": "ExplanationOfBenefit",
        "id": "b1",
        "identifier": [{"value": "claim"}, {"value": "group"}],
        "type": concept("professional"),
        "patient": {"reference": "urn:uuid:p1"},
        "total": [{"category": concept("submitted"), "amount": money(167.2)}],
        "payment": {"amount": money(133.76)},
        "contained": [{"id": "r"}, {"id": "c"}],
        "careTeam": [{"provider": {"reference": "Practitioner?identifier=n|1"}, "role": concept("primary", "Primary")}],
        "insurance": [{"focal": True, "coverage": {"reference": "#coverage", "display": "Plan"}}],
        "item": [
            {"productOrService": concept("i1", "Visit")},
            {"productOrService": concept("i2", "Shot"), "net": money(140.5), "adjudication": [line("Line Allowed Charge Amount", 140.5), line("Line Processing Indicator Code", None)]},
        ],
    },
]
SECOND = [
    {"resourceType": "Patient", "id": "p2"},
    {
        "resourceType": "CarePlan",
        "id": "n1",
        "category": [concept("assess-plan", None, "Diabetes plan"), "plain text"],
        "careTeam": [{"reference": "urn:uuid:t1"}],
        "activity": [{"detail": {"code": concept("a", "Exercise"), "status": "in-progress", "location": {"display": "Home"}}}],
        "addresses": [{"reference": "urn:uuid:d1"}, {"reference": "urn:uuid:d2"}],
    },
    {"resourceType": "CarePlan", "id": "n2", "category": ["plain text"], "careTeam": [{"reference": "t"}], "activity": [{}]},
    {
        "resourceType": "CareTeam",
        "id": "t1",
        "managingOrganization": [{"display": "Clinic"}],
        "participant": [{"role": [concept("r", None, "Patient")], "member": {"reference": "urn:uuid:p2", "display": "Bob"}}],
    },
    {"resourceType": "CareTeam", "id": "t2", "participant": [{"role": [concept("r", None, "Patient")]}]},
    {"resourceType": "Procedure", "id": "r1", "code": concept("x", "X-ray"), "reasonReference": [{"reference": "urn:uuid:d1", "display": "Break"}]},
    {"resourceType": "Procedure", "id": "r2", "code": concept("y", "Check")},
    {
        "resourceType": "DiagnosticReport",
        "id": "g1",
        "category": [concept("LAB", "Laboratory")],
        "code": concept("58410-2", "Panel"),
        "subject": {"reference": "urn:uuid:p2"},
        "result": [{"display": "Sodium"}, {"display": "Glucose"}],
    },
    {"resourceType": "Immunization", "id": "u1", "vaccineCode": concept("140", "Influenza"), "patient": {"reference": "urn:uuid:p2"}, "primarySource": True},
    {
        "resourceType": "Observation",
        "id": "o1",
        "category": [concept("vital-signs", "Vital signs")],
        "code": concept("8302-2", "Height"),
        "subject": {"reference": "urn:uuid:p2"},
        "valueQuantity": {"value": 167.2, "unit": "cm"},
    },
]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundles")
    for name, resources in (("one", FIRST), ("two", SECOND), ("empty", [])):
        document = {"resourceType": "Bundle", "entry": [{"fullUrl": "u", "resource": r} for r in resources]}
        (folder / f"{name}.json").write_text(json.dumps(document, indent=2))
    (folder / "broken.json").write_text('{"resourceType": "Bundle", "entry": [')
    return str(folder)


@pytest.fixture(scope="module")
def entries(spark, lake):
    return bundles.entries(bundles.read_bundles(spark, lake, partitions=2))


def test_entries(entries):
    assert entries.count() == len(FIRST) + len(SECOND)


def test_patient(entries):
    got = {r.patient_id: r.asDict(recursive=True) for r in flatten.patient(entries).collect()}
    p1, p2 = got["p1"], got["p2"]
    assert p1["identifier_types"] == [None, "Record"]
    assert (p1["latitude"], p1["longitude"]) == (51.5, -113.25)
    assert p1["languages"] == ["English", "French"]
    assert (p1["mothers_maiden_name"], p1["birthplace_city"]) == ("Maiden", "Regina")
    assert (p1["disability_adjusted_life_years"], p1["quality_adjusted_life_years"]) == (0.5, 40.0)
    assert p1["multiple_birth"] is False and p1["name"][0]["family"] == "A"
    # Nothing but an id: no error from missing arrays, all else NULL.
    assert {k: v for k, v in p2.items() if v is not None} == {"patient_id": "p2"}


def test_encounter(entries):
    got = rows(
        flatten.encounter(entries).select(
            "encounter_id", "type_text", "participant_individual_display", "participant_type_code"
        )
    )
    assert got == [("e1", "Check up text", "Dr A", "PPRF"), ("e1", "Check up text", "Dr B", None)]
    assert flatten.encounter(entries, outer=True).count() == 3


def test_claim_fan_out(entries):
    claims = flatten.claim(entries)
    got = rows(claims.select("claim_id", "item_net_value", "diagnosis_reference", "total_amount", "type_code"))
    assert got == sorted(
        ("c1", net, f"urn:uuid:{d}", 27.2, "institutional") for net in (13.6, 1.5) for d in ("d1", "d2")
    )
    kept = flatten.claim(entries, outer=True)
    assert rows(kept.groupBy("claim_id").count()) == [("c1", 4), ("c2", 1)]


def test_benefit(entries):
    eob = flatten.explanation_of_benefit(entries)
    got = rows(eob.select("eob_id", "code", "total_amount", "payment_amount", "item_service_code", F.size("adjudication")))
    # Two contained resources: each item twice. The list-valued total is read.
    row = lambda item, n: ("b1", "professional", 167.2, 133.76, item, n)
    assert got == [row("i1", None)] * 2 + [row("i2", 2)] * 2 or got == [row("i1", -1)] * 2 + [row("i2", 2)] * 2


def test_careplan(entries):
    got = rows(flatten.careplan(entries).select("careplan_id", "category_text", "activity_display", "addresses"))
    assert got == [
        ("n1", "Diabetes plan", "Exercise", ["urn:uuid:d1", "urn:uuid:d2"]),
        ("n2", None, None, None),
    ]


def test_small_tables(entries):
    assert rows(flatten.careteam(entries).select("care_team_id", "participant_role", "managing_organization")) == [
        ("t1", "Patient", "Clinic")
    ]
    assert rows(flatten.procedure(entries).select("procedure_id", "reason_reference_display")) == [("r1", "Break")]
    assert rows(flatten.procedure(entries, outer=True).select("procedure_id")) == [("r1",), ("r2",)]
    assert rows(flatten.medication_request(entries).select("medication_display", "dosage_text")) == [
        ("Ibuprofen", "one"), ("Ibuprofen", "two")
    ]
    assert rows(flatten.condition(entries).select("condition_id", "clinical_status", "condition_code_display")) == [
        ("d1", "active", "Chronic sinusitis")
    ]
    assert rows(flatten.diagnostic_report(entries).select("code", "code_system", "result_display", "category_display")) == [
        ("Panel", "58410-2", "Glucose", "Laboratory"), ("Panel", "58410-2", "Sodium", "Laboratory")
    ]
    assert rows(flatten.immunization(entries).select("vaccine_display", "primary_source")) == [("Influenza", True)]
    assert rows(flatten.observation(entries).select("observation_code_display", "value_quantity_value", "category_display")) == [
        ("Height", 167.2, "Vital signs")
    ]


def test_flatten_job_writes_twelve_tables(spark, lake, entries, tmp_path):
    out = str(tmp_path / "lake")
    jobs.flatten_job(spark, lake, out)
    for name, build in flatten.TABLES.items():
        wanted = build(entries)
        got = tables.read_table(spark, out, name)
        assert got.columns == wanted.columns
        assert rows(got.select(*got.columns)) == rows(wanted), name


def test_staged_entries_prune(spark, lake, tmp_path):
    """A table scans the directory of its type, and of that its own fields."""
    staged = bundles.stage_entries(bundles.read_bundles(spark, lake), str(tmp_path / "staged"))
    plan = flatten.immunization(staged)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(resource_type" in scan
    schema = flatten.immunization(staged)._jdf.queryExecution().executedPlan().treeString()
    assert "vaccineCode" in schema and "dosageInstruction" not in schema.split("ReadSchema")[-1]


def test_cached_entries(spark, lake):
    cached = bundles.cached_entries(bundles.read_bundles(spark, lake))
    assert cached.is_cached and flatten.observation(cached).count() == 1
    cached.unpersist()


def test_schema_does_not_depend_on_the_sample(spark, lake, tmp_path):
    (tmp_path / "tiny.json").write_text(json.dumps({"entry": [{"resource": {"resourceType": "Patient", "id": "q"}}]}))
    tiny = bundles.entries(bundles.read_bundles(spark, str(tmp_path)))
    whole = bundles.entries(bundles.read_bundles(spark, lake))
    for build in flatten.TABLES.values():
        assert build(tiny).schema == build(whole).schema


def test_malformed_documents_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "bundles"
    folder.mkdir()
    good = '{"entry": [{"resource": {"resourceType": "Patient", "id": "p%d"}}, {"resource": {"resourceType": "Claim", "id": "c"}}]}'
    for i in range(3):
        (folder / f"{i}.json").write_text(good % i if i else (good % i)[:-2])
    (folder / "empty.json").write_text("{}")
    staged = bundles.stage_entries(bundles.read_bundles(spark, str(folder)), str(tmp_path / "staged"))
    lost = bundles.rejected(staged).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["text"]) for r in lost] == [("0.json", (good % 0)[:-2])]
    assert {"p1", "p2"} <= {r["id"] for r in bundles.resources(staged, "Patient").collect()}
    assert bundles.resources(staged, "Claim").count() >= 2
    tidy = bundles.stage_entries(bundles.read_bundles(spark, str(folder / "[12].json")), str(tmp_path / "tidy"))
    assert bundles.rejected(tidy).count() == 0


def test_one_resource_a_line(spark, tmp_path):
    """The rows of bundles, from lines of one big file that several tasks read."""
    import json

    both = [r for r in FIRST + SECOND]
    lines = [json.dumps(r) for r in both] * 400
    (tmp_path / "all.ndjson").write_text("\n".join(lines) + "\n\n{broken\n")
    (tmp_path / "bundle.json").write_text(json.dumps({"entry": [{"resource": r} for r in both]}))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        read = bundles.read_resources(spark, str(tmp_path / "all.ndjson"))
        assert read.rdd.getNumPartitions() >= 4
        sizes = read.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    whole = bundles.entries(bundles.read_bundles(spark, str(tmp_path / "bundle.json")))
    got = sorted(str(r) for r in bundles.entries(read).collect())
    assert got == sorted(str(r) for r in whole.collect() for _ in range(400))
    jobs.flatten_job(spark, str(tmp_path / "all.ndjson"), str(tmp_path / "lake"), lines=True)
    assert [r.text for r in spark.read.parquet(str(tmp_path / "lake/rejected")).collect()] == ["{broken"]
    assert spark.read.parquet(str(tmp_path / "lake/patient")).count() == 400 * sum(r["resourceType"] == "Patient" for r in both)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("table", ["claim", "explanation_of_benefit", "encounter"])
def test_texts_of_a_resource_are_parsed_before_its_arrays_become_rows(spark, sf_dir, table):
    """Not once for each of the rows it becomes: only the explosion of the entries themselves is below the parsing."""
    lines = _plan(flatten.TABLES[table](bundles.entries(bundles.parse_bundles(star.documents(spark, sf_dir, table), F.col("document"))))).split("\n")
    parsing = [i for i, line in enumerate(lines) if "from_json(" in line]
    exploding = [i for i, line in enumerate(lines) if "Generate explode(" in line]
    of_entries = next(i for i in exploding if "explode(entry#" in lines[i])
    assert len(parsing) > 1 and all(i < parsing[0] for i in exploding if i < of_entries)


def test_documents_of_one_source_share_its_rows(spark, sf_dir):
    """One shuffle by a hash and one scan for each source, of columns as they were read; the documents are those of each table."""
    plan = _plan(star.documents(spark, sf_dir))
    assert plan.count("RepartitionByExpression [") == 4 and "RoundRobin" not in plan
    scans = [line for line in plan.split("\n") if "Relation [" in line]
    assert sum("l_shipdate" in line for line in scans) == 1 and sum("ts#" in line for line in scans) == 1
    below = plan[plan.index("RepartitionByExpression [") :].split("Join")[0].split("\nUnion")[0]
    assert "date_format" not in below.split("Relation")[0]
    together = star.documents(spark, sf_dir, "claim", "immunization", "observation", "procedure")
    apart = [star.documents(spark, sf_dir, t) for t in ("claim", "immunization", "observation", "procedure")]
    every = apart[0].unionByName(apart[1]).unionByName(apart[2]).unionByName(apart[3])
    assert together.exceptAll(every).isEmpty() and every.exceptAll(together).isEmpty()


def test_documents_are_rendered_by_compiled_code(spark, sf_dir):
    """The texts are made in projections; an explode that made them would interpret every field."""
    plan = star.documents(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    generates, projects = ([line for line in plan if f"{node} " in line] for node in ("Generate", "Project"))
    assert len(generates) == 4 and not any("ToJson" in line for line in generates)
    assert sum("ToJson" in line for line in projects) == 4
