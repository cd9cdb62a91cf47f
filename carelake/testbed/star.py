"""Clinical resources derived from the star-schema tables, for queries that an SQL oracle can check.

Each resource comes from one row of its source table (order, line, event or customer), so nothing is
gathered into groups: an array in a resource has at most a handful of elements, counted from the key.
Only integer arithmetic and CASE are used, which every engine evaluates alike.

`entries` builds the resource as a struct with the fields its table reads. `documents` renders the
same resources as bundle JSON text, to go through the real parser.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake import schemas
from carelake.operators import flatten

AS_OF = "2024-12-01"


@lru_cache(maxsize=64)
def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, in the reader's splits (`spark.sql.files.maxPartitionBytes`) at every size."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(timestamp: str) -> str:
    return f"concat(date_format({timestamp}, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00')"


def _upto(n: str, body: str) -> str:
    """Array of `body` for i = 1..n with n <= 3; NULL where n is 0."""
    return f"if({n} > 0, transform(slice(array(1, 2, 3), 1, {n}), i -> {body}), null)"


def _concept(code: str, display: str, text: str = "cast(null as string)") -> str:
    coding = f"named_struct('system', 'urn:codes', 'code', {code}, 'display', {display})"
    return f"named_struct('coding', array({coding}), 'text', {text})"


def _ref(reference: str, display: str = "cast(null as string)") -> str:
    return f"named_struct('reference', {reference}, 'display', {display})"


def _money(value: str) -> str:
    return f"named_struct('value', {value}, 'currency', 'CAD')"


def _period(start: str, end: str) -> str:
    return f"named_struct('start', {start}, 'end', {end})"


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _order_rows(spark, sf_dir):
    return star(spark, sf_dir, "orders")


def _with_order_texts(rows):
    """Orders with the ISO times and cents that several resources use."""
    minutes = "15 + (o_orderkey * 7919) % 100000"
    end = f"timestamp_seconds(unix_seconds(cast(o_orderdate as timestamp)) + 60 * ({minutes}))"
    return rows.selectExpr(
        "*",
        f"if(o_orderkey % 61 = 5, null, {_iso('o_orderdate')}) as start_iso",
        f"if(o_orderkey % 25 = 6, null, {_iso(end)}) as end_iso",
        "cast(round(o_totalprice * 100) as bigint) as cents",
        "concat('urn:uuid:p', o_custkey) as subject_ref",
        "concat('urn:uuid:e', o_orderkey) as encounter_ref",
    )


def _orders(spark, sf_dir):
    return _with_order_texts(_order_rows(spark, sf_dir))


def _line_rows(spark, sf_dir):
    """Lines with the part they name and the patient of their order."""
    lines = star(spark, sf_dir, "lineitem")
    part = star(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    orders = star(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"]).join(
        orders, lines["l_orderkey"] == orders["o_orderkey"]
    )


def _with_line_texts(rows):
    return rows.selectExpr(
        "*",
        f"{_iso('l_shipdate')} as ship_iso",
        "concat('urn:uuid:p', o_custkey) as subject_ref",
        "concat('urn:uuid:e', l_orderkey) as encounter_ref",
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey) as line_key",
    )


def _lines(spark, sf_dir):
    return _with_line_texts(_line_rows(spark, sf_dir))


def _people(spark, sf_dir):
    customer = star(spark, sf_dir, "customer")
    nation = star(spark, sf_dir, "nation")
    region = star(spark, sf_dir, "region")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(
        region, nation["n_regionkey"] == region["r_regionkey"]
    )


def _event_rows(spark, sf_dir):
    return star(spark, sf_dir, "events")


def _with_event_texts(rows):
    return rows.selectExpr(
        "*",
        f"{_iso('ts')} as ts_iso",
        "concat('urn:uuid:p', user_id) as subject_ref",
        "concat('urn:uuid:e', event_id) as encounter_ref",
    )


# --- one resource per source row -----------------------------------------------------------------
# `j` renders a value whose JSON shape differs between types: as JSON text in the struct form, as the
# nested value itself in the document form (whose parser then hands the text on).


def _patient(j):
    birth = (
        "concat(1930 + (c_custkey * 37) % 90, '-', lpad(1 + c_custkey % 12, 2, '0'), '-',"
        " lpad(1 + c_custkey % 28, 2, '0'))"
    )
    kind = "named_struct('type', {})".format
    ids = [kind(_concept("'MR'", "'Medical Record Number'")), kind(_concept("'SN'", "'Social Number'"))]
    number = "named_struct('url', '{}', 'valueDecimal', cast({} as double))".format
    place = (
        f"named_struct('url', if(c_custkey % 7 = 0, 'urn:other', '{flatten.GEOLOCATION}'), 'extension',"
        f" array({number('latitude', '40 + c_nationkey / 2')}, {number('longitude', '-(c_custkey % 180)')}))"
    )
    address = _struct(
        city="n_name",
        state="if(c_nationkey % 5 = 0, 'CA', r_name)",
        country="'CA'",
        postalCode="lpad(c_custkey % 1000, 4, '0')",
        extension=f"array({place})",
    )
    none = "cast(null as struct<city:string,state:string,country:string>)"
    born = "named_struct('city', r_name, 'state', n_name, 'country', 'CA')"
    ext = (
        "named_struct('url', 'urn:{}', 'valueString', {}, 'valueDecimal', cast({} as double),"
        " 'valueAddress', {})"
    ).format
    extensions = [
        ext("maiden", "concat('Maiden', c_custkey % 100)", "null", none),
        ext("birthplace", "cast(null as string)", "null", born),
        ext("daly", "cast(null as string)", "c_acctbal", none),
        ext("qaly", "cast(null as string)", "c_acctbal / 2", none),
    ]
    speaks = "named_struct('language', named_struct('text', '{}'))".format
    return "customer", _struct(
        id="concat('p', c_custkey)",
        identifier=f"if(c_custkey % 3 = 0, array({', '.join(ids)}), array({ids[0]}))",
        name="array(named_struct('use', 'official', 'family', c_name, 'given', array('A', 'B'),"
        " 'prefix', cast(null as array<string>)))",
        gender="case when c_custkey % 50 = 7 then null when c_custkey % 2 = 0 then 'male'"
        " else 'female' end",
        birthDate=birth,
        address=f"array({address})",
        telecom="array(named_struct('value', concat('555-', lpad(c_custkey % 10000, 4, '0'))))",
        maritalStatus="named_struct('text', case c_custkey % 4 when 0 then 'M' when 1 then ' S'"
        " when 2 then 'Never Married' end)",
        extension=f"array({', '.join(extensions)})",
        multipleBirthBoolean="c_custkey % 11 = 0",
        communication=f"if(c_nationkey % 2 = 0, array({speaks('English')}, {speaks('French')}),"
        f" array({speaks('English')}))",
    )


def _encounter(j):
    person = _ref(
        "concat('Practitioner?identifier=us-npi|', o_orderkey % 89 + i)",
        "concat('Dr ', o_orderkey % 89 + i)",
    )
    role = _concept("'PPRF'", "'primary performer'")
    participant = _struct(
        individual=person, period=_period("start_iso", "end_iso"), type=f"array({role})"
    )
    kind = _concept("o_orderpriority", "o_orderpriority", "o_orderpriority")
    return "orders", {
        **dict(
            id="concat('e', o_orderkey)",
            status="if(o_orderstatus = 'O', 'in-progress', 'finished')",
            type=j(f"array({kind})"),
            subject=_ref("subject_ref"),
            period=_period("start_iso", "end_iso"),
            serviceProvider=_ref(
                "concat('Organization?identifier=', o_orderkey % 37)",
                "case o_orderkey % 10 when 0 then '' when 1 then null"
                " else concat('Clinic ', o_orderkey % 37) end",
            ),
            participant=_upto("(o_orderkey div 4) % 4", participant),
        ),
        "class": "named_struct('code', case o_orderkey % 4 when 0 then 'AMB' when 1 then 'EMER'"
        " when 2 then 'IMP' else 'HH' end)",
    }


def _condition(j):
    name = "case p_size % 10 when 0 then concat('Chronic ', p_name) when 5 then"
    return "lines", _struct(
        id="concat('d', line_key)",
        clinicalStatus=_concept("if(l_linestatus = 'O', 'active', 'resolved')", "null"),
        verificationStatus=_concept("'confirmed'", "null"),
        code=_concept("p_type", "p_name", f"{name} concat('old chronic ', p_name) else p_name end"),
        subject=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        onsetDateTime="ship_iso",
        abatementDateTime="if(l_linestatus = 'O', null, ship_iso)",
        recordedDate="ship_iso",
    )


def _medication_request(j):
    dose = "named_struct('text', concat('Take ', i, ' daily'))"
    return "lines", _struct(
        id="concat('m', line_key)",
        status="if(l_linestatus = 'O', 'active', 'stopped')",
        intent="'order'",
        medicationCodeableConcept=_concept("p_type", "p_name"),
        subject=_ref("subject_ref"),
        requester=_ref("concat('Practitioner?identifier=us-npi|', l_suppkey)", "concat('Dr ', l_suppkey)"),
        encounter=_ref("encounter_ref"),
        authoredOn="ship_iso",
        dosageInstruction=_upto("l_linenumber % 3", dose),
    )


def _claim(j):
    item = _struct(
        productOrService=_concept(
            "concat('i', (o_orderkey + i) % 500)", "concat('Item ', (o_orderkey + i) % 500)"
        ),
        category=_concept("'c'", "concat('Category ', i)"),
        locationCodeableConcept=_concept("'l'", "if(o_orderkey % 2 = 0, 'Ward', 'Office')"),
        net=_money("(o_orderkey % 1000) * i / 4"),
        encounter=f"array({_ref('encounter_ref')})",
        servicedPeriod=_period("start_iso", "end_iso"),
        adjudication=f"cast(null as {schemas.ADJUDICATION})",
    )
    support = _struct(
        category=_concept("concat('s', i)", "null"),
        valueReference=_ref("concat('urn:uuid:v', o_orderkey, '-', i)"),
    )
    diagnosis = _struct(diagnosisReference=_ref("concat('urn:uuid:d', o_orderkey, '-', i)"))
    insurance = _struct(focal="true", coverage=_ref("null", "o_orderpriority"))
    return "orders", _struct(
        id="concat('c', o_orderkey)",
        status="'active'",
        type=j(_concept("if(o_orderkey % 2 = 0, 'institutional', 'pharmacy')", "null")),
        use="'claim'",
        patient=_ref("subject_ref", "concat('Patient ', o_custkey)"),
        created="end_iso",
        billablePeriod=_period("start_iso", "end_iso"),
        provider=_ref("concat('Organization?identifier=', o_orderkey % 37)"),
        priority=_concept("'normal'", "null"),
        supportingInfo=_upto("o_orderkey % 3", support),
        insurance=f"array({insurance})",
        diagnosis=_upto("(o_orderkey div 3) % 3", diagnosis),
        item=_upto("1 + (o_orderkey div 9) % 3", item),
        total=j(_money("o_totalprice")),
    )


def _explanation_of_benefit(j):
    line = "named_struct('amount', {}, 'category', {})".format
    cents = "cents div 10 * i"
    amounts = {
        "Line Beneficiary Coinsurance Amount": _money(f"({cents} div 5) / 100"),
        "Line Provider Payment Amount": _money(f"({cents} * 4 div 5) / 100"),
        "Line Submitted Charge Amount": _money(f"({cents}) / 100"),
        "Line Allowed Charge Amount": _money(f"({cents}) / 100"),
        "Line Beneficiary Part B Deductible Amount": _money("cast(0 as double)"),
        "Line Processing Indicator Code": "cast(null as struct<value:double,currency:string>)",
    }
    lines = ", ".join(line(a, _concept(f"'{d.lower()}'", f"'{d}'")) for d, a in amounts.items())
    item = _struct(
        productOrService=_concept(
            "concat('i', (o_orderkey + i) % 500)", "concat('Item ', (o_orderkey + i) % 500)"
        ),
        category=_concept("'c'", "concat('Category ', i)"),
        locationCodeableConcept=_concept("'l'", "if(o_orderkey % 2 = 0, 'Ward', 'Office')"),
        net=_money(f"({cents}) / 100"),
        servicedPeriod=_period("start_iso", "end_iso"),
        adjudication=f"if(i = 1 and o_orderkey % 5 = 0, null, array({lines}))",
    )
    team = _struct(
        provider=_ref("concat('Practitioner?identifier=us-npi|', o_orderkey % 89 + i)"),
        role=_concept("'primary'", "'Primary provider'"),
    )
    insurance = _struct(focal="true", coverage=_ref("'#coverage'", "o_orderpriority"))
    submitted = _concept("'submitted'", "null")
    total = f"array(named_struct('category', {submitted}, 'amount', {_money('o_totalprice')}))"
    return "orders", _struct(
        id="concat('b', o_orderkey)",
        identifier="array(named_struct('value', concat('c', o_orderkey)),"
        " named_struct('value', concat('g', o_custkey)))",
        status="'active'",
        type=j(_concept("if(o_orderkey % 2 = 0, 'institutional', 'pharmacy')", "null")),
        use="'claim'",
        patient=_ref("subject_ref"),
        billablePeriod=_period("start_iso", "end_iso"),
        insurer=_ref("null", "o_orderpriority"),
        provider=_ref("concat('Organization?identifier=', o_orderkey % 37)"),
        referral=_ref("'#referral'"),
        claim=_ref("concat('urn:uuid:c', o_orderkey)"),
        outcome="'complete'",
        careTeam=_upto("1 + o_orderkey % 2", team),
        insurance=f"array({insurance})",
        contained=_upto("1 + (o_orderkey div 2) % 2", "named_struct('id', concat('k', i))"),
        item=_upto("1 + (o_orderkey div 4) % 3", item),
        total=j(total),
        payment=f"named_struct('amount', {_money('(cents * 4 div 5) / 100')})",
        created="end_iso",
    )


def _careplan(j):
    detail = _struct(
        code=_concept("concat('a', i)", "concat('Activity ', i)"),
        status="if(o_orderstatus = 'O', 'in-progress', 'completed')",
        location=_ref("null", "concat('Clinic ', o_orderkey % 37)"),
    )
    plan = _concept("'assess-plan'", "null", "concat('Plan ', o_orderpriority)")
    return "orders", _struct(
        id="concat('n', o_orderkey)",
        status="if(o_orderstatus = 'O', 'active', 'completed')",
        intent="'order'",
        category=f"array({j(plan)})",
        subject=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        period=_period("start_iso", "end_iso"),
        created="cast(null as string)",
        careTeam=_upto("1 + o_orderkey % 2", "named_struct('reference', concat('urn:uuid:t', o_orderkey, '-', i))"),
        activity=_upto("(o_orderkey div 2) % 3", f"named_struct('detail', {detail})"),
        addresses=_upto("1 + (o_orderkey div 6) % 2", "named_struct('reference', concat('urn:uuid:d', o_orderkey, '-', i))"),
    )


def _careteam(j):
    member = _struct(
        role="array(" + _concept("concat('r', i)", "null", "concat('Role ', i)") + ")",
        member=_ref(
            "concat('Practitioner?identifier=us-npi|', o_orderkey % 89 + i)",
            "concat('Dr ', o_orderkey % 89 + i)",
        ),
    )
    organization = _ref("concat('Organization?identifier=', o_orderkey % 37)", "concat('Clinic ', o_orderkey % 37)")
    return "orders", _struct(
        id="concat('t', o_orderkey)",
        status="if(o_orderstatus = 'O', 'active', 'inactive')",
        subject=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        period=_period("start_iso", "end_iso"),
        participant=_upto("1 + o_orderkey % 3", member),
        managingOrganization=f"if(o_orderkey % 5 = 0, null, array({organization}))",
    )


def _procedure(j):
    reason = _ref("concat('urn:uuid:d', line_key, '-', i)", "concat(p_name, ' ', i)")
    return "lines", _struct(
        id="concat('r', line_key)",
        status="'completed'",
        code=_concept("concat('t', p_size)", "concat(p_type, ' ', p_size)"),
        subject=_ref("subject_ref"),
        performedPeriod=_period("ship_iso", "ship_iso"),
        encounter=_ref("encounter_ref"),
        reasonReference=_upto("if(l_returnflag = 'N', 0, 1 + l_linenumber % 2)", reason),
    )


def _diagnostic_report(j):
    result = _ref("concat('urn:uuid:o', event_id, '-', i)", "concat('Result ', i)")
    return "events where event_type in ('purchase', 'error')", _struct(
        id="concat('g', event_id)",
        status="'final'",
        category=f"array({j(_concept('event_type', 'upper(event_type)'))})",
        code=_concept("concat('g', event_id % 7)", "concat('Panel ', event_id % 7)"),
        subject=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        effectiveDateTime="ts_iso",
        issued="ts_iso",
        result=_upto("event_id % 4", result),
    )


def _immunization(j):
    return "events where event_type = 'signup'", _struct(
        id="concat('u', event_id)",
        status="'completed'",
        vaccineCode=_concept("concat('v', event_id % 9)", "concat('Vaccine ', event_id % 9)"),
        patient=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        primarySource="event_id % 3 > 0",
        occurrenceDateTime="ts_iso",
    )


def _observation(j):
    return "events where event_type in ('view', 'click')", _struct(
        id="concat('o', event_id)",
        status="'final'",
        category=f"array({j(_concept('event_type', 'upper(event_type)'))})",
        code=_concept("concat('o', event_id % 13)", "concat('Measure ', event_id % 13)"),
        subject=_ref("subject_ref"),
        encounter=_ref("encounter_ref"),
        effectiveDateTime="ts_iso",
        issued="ts_iso",
        valueQuantity="named_struct('value', value, 'unit', 'mg')",
    )


RESOURCES = {
    "patient": ("Patient", _patient),
    "encounter": ("Encounter", _encounter),
    "condition": ("Condition", _condition),
    "medication_request": ("MedicationRequest", _medication_request),
    "claim": ("Claim", _claim),
    "explanation_of_benefit": ("ExplanationOfBenefit", _explanation_of_benefit),
    "careplan": ("CarePlan", _careplan),
    "careteam": ("CareTeam", _careteam),
    "procedure": ("Procedure", _procedure),
    "diagnostic_report": ("DiagnosticReport", _diagnostic_report),
    "immunization": ("Immunization", _immunization),
    "observation": ("Observation", _observation),
}
#: Per source its rows, the columns they are dealt by, and the texts that its resources share.
SOURCES = {
    "customer": (_people, ("c_custkey", "c_name"), lambda rows: rows),
    "orders": (_order_rows, ("o_orderkey", "o_custkey", "o_totalprice"), _with_order_texts),
    "lines": (_line_rows, ("l_orderkey", "l_linenumber", "l_partkey"), _with_line_texts),
    "events": (_event_rows, ("event_id", "user_id"), _with_event_texts),
}


def _resource(table, j):
    """The source of a table's resources, the condition on its rows or "", the SQL expression of the resource."""
    kind, build = RESOURCES[table]
    source, fields = build(j)
    if isinstance(fields, dict):
        fields = "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
    name, _, condition = source.partition(" where ")
    return name, condition, fields.replace("named_struct(", f"named_struct('resourceType', '{kind}', ", 1)


def entries(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    name, condition, resource = _resource(table, lambda x: f"to_json({x})")
    read, _, with_texts = SOURCES[name]
    rows = with_texts(read(spark, sf_dir))
    rows = rows.filter(condition) if condition else rows
    return rows.selectExpr(f"named_struct('resource', {resource}) as entry")


def documents(spark: SparkSession, sf_dir: str, *tables: str, partitions: int | None = None) -> DataFrame:
    """Bundle documents of the tables (all unless given) as JSON text, one per table and source row.

    Tables of one source share its scan, its joins and one shuffle. The shuffle deals the columns as they were read over
    `partitions` (as many as the session's cores unless given), as `read_bundles` deals files: rendering and parsing
    are what takes the time, and a split of the source may hold any number of rows. It goes by a hash, so no rows
    are sorted for it."""
    partitions = partitions or spark.sparkContext.defaultParallelism
    by_source: dict[str, list[tuple[str, str]]] = {}
    for table in tables or RESOURCES:
        name, condition, resource = _resource(table, lambda x: x)
        by_source.setdefault(name, []).append((condition, f"to_json(named_struct('entry', array(named_struct('resource', {resource}))))"))
    every = None
    for name, each in by_source.items():
        read, keys, with_texts = SOURCES[name]
        rows = read(spark, sf_dir)
        if all(condition for condition, _ in each):
            rows = rows.filter(" or ".join(f"({condition})" for condition, _ in each))
        rows = with_texts(rows.repartition(partitions, *keys))
        texts = ", ".join(f"if({condition}, {text}, null)" if condition else text for condition, text in each)
        # texts are made in a projection, whose code is compiled; in the explode, which their lambdas keep from being compiled
        # as a whole, every field of a document would be interpreted
        own = rows.selectExpr(f"array({texts}) as documents")
        # the outer form, as in `bundles.entries`: the plain one would test the array's size before it
        own = own.selectExpr("explode_outer(documents) as document").filter("document is not null")
        every = own if every is None else every.unionByName(own)
    return every


# --- flat tables ----------------------------------------------------------------------------------
# The same tables as the flatteners make, without building the documents first: input of the reports.

FLAT_CONCEPT = "array(named_struct('code', {0}, 'display', {1}))"
FLAT_LINE = "named_struct('amount', {}, 'category', named_struct('coding', {}))".format


def _each(n: str, name: str = "i") -> str:
    return f"explode(slice(array(1, 2, 3), 1, {n})) as {name}"


def _flat_encounter(spark, sf_dir):
    return (
        _orders(spark, sf_dir)
        .selectExpr("*", _each("cast((o_orderkey div 4) % 4 as int)"))
        .selectExpr(
            "concat('e', o_orderkey) as encounter_id",
            "if(o_orderstatus = 'O', 'in-progress', 'finished') as status",
            "case o_orderkey % 4 when 0 then 'AMB' when 1 then 'EMER' when 2 then 'IMP' else 'HH' end"
            " as class_code",
            "o_orderpriority as type_text",
            "start_iso as start_time",
            "end_iso as end_time",
            "subject_ref as patient_reference",
            "concat('Organization?identifier=', o_orderkey % 37) as service_provider_id",
            "case o_orderkey % 10 when 0 then '' when 1 then null"
            " else concat('Clinic ', o_orderkey % 37) end as service_provider_display",
            "concat('Dr ', o_orderkey % 89 + i) as participant_individual_display",
            "concat('Practitioner?identifier=us-npi|', o_orderkey % 89 + i)"
            " as participant_individual_reference",
            "start_iso as participant_period_start",
            "end_iso as participant_period_end",
            "'PPRF' as participant_type_code",
            "'primary performer' as participant_type_display",
        )
    )


def _flat_claim(spark, sf_dir):
    return (
        _orders(spark, sf_dir)
        .selectExpr("*", _each("cast(o_orderkey % 3 as int)", "s"))
        .selectExpr("*", _each("cast((o_orderkey div 3) % 3 as int)", "d"))
        .selectExpr("*", _each("cast(1 + (o_orderkey div 9) % 3 as int)"))
        .selectExpr(
            "concat('c', o_orderkey) as claim_id",
            "subject_ref as patient_reference",
            "o_orderpriority as insurance_coverage_display",
            "o_totalprice as total_amount",
            "'CAD' as currency",
            "encounter_ref as encounter_reference",
        )
    )


def _flat_benefit(spark, sf_dir):
    cents = "cents div 10 * i"
    amounts = {
        "Line Beneficiary Coinsurance Amount": f"({cents} div 5) / 100",
        "Line Provider Payment Amount": f"({cents} * 4 div 5) / 100",
        "Line Submitted Charge Amount": f"({cents}) / 100",
        "Line Allowed Charge Amount": f"({cents}) / 100",
        "Line Beneficiary Part B Deductible Amount": "cast(0 as double)",
    }
    lines = [
        FLAT_LINE(_money(a), FLAT_CONCEPT.format(f"'{n.lower()}'", f"'{n}'"))
        for n, a in amounts.items()
    ]
    none = "cast(null as struct<value:double,currency:string>)"
    name = "Line Processing Indicator Code"
    lines.append(FLAT_LINE(none, FLAT_CONCEPT.format(f"'{name.lower()}'", f"'{name}'")))
    return (
        _orders(spark, sf_dir)
        .selectExpr("*", _each("cast(1 + (o_orderkey div 2) % 2 as int)", "k"))
        .selectExpr("*", _each("cast(1 + o_orderkey % 2 as int)", "t"))
        .selectExpr("*", _each("cast(1 + (o_orderkey div 4) % 3 as int)"))
        .selectExpr(
            "concat('b', o_orderkey) as eob_id",
            "subject_ref as patient_reference",
            "start_iso as billable_period_start",
            "o_orderpriority as insurance_coverage_display",
            f"if(i = 1 and o_orderkey % 5 = 0, null, array({', '.join(lines)})) as adjudication",
            "o_totalprice as total_amount",
            "(cents * 4 div 5) / 100 as payment_amount",
        )
    )


def _flat_procedure(spark, sf_dir):
    return (
        _lines(spark, sf_dir)
        .filter("l_returnflag <> 'N'")
        .selectExpr("*", _each("1 + l_linenumber % 2"))
        .selectExpr(
            "concat('r', line_key) as procedure_id",
            "concat(p_type, ' ', p_size) as procedure_code_display",
            "subject_ref as subject_reference",
            "encounter_ref as encounter_reference",
        )
    )


def _flat_condition(spark, sf_dir):
    return _lines(spark, sf_dir).selectExpr(
        "concat('d', line_key) as condition_id",
        "case p_size % 10 when 0 then concat('Chronic ', p_name) when 5 then"
        " concat('old chronic ', p_name) else p_name end as condition_code_display",
        "subject_ref as patient_reference",
        "encounter_ref as encounter_reference",
    )


# The reports read these from the flat form; other tables go through their flattener.
FLAT = {
    "encounter": _flat_encounter,
    "claim": _flat_claim,
    "explanation_of_benefit": _flat_benefit,
    "procedure": _flat_procedure,
    "condition": _flat_condition,
}


def flat(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table in FLAT:
        return FLAT[table](spark, sf_dir)
    return flatten.TABLES[table](entries(spark, sf_dir, table))


def encounter_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The denormalised encounter file: one row per line.

    Orders meet their people first, so that lines are shuffled twice at most, and never with the people's columns."""
    lines = star(spark, sf_dir, "lineitem")
    orders = star(spark, sf_dir, "orders")
    part = star(spark, sf_dir, "part")
    of_people = orders.join(_people(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(part, lines["l_partkey"] == part["p_partkey"]).join(
        of_people, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rows.selectExpr(
        "concat('e', l_orderkey) as ENCOUNTER_ID",
        "if(c_custkey % 2 = 0, 'M', 'F') as GENDER",
        "n_name as RACE",
        "r_name as ETHNICITY",
        "case c_custkey % 3 when 0 then 'M' when 1 then 'S' end as MARITAL",
        "make_date(cast(1930 + (c_custkey * 37) % 90 as int), cast(1 + c_custkey % 12 as int),"
        " cast(1 + c_custkey % 28 as int)) as BIRTHDATE",
        "o_orderpriority as ENCOUNTER_DESCRIPTION",
        "if(l_linenumber % 3 = 0, null, p_name) as ENCOUNTER_REASON_DESCRIPTION",
        "concat(p_type, ' ', p_size) as PROCEDURE_DESCRIPTION",
        "l_extendedprice as ENCOUNTER_BASE_COST",
        "o_totalprice as ENCOUNTER_TOTAL_CLAIM_COST",
        "(cast(round(l_extendedprice * 100) as bigint) * cast(round(l_discount * 100) as bigint)"
        " div 100) / 100 as ENCOUNTER_PAYER_COVERAGE",
        "p_retailprice as PROCEDURE_BASE_COST",
    )
