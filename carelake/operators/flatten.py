"""Resource documents to flat tables.

A function per table, from entries to rows. Where a table has one row per element of an array,
resources without such an element have no row; `outer=True` keeps them, with NULLs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from carelake import schemas
from carelake.sources.bundles import resources

# Fixed value: the extension that holds latitude and longitude, in this order.
GEOLOCATION = "http://hl7.org/fhir/StructureDefinition/geolocation"


def _nth(array: Column | str, i: int = 0) -> Column:
    """Element `i`, NULL when there is none."""
    return F.get(F.col(array) if isinstance(array, str) else array, F.lit(i))


def _coding(concept: Column | str, field: str) -> Column:
    """A field of the first coding of a concept."""
    concept = F.col(concept) if isinstance(concept, str) else concept
    return _nth(concept["coding"])[field]


def _table(rows: DataFrame, **columns: Column | str) -> DataFrame:
    return rows.select(
        *(
            (F.col(value) if isinstance(value, str) else value).alias(name)
            for name, value in columns.items()
        )
    )


def _per_element(rows: DataFrame, outer: bool, *arrays: str) -> DataFrame:
    """One row per combination of elements; each array column becomes its element."""
    generate = F.explode_outer if outer else F.explode
    for name in arrays:
        rows = rows.withColumn(name, generate(name))
    return rows


def patient(entries: DataFrame) -> DataFrame:
    home = _nth("address")
    place = _nth(F.filter(home["extension"], lambda x: x["url"] == GEOLOCATION))["extension"]
    birthplace = _nth("extension", 1)["valueAddress"]
    return _table(
        resources(entries, "Patient"),
        patient_id="id",
        identifier_types=F.transform("identifier", lambda x: _coding(x["type"], "display")),
        name="name",
        gender="gender",
        birth_date="birthDate",
        city=home["city"],
        state=home["state"],
        country=home["country"],
        postal_code=home["postalCode"],
        latitude=_nth(place, 0)["valueDecimal"],
        longitude=_nth(place, 1)["valueDecimal"],
        phone=_nth("telecom")["value"],
        marital_status="maritalStatus.text",
        mothers_maiden_name=_nth("extension", 0)["valueString"],
        birthplace_city=birthplace["city"],
        birthplace_state=birthplace["state"],
        birthplace_country=birthplace["country"],
        disability_adjusted_life_years=_nth("extension", 2)["valueDecimal"],
        quality_adjusted_life_years=_nth("extension", 3)["valueDecimal"],
        multiple_birth="multipleBirthBoolean",
        languages=F.transform("communication", lambda x: x["language"]["text"]),
    )


def encounter(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per participant."""
    # texts are parsed once for each resource, here and below, before its arrays become rows
    rows = resources(entries, "Encounter").withColumn("type", _nth(F.from_json("type", schemas.CONCEPTS))["text"])
    rows = _per_element(rows, outer, "participant")
    role = _nth("participant.type")
    return _table(
        rows,
        encounter_id="id",
        status="status",
        class_code="class.code",
        type_text="type",
        start_time="period.start",
        end_time="period.end",
        patient_reference="subject.reference",
        service_provider_id="serviceProvider.reference",
        service_provider_display="serviceProvider.display",
        participant_individual_display="participant.individual.display",
        participant_individual_reference="participant.individual.reference",
        participant_period_start="participant.period.start",
        participant_period_end="participant.period.end",
        participant_type_code=_coding(role, "code"),
        participant_type_display=_coding(role, "display"),
    )


def condition(entries: DataFrame) -> DataFrame:
    return _table(
        resources(entries, "Condition"),
        condition_id="id",
        clinical_status=_coding("clinicalStatus", "code"),
        verification_status=_coding("verificationStatus", "code"),
        condition_code_display="code.text",
        patient_reference="subject.reference",
        encounter_reference="encounter.reference",
        onset_datetime="onsetDateTime",
        abatement_datetime="abatementDateTime",
        recorded_date="recordedDate",
    )


def medication_request(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per dosage instruction."""
    return _table(
        _per_element(resources(entries, "MedicationRequest"), outer, "dosageInstruction"),
        medication_request_id="id",
        status="status",
        intent="intent",
        medication_display=_coding("medicationCodeableConcept", "display"),
        patient_reference="subject.reference",
        requester_reference="requester.reference",
        requester_display="requester.display",
        encounter_reference="encounter.reference",
        authored_on="authoredOn",
        dosage_text="dosageInstruction.text",
    )


def claim(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per item, diagnosis, supporting information and insurance."""
    total, kind = F.from_json("total", schemas.MONEY), F.from_json("type", schemas.CONCEPT)
    rows = resources(entries, "Claim")
    rows = rows.withColumns({"total": total["value"], "currency": total["currency"], "type": _coding(kind, "code")})
    rows = _per_element(rows, outer, "supportingInfo", "insurance", "diagnosis", "item")
    return _table(
        rows,
        claim_id="id",
        status="status",
        type_code="type",
        use="use",
        patient_reference="patient.reference",
        patient_display="patient.display",
        created_date="created",
        billable_period_start="billablePeriod.start",
        billable_period_end="billablePeriod.end",
        provider_reference="provider.reference",
        priority=_coding("priority", "code"),
        supporting_info_code=_coding("supportingInfo.category", "code"),
        supporting_info_value_reference="supportingInfo.valueReference.reference",
        insurance_coverage_display="insurance.coverage.display",
        insurance_focal="insurance.focal",
        total_amount="total",
        currency="currency",
        diagnosis_reference="diagnosis.diagnosisReference.reference",
        item_code=_coding("item.productOrService", "code"),
        item_description=_coding("item.productOrService", "display"),
        item_category=_coding("item.category", "display"),
        item_net_value="item.net.value",
        item_net_currency="item.net.currency",
        encounter_reference=_nth("item.encounter")["reference"],
        location_description=_coding("item.locationCodeableConcept", "display"),
        service_period_start="item.servicedPeriod.start",
        service_period_end="item.servicedPeriod.end",
        adjudication="item.adjudication",
    )


def explanation_of_benefit(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per item, insurance, care-team member and contained resource.

    `total` is a list of amounts by category; the first, the submitted amount, is the total.
    """
    total, kind = _nth(F.from_json("total", schemas.BENEFIT_TOTALS))["amount"], F.from_json("type", schemas.CONCEPT)
    rows = resources(entries, "ExplanationOfBenefit")
    rows = _per_element(
        rows.withColumns({"total": total["value"], "currency": total["currency"], "type": _coding(kind, "code")}),
        outer,
        "contained",
        "careTeam",
        "insurance",
        "item",
    )
    return _table(
        rows,
        eob_id="id",
        identifier_claim_id=_nth("identifier", 0)["value"],
        identifier_claim_group=_nth("identifier", 1)["value"],
        status="status",
        code="type",
        use="use",
        patient_reference="patient.reference",
        billable_period_start="billablePeriod.start",
        billable_period_end="billablePeriod.end",
        insurer_display="insurer.display",
        provider_reference="provider.reference",
        referral_reference="referral.reference",
        claim_reference="claim.reference",
        outcome="outcome",
        care_team_provider_reference="careTeam.provider.reference",
        care_team_role=_coding("careTeam.role", "display"),
        insurance_coverage_reference="insurance.coverage.reference",
        insurance_coverage_display="insurance.coverage.display",
        insurance_focal="insurance.focal",
        item_category_display=_coding("item.category", "display"),
        item_service_code=_coding("item.productOrService", "code"),
        item_service_description=_coding("item.productOrService", "display"),
        item_net_value="item.net.value",
        item_net_currency="item.net.currency",
        location_description=_coding("item.locationCodeableConcept", "display"),
        service_period_start="item.servicedPeriod.start",
        service_period_end="item.servicedPeriod.end",
        adjudication="item.adjudication",
        total_amount="total",
        total_currency="currency",
        payment_amount="payment.amount.value",
        payment_currency="payment.amount.currency",
        created_date="created",
    )


def careplan(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per activity and care team."""
    rows = _per_element(resources(entries, "CarePlan"), outer, "careTeam", "activity")
    return _table(
        rows,
        careplan_id="id",
        status="status",
        intent="intent",
        patient_reference="subject.reference",
        encounter_reference="encounter.reference",
        period_start="period.start",
        period_end="period.end",
        created_date="created",
        care_team_reference="careTeam.reference",
        activity_display=_coding("activity.detail.code", "display"),
        activity_code=_coding("activity.detail.code", "code"),
        activity_status="activity.detail.status",
        activity_location="activity.detail.location.display",
        addresses="addresses.reference",
        category_text=F.from_json(_nth("category"), schemas.CONCEPT)["text"],
    )


def careteam(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per participant and managing organisation."""
    rows = _per_element(
        resources(entries, "CareTeam"), outer, "participant", "managingOrganization"
    )
    return _table(
        rows,
        care_team_id="id",
        status="status",
        subject_reference="subject.reference",
        encounter_reference="encounter.reference",
        period_start="period.start",
        period_end="period.end",
        managing_organization="managingOrganization.display",
        participant_role=_nth("participant.role")["text"],
        participant_reference="participant.member.reference",
        participant_display="participant.member.display",
    )


def procedure(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per reason."""
    return _table(
        _per_element(resources(entries, "Procedure"), outer, "reasonReference"),
        procedure_id="id",
        status="status",
        procedure_code_display=_coding("code", "display"),
        procedure_code=_coding("code", "code"),
        subject_reference="subject.reference",
        performed_period_start="performedPeriod.start",
        performed_period_end="performedPeriod.end",
        encounter_reference="encounter.reference",
        reason_reference="reasonReference.reference",
        reason_reference_display="reasonReference.display",
    )


def diagnostic_report(entries: DataFrame, outer: bool = False) -> DataFrame:
    """One row per result."""
    return _table(
        _per_element(resources(entries, "DiagnosticReport"), outer, "result"),
        diagnostic_report_id="id",
        status="status",
        code=_coding("code", "display"),
        code_system=_coding("code", "code"),
        subject_reference="subject.reference",
        encounter_reference="encounter.reference",
        effective_date_time="effectiveDateTime",
        issued_date="issued",
        result_display="result.display",
        category_display=_coding(F.from_json(_nth("category"), schemas.CONCEPT), "display"),
    )


def immunization(entries: DataFrame) -> DataFrame:
    return _table(
        resources(entries, "Immunization"),
        immunization_id="id",
        status="status",
        vaccine_display=_coding("vaccineCode", "display"),
        vaccine_code=_coding("vaccineCode", "code"),
        patient_reference="patient.reference",
        encounter_reference="encounter.reference",
        primary_source="primarySource",
        occurrence_date_time="occurrenceDateTime",
    )


def observation(entries: DataFrame) -> DataFrame:
    return _table(
        resources(entries, "Observation"),
        observation_id="id",
        status="status",
        observation_code_display=_coding("code", "display"),
        observation_code=_coding("code", "code"),
        subject_reference="subject.reference",
        encounter_reference="encounter.reference",
        effective_date_time="effectiveDateTime",
        issued_date="issued",
        value_quantity_value="valueQuantity.value",
        value_quantity_unit="valueQuantity.unit",
        category_display=_coding(F.from_json(_nth("category"), schemas.CONCEPT), "display"),
    )


TABLES: dict[str, Callable[..., DataFrame]] = {
    "patient": patient,
    "encounter": encounter,
    "condition": condition,
    "medication_request": medication_request,
    "claim": claim,
    "explanation_of_benefit": explanation_of_benefit,
    "careplan": careplan,
    "careteam": careteam,
    "procedure": procedure,
    "diagnostic_report": diagnostic_report,
    "immunization": immunization,
    "observation": observation,
}
