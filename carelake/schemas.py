"""Schema of a bundle document.

The schema is declared, not inferred: no extra pass over the lake, and a small sample gives the same
columns as everything. `type`, `total` and the elements of `category` have another shape in each
resource type, so they are read as JSON text and parsed by the resource that needs them.
"""

from __future__ import annotations

CODING = "array<struct<system:string,code:string,display:string>>"
CONCEPT = f"struct<coding:{CODING},text:string>"
REFERENCE = "struct<reference:string,display:string>"
PERIOD = "struct<start:string,end:string>"
MONEY = "struct<value:double,currency:string>"
ADJUDICATION = f"array<struct<amount:{MONEY},category:{CONCEPT}>>"
ADDRESS_EXTENSION = "array<struct<url:string,extension:array<struct<url:string,valueDecimal:double>>>>"

# Parsed from the clashing text fields.
CONCEPTS = f"array<{CONCEPT}>"
BENEFIT_TOTALS = f"array<struct<category:{CONCEPT},amount:{MONEY}>>"

# The field names of the resource documents.
RESOURCE_FIELDS = {
    "resourceType": "string",
    "id": "string",
    "status": "string",
    "intent": "string",
    "use": "string",
    "type": "string",
    "total": "string",
    "category": "array<string>",
    "name": "array<struct<use:string,family:string,given:array<string>,prefix:array<string>>>",
    "gender": "string",
    "birthDate": "string",
    "address": (
        "array<struct<city:string,state:string,country:string,postalCode:string,"
        f"extension:{ADDRESS_EXTENSION}>>"
    ),
    "telecom": "array<struct<value:string>>",
    "maritalStatus": "struct<text:string>",
    "extension": (
        "array<struct<url:string,valueString:string,valueDecimal:double,"
        "valueAddress:struct<city:string,state:string,country:string>>>"
    ),
    "multipleBirthBoolean": "boolean",
    "communication": "array<struct<language:struct<text:string>>>",
    "identifier": f"array<struct<system:string,value:string,type:{CONCEPT}>>",
    "subject": REFERENCE,
    "patient": REFERENCE,
    "encounter": REFERENCE,
    "period": PERIOD,
    "billablePeriod": PERIOD,
    "performedPeriod": PERIOD,
    "code": CONCEPT,
    "class": "struct<system:string,code:string>",
    "serviceProvider": REFERENCE,
    "participant": (
        f"array<struct<individual:{REFERENCE},member:{REFERENCE},period:{PERIOD},"
        f"type:array<{CONCEPT}>,role:array<{CONCEPT}>>>"
    ),
    "clinicalStatus": CONCEPT,
    "verificationStatus": CONCEPT,
    "onsetDateTime": "string",
    "abatementDateTime": "string",
    "recordedDate": "string",
    "medicationCodeableConcept": CONCEPT,
    "requester": REFERENCE,
    "authoredOn": "string",
    "dosageInstruction": "array<struct<text:string>>",
    "created": "string",
    "provider": REFERENCE,
    "priority": CONCEPT,
    "outcome": "string",
    "supportingInfo": f"array<struct<category:{CONCEPT},valueReference:{REFERENCE}>>",
    "insurance": f"array<struct<focal:boolean,coverage:{REFERENCE}>>",
    "diagnosis": f"array<struct<diagnosisReference:{REFERENCE}>>",
    "item": (
        f"array<struct<productOrService:{CONCEPT},category:{CONCEPT},"
        f"locationCodeableConcept:{CONCEPT},net:{MONEY},encounter:array<{REFERENCE}>,"
        f"servicedPeriod:{PERIOD},adjudication:{ADJUDICATION}>>"
    ),
    "contained": "array<struct<id:string>>",
    "insurer": REFERENCE,
    "referral": REFERENCE,
    "claim": REFERENCE,
    "payment": f"struct<amount:{MONEY}>",
    "careTeam": f"array<struct<reference:string,provider:{REFERENCE},role:{CONCEPT}>>",
    "activity": (
        f"array<struct<detail:struct<code:{CONCEPT},status:string,location:{REFERENCE}>>>"
    ),
    "addresses": f"array<{REFERENCE}>",
    "managingOrganization": f"array<{REFERENCE}>",
    "reasonReference": f"array<{REFERENCE}>",
    "result": f"array<{REFERENCE}>",
    "effectiveDateTime": "string",
    "issued": "string",
    "vaccineCode": CONCEPT,
    "primarySource": "boolean",
    "occurrenceDateTime": "string",
    "valueQuantity": "struct<value:double,unit:string>",
    # Not flattened; kept as JSON text for the profile.
    "text": "string",
    "component": "string",
    "prescription": "string",
    "procedure": "string",
    "reasonCode": "string",
    "valueCodeableConcept": "string",
}

RESOURCE = "struct<" + ",".join(f"`{n}`:{t}" for n, t in RESOURCE_FIELDS.items()) + ">"
BUNDLE = f"entry array<struct<resource:{RESOURCE}>>"
