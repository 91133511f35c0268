"""Hand-made registry documents, and rows in a fixed order."""

from __future__ import annotations

import json


def study(nct_id: str, **fields) -> tuple:
    """A raw study row. A field left out, or given as None, is absent from the document."""

    def put(name, wrap):
        return wrap(fields[name]) if fields.get(name) is not None else {}

    section = {
        "identificationModule": {"nctId": nct_id, **put("title", lambda v: {"briefTitle": v})},
        "statusModule": {
            **put("status", lambda v: {"overallStatus": v}),
            **put("start", lambda v: {"startDateStruct": {"date": v}}),
            **put("end", lambda v: {"completionDateStruct": {"date": v}}),
            **put("why", lambda v: {"whyStopped": v}),
        },
        "designModule": {
            **put("phases", lambda v: {"phases": v}),
            **put("enrollment", lambda v: {"enrollmentInfo": {"count": v}}),
        },
        "sponsorCollaboratorsModule": {
            "leadSponsor": {
                **put("sponsor", lambda v: {"name": v}),
                **put("sponsor_class", lambda v: {"class": v}),
            }
        },
        **put("outcomes", lambda v: {"outcomesModule": {"primaryOutcomes": v}}),
        **put("locations", lambda v: {"contactsLocationsModule": {"locations": v}}),
        **put("conditions", lambda v: {"conditionsModule": {"conditions": v}}),
        **put("interventions", lambda v: {"armsInterventionsModule": {"interventions": v}}),
    }
    return nct_id, json.dumps({"protocolSection": section, **put("results", lambda v: {"hasResults": v})})


def submission(kind="ORIG", number="1", status="AP", date="20200131", priority="STANDARD") -> dict:
    values = {
        "submission_type": kind,
        "submission_number": number,
        "submission_status": status,
        "submission_status_date": date,
        "review_priority": priority,
    }
    return {name: value for name, value in values.items() if value is not None}


def application(number: str, sponsor: str | None = None, submissions: list | None = None) -> tuple:
    document = {"application_number": number, "sponsor_name": sponsor, "submissions": submissions}
    return number, json.dumps({name: value for name, value in document.items() if value is not None})


def rows(frame, *order) -> list[tuple]:
    """Collected rows as tuples, sorted with NULL last."""
    collected = [tuple(row) for row in (frame.select(*order) if order else frame).collect()]
    return sorted(collected, key=lambda row: [(value is None, str(type(value)), value) for value in row])
