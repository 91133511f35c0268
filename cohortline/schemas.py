"""Payload schemas of the two registries.

Scalars that need a cast are read as text and cast afterwards, so that a number
in quotes is accepted and a bad value raises instead of turning into NULL.
Arrays used only for their length keep their elements as text.
"""

from __future__ import annotations

STUDY_PAYLOAD = """
  protocolSection struct<
    identificationModule: struct<nctId: string, briefTitle: string>,
    statusModule: struct<
      overallStatus: string,
      startDateStruct: struct<date: string>,
      completionDateStruct: struct<date: string>,
      whyStopped: string>,
    designModule: struct<phases: array<string>, enrollmentInfo: struct<count: string>>,
    sponsorCollaboratorsModule: struct<leadSponsor: struct<name: string, class: string>>,
    outcomesModule: struct<primaryOutcomes: array<string>>,
    contactsLocationsModule: struct<locations: array<string>>,
    conditionsModule: struct<conditions: array<string>>,
    armsInterventionsModule: struct<interventions: array<struct<name: string, type: string>>>
  >,
  hasResults string
"""

APPLICATION_PAYLOAD = """
  application_number string,
  sponsor_name string,
  submissions array<struct<
    submission_type: string,
    submission_number: string,
    submission_status: string,
    submission_status_date: string,
    review_priority: string>>
"""

RAW_STUDIES = "nct_id string, payload string, fetched_at timestamp"
RAW_APPLICATIONS = "application_number string, payload string, fetched_at timestamp"
