"""Parsing of raw registry documents.

A payload is parsed once, to a Variant: that tells whether it can be read, and the
fields are taken from it. Arrays are trimmed, blanked and de-duplicated inside
their row: the document key is unique in the raw table, so a row-local distinct
gives the same pairs as a distinct over all rows, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions import blank_to_null, compact_date, joined_or_null, partial_date, trimmed_or_null
from cohortline.schemas import APPLICATION_PAYLOAD


def _distinct_present(items: Column, present) -> Column:
    return F.array_distinct(F.filter(items, present))


def _whole() -> Column:
    """The payload as a Variant, if it is a whole JSON object; null otherwise."""
    return F.when(F.ltrim("payload").startswith("{"), F.try_parse_json("payload"))


def readable(raw: DataFrame) -> DataFrame:
    """The raw rows that can be read, with their document as the Variant ``_document``.

    It comes out of an exploded array of one or none: as a column with a filter on it, the
    optimizer would parse once for the filter and once for the fields.
    """
    whole = F.filter(F.array(_whole()), lambda document: document.isNotNull())
    return raw.select("*", F.explode(whole).alias("_document"))


def parsed(raw: DataFrame, schema: str) -> DataFrame:
    """The raw rows that can be read, with their document as ``doc``.

    A field of another type than the schema's is null, the others are kept.
    """
    document = F.try_variant_get("_document", "$", f"struct<{schema}>")
    return readable(raw).select(*raw.columns, document.alias("doc"))


def unreadable(raw: DataFrame) -> DataFrame:
    """Raw rows whose payload cannot be read; no model sees them, the audit log counts them."""
    return raw.where(_whole().isNull())


def nested_schema(paths: list[str], types: dict[str, str]) -> str:
    """Schema of a JSON object with these dotted paths only."""
    tree: dict = {}
    for path in paths:
        *parents, leaf = path.split(".")
        node = tree
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = types.get(path, "string")

    def ddl(node: dict, mark: str = ":") -> str:
        return ", ".join(f"{k}{mark} {v if isinstance(v, str) else f'struct<{ddl(v)}>'}" for k, v in node.items())

    return ddl(tree, "")


_SECTION = "protocolSection."
_TYPES = {
    _SECTION + "designModule.phases": "array<string>",
    _SECTION + "outcomesModule.primaryOutcomes": "array<string>",
    _SECTION + "contactsLocationsModule.locations": "array<string>",
    _SECTION + "conditionsModule.conditions": "array<string>",
    _SECTION + "armsInterventionsModule.interventions": "array<struct<name: string, type: string>>",
}


def _conditions(items: Column) -> Column:
    return _distinct_present(F.transform(items, trimmed_or_null), lambda name: name.isNotNull())


def _interventions(items: Column) -> Column:
    trimmed = F.transform(
        items,
        lambda item: F.struct(
            trimmed_or_null(item["name"]).alias("name"),
            trimmed_or_null(item["type"]).alias("type"),
        ),
    )
    return _distinct_present(trimmed, lambda item: item["name"].isNotNull())


# Column of a parsed study: where it is in the document, and how it is read.
STUDY_COLUMNS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "brief_title": (_SECTION + "identificationModule.briefTitle", lambda text: text),
    "overall_status": (_SECTION + "statusModule.overallStatus", lambda text: text),
    "phase": (_SECTION + "designModule.phases", joined_or_null),
    "enrollment_count": (_SECTION + "designModule.enrollmentInfo.count", lambda text: text.cast("int")),
    "start_date": (_SECTION + "statusModule.startDateStruct.date", partial_date),
    "completion_date": (_SECTION + "statusModule.completionDateStruct.date", partial_date),
    "sponsor_name": (_SECTION + "sponsorCollaboratorsModule.leadSponsor.name", blank_to_null),
    "sponsor_class": (_SECTION + "sponsorCollaboratorsModule.leadSponsor.class", blank_to_null),
    "why_stopped": (_SECTION + "statusModule.whyStopped", blank_to_null),
    "has_results": ("hasResults", lambda text: text.cast("boolean")),
    "num_primary_outcomes": (_SECTION + "outcomesModule.primaryOutcomes", F.array_size),
    "num_sites": (_SECTION + "contactsLocationsModule.locations", F.array_size),
    "conditions": (_SECTION + "conditionsModule.conditions", _conditions),
    "interventions": (_SECTION + "armsInterventionsModule.interventions", _interventions),
}


def study_columns(raw_studies: DataFrame, *names: str) -> DataFrame:
    """Some columns of the studies; the parser is given the paths of these columns only."""
    schema = nested_schema([STUDY_COLUMNS[name][0] for name in names], _TYPES)
    documents = parsed(raw_studies, schema)
    read = (STUDY_COLUMNS[name][1](F.col(f"doc.{STUDY_COLUMNS[name][0]}")).alias(name) for name in names)
    return documents.select("nct_id", F.col("fetched_at").alias("source_fetched_at"), *read)


def parse_studies(raw_studies: DataFrame) -> DataFrame:
    """One typed row per readable study document, conditions and interventions still nested.

    Every field is taken from the Variant by its path: the same values as out of one struct
    of all, which would be built and copied for every document first.
    """
    fields = (
        F.try_variant_get("_document", f"$.{path}", _TYPES.get(path, "string")).alias(name)
        for name, (path, _) in STUDY_COLUMNS.items()
    )
    taken = readable(raw_studies).select("nct_id", F.col("fetched_at").alias("source_fetched_at"), *fields)
    read = {name: convert(F.col(name)).alias(name) for name, (_, convert) in STUDY_COLUMNS.items()}
    conditions, interventions = read.pop("conditions"), read.pop("interventions")
    return taken.select("nct_id", *read.values(), "source_fetched_at", conditions, interventions)


def parse_applications(raw_applications: DataFrame) -> DataFrame:
    """One typed row per readable application document, submissions still nested."""
    doc = parsed(raw_applications, APPLICATION_PAYLOAD)
    submissions = F.transform(
        F.col("doc.submissions"),
        lambda s: F.struct(
            s["submission_type"].alias("submission_type"),
            s["submission_number"].alias("submission_number"),
            blank_to_null(s["submission_status"]).alias("submission_status"),
            compact_date(s["submission_status_date"]).alias("submission_status_date"),
            blank_to_null(s["review_priority"]).alias("review_priority"),
        ),
    )
    return doc.select(
        "application_number",
        blank_to_null(F.col("doc.sponsor_name")).alias("sponsor_name"),
        submissions.alias("submissions"),
        F.col("fetched_at").alias("source_fetched_at"),
    )
