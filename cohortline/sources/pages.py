"""Response pages landed as JSON texts, and the records inside them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.schemas import APPLICATION_PAYLOAD, STUDY_PAYLOAD


@dataclass(frozen=True)
class Source:
    """What one registry calls its record list, its records and their key."""

    name: str
    list_field: str
    record_schema: str
    key_path: str
    key_name: str


STUDIES = Source(
    "studies", "studies", STUDY_PAYLOAD, "protocolSection.identificationModule.nctId", "nct_id"
)
APPLICATIONS = Source(
    "applications", "results", APPLICATION_PAYLOAD, "application_number", "application_number"
)


# Why a page or a record is set aside.
UNREADABLE_PAGE = "page is no JSON object, or its list field holds no list"
NO_KEY = "record has no key"


def read_page(body: Column, list_field: str) -> Column:
    """The page's record list as JSON texts, and whether the page could be read.

    A page without the list, or with a null in its place, is an empty page. One that is
    cut off, is no object, or holds anything else there, is unreadable.
    """
    page = F.from_json(body, f"{list_field} array<string>, _unread string", {"columnNameOfCorruptRecord": "_unread"})
    readable = F.coalesce(F.ltrim(body).startswith("{"), F.lit(False)) & page["_unread"].isNull()
    records = F.coalesce(page[list_field], F.array().cast("array<string>"))
    return F.struct(F.when(readable, records).alias("records"), readable.alias("readable"))


def unpack_pages(pages: DataFrame, list_field: str, body: str = "body") -> DataFrame:
    """One row per record of the readable pages: the page's other columns, position, record text."""
    kept = [c for c in pages.columns if c != body]
    records = read_page(F.col(body), list_field)["records"]
    return pages.select(*kept, F.posexplode(records).alias("pos", "payload"))


def keyed_records(pages: DataFrame, list_field: str, key_path: str, body: str = "body") -> DataFrame:
    """Every record with its key, and every page or record that has to be set aside.

    ``reason`` is null for a good record. An unreadable page is one row: no position, and
    its body as payload. No element of a page is lost.
    """
    kept = [c for c in pages.columns if c != body]
    read = pages.select(*kept, body, read_page(F.col(body), list_field).alias("page_read"))
    unread = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.col(body).alias("payload")))
    listed = F.transform("page_read.records", lambda text, n: F.struct(n.alias("pos"), text.alias("payload")))
    rows = read.select(
        *kept,
        F.col("page_read.readable").alias("readable"),
        F.explode(F.when(F.col("page_read.readable"), listed).otherwise(unread)).alias("row"),
    ).select(*kept, "readable", "row.pos", "row.payload")
    key = F.when(F.col("readable"), record_key(F.col("payload"), key_path))
    reason = F.when(~F.col("readable"), UNREADABLE_PAGE).when(F.col("record_id").isNull(), NO_KEY)
    return rows.withColumn("record_id", key).withColumn("reason", reason).drop("readable")


def record_key(payload: Column, key_path: str) -> Column:
    """Natural key of a record: a field, nested or at top level."""
    return F.get_json_object(payload, f"$.{key_path}")


def after_key(records: DataFrame, key: str, cursor, page_size: int | None = None) -> DataFrame:
    """Records with a key strictly above the cursor, ascending, a page of them or all."""
    rest = records if cursor is None else records.where(F.col(key) > F.lit(cursor))
    rest = rest.orderBy(key)
    return rest if page_size is None else rest.limit(page_size)
