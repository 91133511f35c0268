"""Registry documents built from the benchmark's star-schema tables.

Orders become study documents and supplier-part pairs become application
documents, so that every model can be run and checked at any scale. Documents
are serialized to JSON and parsed back like real ones.

Every line item is an outcome of its study and a submission of its application. A key of
up to ``LINES`` line items is one document. A larger one is dealt over several by a hash
of its line items, each of about ``LINES``, so one key holding a third of all line items
makes many documents and no large one; a site is listed in one of its study's documents.
Only line items that agree in all hashed columns must fall together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators import lookup

LINES = 1000
LINES_A_TASK = 100_000
PAGE_SIZE = 1000

# How the benchmark codes map onto registry codes.
STATUS = {"F": "COMPLETED", "O": "RECRUITING", "P": "TERMINATED"}
CLASS_OF_SEGMENT = {
    "AUTOMOBILE": "INDUSTRY",
    "BUILDING": "NIH",
    "FURNITURE": "FED",
    "HOUSEHOLD": "NETWORK",
    "MACHINERY": "OTHER",
}
INTERVENTION_TYPES = ["DRUG", "DEVICE", "BIOLOGICAL"]
STOP_REASONS = ["Low enrollment", "Sponsor decision", "Safety concerns"]
REVIEW_TRACK = {"A": "STANDARD", "R": "PRIORITY"}
SUBMISSION_STATUS = {"F": "AP", "O": "TA"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coded(column: Column, codes: dict[str, str]) -> Column:
    expression = None
    for code, value in codes.items():
        match = column == code
        expression = F.when(match, value) if expression is None else expression.when(match, value)
    return expression


def _every(key: Column, n: int, rest: int = 0) -> Column:
    return F.pmod(key, F.lit(n)) == rest


def study_key(key: Column) -> Column:
    """``NCT`` and at least eight digits; longer keys keep all their digits."""
    digits = key.cast("string")
    return F.concat(F.lit("NCT"), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def _documents_of_keys(lineitem: DataFrame, *keys: str) -> DataFrame:
    """Keys dealt over several documents, and over how many.

    Keys above LINES are one in LINES line items at most, and usually none, so they are
    broadcast: line items are not shuffled to learn that theirs is one document. Of several
    columns, the first is counted by itself: only line items whose value of it is above LINES
    can have such a key, and are counted by all columns.
    """
    if len(keys) > 1:
        first = lineitem.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("_lines"))
        frequent = first.where(F.col("_lines") > LINES).select(keys[0])
        lineitem = lineitem.join(F.broadcast(frequent), keys[0], "left_semi")
    counts = lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lines"))
    large = counts.where(F.col("_lines") > LINES).select(*keys, F.ceil(F.col("_lines") / LINES).alias("_documents"))
    return F.broadcast(large)


def _as_found(lineitem: DataFrame, on: str, table: DataFrame, key: str) -> DataFrame:
    """As many rows of each line item as it gets when looked up in the table.

    Where no key of the table repeats, and none should, these are the line items themselves:
    they are not joined, nor shuffled for it, to be counted.
    """
    keys = table.select(F.col(key).alias(on)).where(F.col(on).isNotNull())
    if keys.groupBy(on).count().where("count > 1").isEmpty():
        return lineitem
    return lookup(lineitem, keys, on)


def _with_documents(rows: DataFrame, documents: DataFrame, *keys: str) -> DataFrame:
    """Rows with the number of documents their key is dealt over."""
    joined = rows.join(documents, list(keys), "left")
    return joined.withColumn("_documents", F.coalesce("_documents", F.lit(1)))


def _tasks(lineitem: DataFrame) -> int:
    """Partitions of about LINES_A_TASK line items, counted from the files' footers.

    Documents are gathered by sorting, and a task that holds much more than this spills what
    it sorts. The session's number of partitions need not grow with the input, this one does.
    """
    return max(1, -(-lineitem.count() // LINES_A_TASK))


def _document(documents: str, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.col(documents))


def _numbered(key: Column, document: Column) -> Column:
    """The key of a document: the key itself for its first, with a suffix for the others."""
    return F.when(document == 0, key).otherwise(F.concat(key, F.lit("-"), document.cast("string")))


def _study_lines(lineitem: DataFrame, part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per study document: last ship date of the order and what fills the nested arrays.

    Also the orders of more than one document, see ``_documents_of_keys``.
    """
    tasks = _tasks(lineitem)
    documents = _documents_of_keys(_as_found(lineitem, "l_partkey", part, "p_partkey"), "l_orderkey")
    numbered = _with_documents(lineitem, documents, "l_orderkey").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("ship"),
        F.col("l_suppkey").alias("site"),
        _document("_documents", "l_suppkey", "l_partkey", "l_linenumber", "l_shipdate").alias("document"),
        _document("_documents", "l_suppkey").alias("home"),
    )
    # A line item takes along two names and a size of its part; a part that is found has a condition.
    parts = part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(" ", "p_brand", "p_type").alias("part_condition"),
        F.when(F.col("p_size") == 50, " ").otherwise(F.col("p_name")).alias("part_name"),
        "p_size",
    )
    told = ("l_linenumber", "part_condition", "part_name", "p_size")
    lines = lookup(numbered, parts, "l_partkey")
    # Where a line item and its site belong to different documents, each gets its part.
    own = F.struct(F.col("document"), F.when(F.col("home") == F.col("document"), F.col("site")).alias("site"), F.lit(True).alias("line"))
    away = F.struct(F.col("home").alias("document"), F.col("site"), F.lit(False).alias("line"))
    dealt = lines.withColumn(
        "to", F.explode(F.when(F.col("home") == F.col("document"), F.array(own)).otherwise(F.array(own, away)))
    )

    # The one shuffle of the line items; an order of very many lines is dealt by its documents.
    # Shuffled before their texts are built: a task that deals rows holds all of them.
    dealt = dealt.select("l_orderkey", "ship", *told, "to.*").repartition(tasks, "l_orderkey", "document")
    outcome = F.struct(F.concat(F.lit("Outcome "), F.col("l_linenumber").cast("string")).alias("measure"))
    name = F.col("part_condition")
    condition = (
        F.when(name.isNull(), None)
        .when(F.col("l_linenumber") == 5, "")
        .when(F.col("l_linenumber") == 7, F.concat(F.lit(" "), name, F.lit(" ")))
        .otherwise(name)
    )
    kind = F.when(F.col("p_size") == 49, "")
    for remainder, value in enumerate(INTERVENTION_TYPES):
        kind = kind.when(_every(F.col("p_size"), 4, remainder), value)
    intervention = F.when(name.isNotNull(), F.struct(F.col("part_name").alias("name"), kind.alias("type")))
    written = dealt.select(
        "l_orderkey",
        "ship",
        "document",
        "site",
        "line",
        outcome.alias("outcome"),
        condition.alias("condition"),
        intervention.alias("intervention"),
    )

    def of_line(name: str) -> Column:
        return F.when(F.col("line"), F.col(name))

    facility = F.when(
        F.col("site").isNotNull(),
        F.struct(F.concat(F.lit("Site "), F.col("site").cast("string")).alias("facility")),
    )
    gathered = written.groupBy("l_orderkey", "document").agg(
        F.max("ship").alias("last_ship"),
        F.sort_array(F.collect_list(of_line("outcome"))).alias("outcomes"),
        F.sort_array(F.collect_set(facility)).alias("sites"),
        F.sort_array(F.collect_set(of_line("condition"))).alias("conditions"),
        F.sort_array(F.collect_set(of_line("intervention"))).alias("interventions"),
    )
    return gathered, documents


def raw_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nct_id, payload, fetched_at), one row per order, or several for an order of many lines."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    lines, documents = _study_lines(
        read_table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
        ),
        read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"),
    )
    named = lookup(orders, customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    # An order meets the line items by key and document, as they lie; of several documents only those that have some.
    numbered = _with_documents(named, documents.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").withColumn(
        "_number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_documents") - 1))
    )
    meet = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("_number") == F.col("document"))
    frame = numbered.join(lines, meet, "left").where((F.col("_documents") == 1) | F.col("document").isNotNull())

    key = F.col("o_orderkey")
    nct_id = _numbered(study_key(key), F.col("_number"))
    # Sponsors start between 1990 and 2010; a fifth of a sponsor's studies come ten years later.
    later = F.when(_every(key, 5), 120).otherwise(0)
    months = (F.pmod(F.col("o_custkey"), F.lit(5)) * 60 - 60 + later).cast("int")
    start = F.add_months(F.col("o_orderdate").cast("date"), months)
    end = F.add_months("last_ship", months)
    digit = F.substring("o_orderpriority", 1, 1)
    reason = F.element_at(
        F.array(*(F.lit(r) for r in STOP_REASONS)), (F.pmod(F.col("o_custkey"), F.lit(3)) + 1).cast("int")
    )
    phases = (
        F.when(_every(key, 17), F.array(F.lit("PHASE4")))
        .when(_every(key, 19), F.array(F.lit("NA")))
        .when(digit == "1", F.array(F.lit("PHASE1")))
        .when(digit == "2", F.array(F.lit("PHASE2")))
        .when(digit == "3", F.array(F.lit("PHASE2"), F.lit("PHASE3")))
        .when(digit == "5", F.array(F.lit("PHASE3")))
        .when(_every(key, 2), F.array().cast("array<string>"))
    )
    section = F.struct(
        F.struct(
            nct_id.alias("nctId"),
            F.when(_every(key, 41), "")
            .otherwise(F.concat(F.lit("Study "), key.cast("string"), F.lit(" "), F.col("o_orderpriority")))
            .alias("briefTitle"),
        ).alias("identificationModule"),
        F.struct(
            _coded(F.col("o_orderstatus"), STATUS).alias("overallStatus"),
            F.struct(
                F.when(_every(key, 97), None)
                .when(_every(key, 89), F.date_format(start, "yyyy"))
                .when(_every(key, 3), F.date_format(start, "yyyy-MM"))
                .otherwise(F.date_format(start, "yyyy-MM-dd"))
                .alias("date")
            ).alias("startDateStruct"),
            F.struct(
                F.when(_every(key, 4), F.date_format(end, "yyyy-MM"))
                .otherwise(F.date_format(end, "yyyy-MM-dd"))
                .alias("date")
            ).alias("completionDateStruct"),
            F.when(
                (F.col("o_orderstatus") == "P") & ~_every(key, 5),
                F.concat(reason, F.lit(" - "), F.expr("substring(o_orderpriority, 3)")),
            )
            .when((F.col("o_orderstatus") == "O") & _every(key, 31), "Paused by sponsor")
            .when((F.col("o_orderstatus") == "F") & _every(key, 10), "")
            .alias("whyStopped"),
        ).alias("statusModule"),
        F.struct(
            phases.alias("phases"),
            F.struct(
                F.when(~_every(key, 83), F.floor(F.col("o_totalprice") / 1000).cast("int")).alias("count")
            ).alias("enrollmentInfo"),
        ).alias("designModule"),
        F.struct(
            F.struct(
                F.when(_every(key, 600), None)
                .when(_every(key, 599), "")
                .otherwise(F.col("c_name"))
                .alias("name"),
                F.when(_every(key, 7), None)
                .when(_every(key, 11), "OTHER_GOV")
                .when(_every(key, 13), "")
                .otherwise(_coded(F.col("c_mktsegment"), CLASS_OF_SEGMENT))
                .alias("class"),
            ).alias("leadSponsor")
        ).alias("sponsorCollaboratorsModule"),
        F.struct(F.col("outcomes").alias("primaryOutcomes")).alias("outcomesModule"),
        F.struct(
            F.when(
                ~_every(key, 10), F.coalesce("sites", F.array().cast("array<struct<facility:string>>"))
            ).alias("locations")
        ).alias("contactsLocationsModule"),
        F.struct(F.col("conditions")).alias("conditionsModule"),
        F.struct(F.col("interventions")).alias("armsInterventionsModule"),
    )
    payload = F.to_json(
        F.struct(section.alias("protocolSection"), (F.col("o_totalprice") > 200000).alias("hasResults"))
    )
    return frame.select(
        nct_id.alias("nct_id"),
        payload.alias("payload"),
        F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
    )


def _application_documents(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    documents = _documents_of_keys(_as_found(lineitem, "l_suppkey", supplier, "s_suppkey"), "l_partkey", "l_suppkey")
    dealt = _with_documents(lineitem, documents, "l_suppkey", "l_partkey").select(
        "l_suppkey",
        "l_partkey",
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("ship"),
        "l_linestatus",
        "l_returnflag",
        _document("_documents", "l_orderkey", "l_linenumber", "l_shipdate").alias("document"),
    )
    # Shuffled before their texts are built.
    events = dealt.repartition(_tasks(lineitem), "l_suppkey", "l_partkey", "document").select(
        "l_suppkey",
        "l_partkey",
        "ship",
        F.when(F.col("l_linenumber") == 1, "ORIG").otherwise("SUPPL").alias("kind"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("number"),
        "l_linestatus",
        "l_returnflag",
        "document",
    )
    day = F.dayofmonth("ship")
    submission = F.struct(
        F.col("kind").alias("submission_type"),
        F.col("number").alias("submission_number"),
        F.when(day == 13, None)
        .when(day == 14, "")
        .otherwise(_coded(F.col("l_linestatus"), SUBMISSION_STATUS))
        .alias("submission_status"),
        F.when(day == 29, None)
        .when(day == 28, F.date_format("ship", "yyyy-MM-dd"))
        .otherwise(F.date_format("ship", "yyyyMMdd"))
        .alias("submission_status_date"),
        F.when((F.col("l_returnflag") == "R") & (day == 7), "")
        .otherwise(_coded(F.col("l_returnflag"), REVIEW_TRACK))
        .alias("review_priority"),
    )
    gathered = events.groupBy("l_suppkey", "l_partkey", "document").agg(
        F.sort_array(F.collect_list(submission)).alias("submissions"), F.max("ship").alias("last_ship")
    )
    # Names are looked up for documents, not shuffled with line items. A supplier listed twice
    # under one name has each submission twice, under two names two documents.
    names = supplier.groupBy(F.col("s_suppkey").alias("l_suppkey"), "s_name").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    repeated = F.flatten(F.transform("submissions", lambda s: F.array_repeat(s, F.col("_times"))))
    pairs = lookup(gathered, names, "l_suppkey").withColumn(
        "submissions", F.when(F.col("_times") > 1, repeated).otherwise(F.col("submissions"))
    )
    part_key = F.col("l_partkey")
    return pairs.select(
        _numbered(F.concat_ws("-", "l_suppkey", "l_partkey"), F.col("document")).alias("application_number"),
        F.when(_every(part_key, 37), None)
        .when(_every(part_key, 41), "")
        .otherwise(F.concat(F.lit(" "), F.replace("s_name", F.lit("Supplier"), F.lit("CUSTOMER")), F.lit(" ")))
        .alias("sponsor_name"),
        "submissions",
        F.col("last_ship").cast("timestamp").alias("fetched_at"),
    )


def _empty_applications(part: DataFrame, submissions_type: str) -> DataFrame:
    """Applications without submissions: an empty array, or none at all."""
    key = F.col("p_partkey")
    return part.where(_every(key, 50)).select(
        F.concat(F.lit("X-"), key.cast("string")).alias("application_number"),
        F.lit("Nobody").alias("sponsor_name"),
        F.when(_every(key, 100), F.array().cast(submissions_type)).alias("submissions"),
        F.lit("1995-01-01").cast("timestamp").alias("fetched_at"),
    )


def raw_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(application_number, payload, fetched_at), one row per supplier-part pair, or several
    for a pair of many line items."""
    documents = _application_documents(
        read_table(spark, sf_dir, "lineitem").select(
            "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus", "l_returnflag"
        ),
        read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
    )
    empty = _empty_applications(
        read_table(spark, sf_dir, "part").select("p_partkey"),
        documents.schema["submissions"].dataType.simpleString(),
    )
    return documents.unionByName(empty).select(
        "application_number",
        F.to_json(F.struct("application_number", "sponsor_name", "submissions")).alias("payload"),
        "fetched_at",
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a user's record in arrival order: time, page, position in page."""
    key = F.col("event_id")
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("record_id"),
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.expr(f"event_id div {PAGE_SIZE}").alias("page"),
        F.pmod(key, F.lit(PAGE_SIZE)).cast("bigint").alias("pos"),
    )


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed response pages: (page, fetched_at, body), PAGE_SIZE records at most in each.

    Every page is followed by one without a record list, as an empty response is;
    those are numbered downwards from -1.
    """
    record = F.struct(F.col("record_id").alias("user"), "event_id", "event_type")
    pages = (
        event_records(spark, sf_dir)
        .groupBy("page")
        .agg(
            F.max("fetched_at").alias("fetched_at"),
            F.sort_array(F.collect_list(F.struct("pos", record.alias("record")))).alias("items"),
        )
    )
    filled = F.struct(
        F.col("page").alias("page"),
        F.to_json(
            F.struct(
                F.transform("items", lambda item: item["record"]).alias("studies"),
                (F.col("page") + 1).cast("string").alias("nextPageToken"),
            )
        ).alias("body"),
    )
    empty = F.struct((-F.col("page") - 1).alias("page"), F.lit("{}").alias("body"))
    return pages.select("fetched_at", F.inline(F.array(filled, empty))).select("page", "fetched_at", "body")
