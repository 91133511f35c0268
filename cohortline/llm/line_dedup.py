"""Recurring lines by a log-template tree, with DataFrame functions only.

Lines are cut at newlines and tokens at single spaces; a token with a digit is a variable
field. The tree has fixed depth: a line's leaf is its number of tokens and its first
``LEADS`` masked tokens. In a leaf, the masked line of most documents is the leaf's
template (ties: the one met first, by document and position); lines of the leaf that
agree with it in ``AGREE_PERCENT`` of the tokens belong to it, and the tokens in which
they differ are further variable fields. Every other masked line is a template itself.

A template recurs if ``MIN_DOCS`` documents or more have it and they differ around it:
the leaves of the lines before it, or of those after it, take at least
``MIN_CONTEXT_PERCENT`` different values per hundred documents. That tells boilerplate
from the lines of a document that was copied, which keep their neighbours. Lines of a
recurring template are dropped from every document.

Lines are counted as 64-bit numbers; text is shuffled once, to meet the positions of its
dropped lines, and a template of very many documents is only ever counted (partial
aggregates) or split by adaptive joins.

Defined results: a null text is an empty one and becomes ``''`` only if a line goes, so it
stays null; empty lines and lines of fewer than ``MIN_TOKENS`` tokens never go; repeated
rows (same id and text) are counted as one document and treated alike; a null id is an id;
a text may become empty, its row stays; an empty table gives an empty result; other
columns are passed on, ``n_chars`` is set to the new length where there is one, and columns
called ``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.store import Store

LEADS = 3
MIN_TOKENS = 3
AGREE_PERCENT = 80
MIN_DOCS = 10
MIN_CONTEXT_PERCENT = 30


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _masked(line: Column) -> Column:
    fields = F.transform(F.split(line, " ", -1), lambda t: F.when(t.rlike("[0-9]"), F.lit("<*>")).otherwise(t))
    return F.when(line.rlike("[0-9]"), F.array_join(fields, " ")).otherwise(line)


def _tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column) -> Column:
    return F.xxhash64(_tokens(line), F.substring_index(_masked(line), " ", LEADS))


def _identified(documents: DataFrame) -> DataFrame:
    return documents.select(
        # Equal rows are one document; a null id is an id of its own.
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text").alias("row"),
        F.col("doc_id").alias("doc"),
        _lines(F.col("text")).alias("lines"),
    )


def occurrences(documents: DataFrame) -> DataFrame:
    """row, doc, pos, tokens, leaf, masked, before, after: numbers for each line that could go."""
    read = _identified(documents)
    leaves = read.withColumn("leaves", F.transform("lines", _leaf))
    zipped = leaves.select(
        "row",
        "doc",
        F.posexplode(
            F.arrays_zip(
                F.col("lines").alias("line"),
                F.col("leaves").alias("leaf"),
                F.concat(F.array(F.lit(None).cast("long")), "leaves").alias("before"),
                F.slice("leaves", 2, F.greatest(F.size("leaves"), F.lit(1))).alias("after"),
            )
        ).alias("pos", "z"),
    )
    return zipped.where(F.col("z.line").isNotNull() & (_tokens(F.col("z.line")) >= MIN_TOKENS)).select(
        "row",
        "doc",
        "pos",
        "z.leaf",
        F.xxhash64(_masked(F.col("z.line"))).alias("masked"),
        # No line before or after is a neighbour like any other.
        F.coalesce("z.before", F.lit(0)).alias("before"),
        F.coalesce("z.after", F.lit(0)).alias("after"),
    )


def _spread(found: DataFrame, *keys: str) -> DataFrame:
    """Documents and distinct neighbours of each key, from three levels of counting."""
    parts = []
    for column in ("row", "before", "after"):
        distinct = found.select(*keys, column).distinct()
        parts.append(distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n_{column}")))
    joined = parts[0].where(F.col("n_row") >= MIN_DOCS)
    for part in parts[1:]:
        joined = joined.join(part, list(keys))
    return joined


def recurring(documents: DataFrame, found: DataFrame, store: Store) -> DataFrame:
    """leaf, masked of every line variant whose template recurs."""
    per_document = found.groupBy("leaf", "masked", "row").agg(F.min(F.struct("doc", "pos")).alias("met"))
    variants = store.write(
        per_document.groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("docs"), F.min("met").alias("met")), "variants"
    )
    rank = F.struct(F.col("docs"), (-F.col("met.doc")).alias("d"), (-F.col("met.pos")).alias("p"))
    leaves = variants.groupBy("leaf").agg(
        F.sum("docs").alias("leaf_docs"), F.count(F.lit(1)).alias("kinds"), F.max_by("masked", rank).alias("seed")
    )
    # A leaf below the threshold in all cannot hold a recurring template.
    busy = leaves.where((F.col("leaf_docs") >= MIN_DOCS) & (F.col("kinds") > 1)).select("leaf", "seed")
    open_variants = store.write(
        variants.join(busy, "leaf").select("leaf", "masked", "seed", "met.doc", "met.pos", "met"), "open"
    )
    # The text of each open variant, from the line where it was met first.
    wanted = open_variants.groupBy("doc").agg(F.collect_set("pos").alias("wanted"))
    texts = _identified(documents).select("doc", "lines")
    texts = texts.join(wanted.hint("shuffle_hash"), texts["doc"].eqNullSafe(wanted["doc"])).select("lines", "wanted")
    spelled = (
        texts.select(F.explode(F.filter(F.transform("wanted", lambda p: F.get("lines", p)), lambda x: x.isNotNull())).alias("line"))
        .select(_leaf(F.col("line")).alias("leaf"), _masked(F.col("line")).alias("spelled"))
        .withColumn("masked", F.xxhash64("spelled"))
        .dropDuplicates(["leaf", "masked"])
    )
    spelled = store.write(open_variants.select("leaf", "masked", "seed").join(spelled, ["leaf", "masked"]), "spelled")
    seeds = spelled.where("masked = seed").select("leaf", F.col("spelled").alias("seed_spelled"))
    equal = F.zip_with(
        F.split("spelled", " ", -1), F.split("seed_spelled", " ", -1), lambda a, b: F.when(a == b, 1).otherwise(0)
    )
    agreeing = F.aggregate(equal, F.lit(0), lambda a, x: a + x)
    joined = spelled.join(seeds, "leaf").where(agreeing * 100 >= F.size(equal) * AGREE_PERCENT)
    merged = store.write(joined.select("leaf", "masked", F.col("seed").alias("template")), "merged")

    templates = found.join(merged, ["leaf", "masked"], "left").withColumn("template", F.coalesce("template", "masked"))
    spread = _spread(templates, "leaf", "template")
    differs = F.greatest("n_before", "n_after") * 100 >= F.col("n_row") * MIN_CONTEXT_PERCENT
    recurs = store.write(spread.where(differs).select("leaf", "template"), "recurring")
    return (
        recurs.select("leaf", F.col("template").alias("masked"))
        .union(recurs.join(merged, ["leaf", "template"]).select("leaf", "masked"))
        .distinct()
    )


def drop_recurring(documents: DataFrame) -> DataFrame:
    """The documents without recurring lines; adds n_lines and n_dropped."""
    store = Store(documents, "line-dedup")
    found = store.write(occurrences(documents), "occurrences")
    gone = store.write(recurring(documents, found, store), "gone")
    dropped = found.join(gone, ["leaf", "masked"]).groupBy("row").agg(F.collect_set("pos").alias("_dropped"))
    row = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")
    others = [name for name in documents.columns if name not in ("text", "n_chars", "n_lines", "n_dropped")]
    # Packed, so that no name of a column meets one used here.
    cut = documents.select(
        F.struct(*others).alias("_others"), row.alias("_row"), F.col("text").isNull().alias("_null"), _lines(F.col("text")).alias("_lines")
    )
    joined = cut.join(dropped.withColumnRenamed("row", "_row").hint("shuffle_hash"), "_row", "left")
    # The stretches between dropped lines; the time is linear in lines, however many go.
    ends = F.array_sort("_dropped")
    stretches = F.arrays_zip(
        F.concat(F.array(F.lit(-1)), ends).alias("low"), F.concat(ends, F.array(F.size("_lines"))).alias("high")
    )
    kept = F.flatten(F.transform(stretches, lambda s: F.slice("_lines", s["low"] + 2, s["high"] - s["low"] - 1)))
    text = F.array_join(F.when(F.col("_dropped").isNull(), F.col("_lines")).otherwise(kept), "\n")
    result = joined.select(
        "_others.*",
        F.when(~F.col("_null"), text).alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    if "n_chars" in documents.columns:
        result = result.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return result


ORACLE_SQL = f"""
with cut as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lined as (
    select doc_id, generate_subscripts(lines, 1) as pos, unnest(lines) as line from cut
), parsed as (
    select doc_id, pos, line,
           list_transform(string_split(line, ' '), lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as tokens
    from lined
), leafed as (
    select *, len(tokens) || ' ' || array_to_string(tokens[1:{LEADS}], ' ') as leaf,
           array_to_string(tokens, ' ') as masked
    from parsed
), around as (
    select *, coalesce(lag(leaf) over w, '') as before, coalesce(lead(leaf) over w, '') as after
    from leafed window w as (partition by doc_id order by pos)
), found as (
    select * from around where len(tokens) >= {MIN_TOKENS}
), variants as (
    select leaf, masked, tokens, count(distinct doc_id) as docs, min((doc_id, pos)) as met
    from found group by all
), seeds as (
    select leaf, tokens as seed_tokens, masked as seed from variants
    qualify row_number() over (partition by leaf order by docs desc, met) = 1
), merged as (
    select v.leaf, v.masked,
           case when 100 * len(list_filter(list_zip(tokens, seed_tokens), lambda p: p[1] = p[2])) >= {AGREE_PERCENT} * len(tokens)
                then seed else masked end as template
    from variants v join seeds using (leaf)
), spread as (
    select leaf, template from found join merged using (leaf, masked)
    group by leaf, template
    having count(distinct doc_id) >= {MIN_DOCS}
       and 100 * greatest(count(distinct before), count(distinct after)) >= {MIN_CONTEXT_PERCENT} * count(distinct doc_id)
), gone as (
    select doc_id, pos from found join merged using (leaf, masked) join spread using (leaf, template)
), kept as (
    select doc_id, string_agg(line, chr(10) order by pos) as text
    from lined anti join gone using (doc_id, pos) group by doc_id
), counted as (
    select doc_id, count(*) as n_dropped from gone group by doc_id
)
select d.doc_id, len(c.lines)::bigint as n_lines, coalesce(n.n_dropped, 0)::bigint as n_dropped,
       coalesce(k.text, '') as text
from documents d join cut c using (doc_id) left join kept k using (doc_id) left join counted n using (doc_id)
"""
