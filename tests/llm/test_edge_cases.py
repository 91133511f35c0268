"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import numpy as np
import pytest
from corpus import LONG, ODD, SENTENCE

import corpus_pipeline
from cohortline.llm import (
    decontaminate,
    language_id,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    warc,
)
from cohortline.llm.queries import tokenizer_path


@pytest.fixture
def items(spark):
    rows = [("a", SENTENCE), ("b", None), (None, "seven wizards mix"), ("a", SENTENCE), ("c", "")]
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.fixture
def labels(spark):
    rows = [(1, 0), (4, 1), (5, 1), (6, 1), (9, 0), (None, 1), (4, 0), (2, None), (99, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int")


OPERATORS = {
    "suffix_dedup": lambda d, items, labels: suffix_dedup.remove_repeats(d),
    "decontaminate": lambda d, items, labels: decontaminate.digest(decontaminate.contamination(d, items)),
    "language_id": lambda d, items, labels: language_id.identify(d, declared=d["lang"], host=d["source"]),
    "quality_rules": lambda d, items, labels: quality_rules.judge(d, labels),
    "quality_classifier": lambda d, items, labels: quality_classifier.score(d, quality_classifier.train(d, labels)),
    "near_dedup": lambda d, items, labels: near_dedup.link(d),
    "line_dedup": lambda d, items, labels: line_dedup.drop_recurring(d),
    "lm_scoring": lambda d, items, labels: lm_scoring.score(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_gets_one_result(documents, items, labels, name):
    result = OPERATORS[name](documents(*ODD), items, labels).collect()
    key = [row["doc_id"] for row in result]
    assert sorted(key, key=str) == sorted((row[0] for row in ODD), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_empty_result(documents, items, labels, name):
    frame = documents(*ODD).limit(0)
    assert OPERATORS[name](frame, items, labels).collect() == []


def by_id(frame, *columns):
    return {row["doc_id"]: tuple(row[c] for c in columns) for row in frame.where("doc_id is not null").collect()}


def test_suffix_dedup_keeps_the_smallest_document(documents):
    found = by_id(suffix_dedup.remove_repeats(documents(*ODD)), "n_bytes", "n_removed", "n_spans")
    size = len(SENTENCE)
    assert found[4] == (size, 0, 0) and found[5] == (size, size, 1)
    assert found[1] == found[2] == (0, 0, 0)
    # Within one document nothing is removed, however often it repeats itself.
    assert found[6] == (len(LONG), 0, 0) and found[9] == (200_000, 0, 0)
    assert found[7][1] >= len(LONG)


def test_decontaminate_counts_words_and_items(documents, items):
    found = by_id(decontaminate.contamination(documents(*ODD), items), "words", "hits", "items")
    assert found[4] == (18, list(range(18)), ["", "a"])
    assert found[1] == found[2] == found[3] == (0, [], [])


def test_decontaminate_removes_documents_or_spans(documents, items):
    frame = documents((1, f"Before, {SENTENCE.upper()}! after"), (2, "clean"), (3, None))
    kept = decontaminate.decontaminate(frame, items)
    assert kept.columns == frame.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == [2, 3]
    cut = decontaminate.decontaminate(frame, items, remove="spans")
    assert cut.columns == frame.columns
    assert by_id(cut, "text") == {1: ("Before, ! after",), 2: ("clean",), 3: (None,)}


def test_decontaminate_in_parts_is_the_same(documents, items, monkeypatch):
    whole = by_id(decontaminate.contamination(documents(*ODD), items), "words", "hits", "items")
    monkeypatch.setattr(decontaminate, "PART_WINDOWS", 2)
    assert by_id(decontaminate.contamination(documents(*ODD), items), "words", "hits", "items") == whole


def test_language_of_texts_without_letters(documents):
    frame = documents(*ODD, (20, "123 456", "en", "web"))
    found = by_id(language_id.identify(frame, declared=frame["lang"], host=frame["source"]), "language", "kept")
    for key in (1, 2, 3, 20):
        assert found[key] == ("und", False)
    assert found[6] == ("en", True)


def test_language_is_declared_or_other(documents):
    def texts(syllables, size=60):
        random = np.random.default_rng(len(syllables))
        return [" ".join("".join(random.choice(syllables, 3)) for _ in range(200)) for _ in range(size)]

    spoken = {"it": ("la", "zio", "che", "gli", "re"), "en": ("the", "ing", "wh", "ou", "st", "ea")}
    rows = [(1_000 * k + j, text, tag, "web") for k, tag in enumerate(spoken) for j, text in enumerate(texts(spoken[tag]))]
    foreign = "市立图书馆除星期一外每天开放，星期一工作人员整理读者归还的图书。" * 5
    junk = "xqzv wkjp zzxq vbnmk qwrtp lkjfd fdsxz pqowz mnbvq xcvlk jkgfd rtwqz pplkm bvcxw zqqkj " * 3
    more = [(5_000, foreign, None, "web"), (5_001, junk, "en", "web"), (5_002, texts(spoken["it"])[0], "IT-it", "web"), (5_003, "", "other", "web")]
    frame = documents(*rows, *more)
    found = by_id(language_id.identify(frame, declared=frame["lang"], host=frame["source"]), "language", "kept")
    assert found[5_000] == ("other", False) and found[5_001] == ("other", False)
    assert found[5_002] == ("it", True) and found[5_003] == ("und", False)
    assert all(found[row[0]] == (row[2], True) for row in rows)


def test_accepted_keeps_null_ids_and_columns(documents):
    # English enough for the text without an id to be told from the background.
    short = [row for row in ODD if len(row[1] or "") < 1_000]
    english = [(100 + k, f"a text that goes on for {word} while, with words enough to count without an end", "en", "web") for k, word in enumerate(SENTENCE.split())]
    frame = documents(*short, *english)
    decisions = language_id.identify(frame, declared=frame["lang"], host=frame["source"])
    kept = language_id.accepted(frame, decisions)
    assert kept.columns == frame.columns
    # A null id is an id: both rows stay, since one of them is accepted.
    assert kept.where("doc_id is null").count() == 2
    refused = language_id.accepted(frame, decisions.withColumn("kept", decisions["doc_id"].isNotNull() & decisions["kept"]))
    assert refused.where("doc_id is null").count() == 0


def test_quality_rules_certify_small_strata_together(spark, documents):
    def text(k, junk=""):
        return " ".join(f"w{k}x{j}" + junk * (j % 5 == 0) for j in range(60))

    # Each language alone has too few labels for the risk, both together have enough; "pl" has none.
    good = [(k, text(k), "en" if k % 2 else "de", "web") for k in range(1_000)]
    bad = [(2_000 + k, text(k, "##"), ("en", "de", "pl", None)[k % 4], "web") for k in range(8)]
    clean = [(3_000, text(1), "pl", "web"), (3_001, text(1), None, "web")]
    labels = spark.createDataFrame([(row[0], int(row[0] < 1_000)) for row in good + bad], "doc_id bigint, quality int")
    found = by_id(quality_rules.judge(documents(*good, *bad, *clean), labels), "base_failed", "kept", "broken_rules")
    assert all(found[row[0]] == (False, False, found[row[0]][2]) and "symbol_ratio" in found[row[0]][2] for row in bad)
    assert np.mean([found[row[0]][1] for row in good]) > 0.99


def test_near_dedup_of_ties(documents):
    frame = documents(*ODD, (11, "two words"), (12, "Two  WORDS"), (13, "other words"))
    found = by_id(near_dedup.link(frame), "n_shingles", "component_id", "kept")
    assert found[5] == (14, 4, False) and found[4] == (14, 4, True)
    assert found[7][1:] == (6, False)
    assert found[12] == (1, 11, False) and found[13] == (1, 13, True)
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True)
    kept = near_dedup.one_of_each(frame, near_dedup.link(frame))
    assert kept.columns == frame.columns
    assert kept.where("doc_id is null").count() == 2


def test_line_dedup_tells_boilerplate_from_copies(documents):
    boiler = [(k, f"Unique start number {chr(97 + k)} here\nRead 12{k} more stories\nOnly {chr(97 + k)} ends so") for k in range(20)]
    copied = [(100 + k, "A copied line of text\nwith the same second line\nand a third one") for k in range(20)]
    short = [(200 + k, f"first words of {chr(97 + k)}\nok then\nlast words of {chr(97 + k)}") for k in range(20)]
    found = by_id(line_dedup.drop_recurring(documents(*boiler, *copied, *short)), "n_dropped", "text", "n_chars")
    for key, text in boiler:
        lines = text.split("\n")
        expected = f"{lines[0]}\n{lines[2]}"
        assert found[key] == (1, expected, len(expected))
    for key, text in (*copied, *short):
        assert found[key][:2] == (0, text)


def test_line_dedup_generalises_fields_of_a_leaf(documents):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    lines = [(k, f"Only {w} begins\nLast changed by user {w} at the office of records today\nOnly {w} goes on") for k, w in enumerate(words)]
    found = by_id(line_dedup.drop_recurring(documents(*lines)), "n_dropped")
    assert set(found.values()) == {(1,)}


def test_line_dedup_keeps_null_texts(documents):
    found = by_id(line_dedup.drop_recurring(documents(*ODD)), "text", "n_lines", "n_dropped")
    assert found[1] == (None, 1, 0) and found[2] == ("", 1, 0)


def test_packing_of_odd_texts(documents):
    placed = packing.pack(documents(*ODD), tokenizer_path(), with_ids=True).collect()
    sizes: dict[int, int] = {}
    for row in placed:
        sizes[row["sequence_id"]] = sizes.get(row["sequence_id"], 0) + row["length"]
        assert len(row["ids"]) == row["length"]
    assert max(sizes.values()) <= packing.CAPACITY
    empty = [row for row in placed if row["doc_id"] in (1, 2, 3)]
    assert [row["ids"] for row in empty] == [[packing.END_ID]] * 3
    assert packing.pack(documents(*ODD).limit(0), tokenizer_path()).collect() == []


def test_archive_of_odd_pages(spark):
    rows = [(1, "http://a/ b\n", "hi"), (2, None, "hi"), (3, "u", None), (None, "x", "hi"), (4, "é", ""), (5, "y", "日本")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "url as payload", "1 as digest")
    index = warc.write_archive(pages)
    read = {row["page_id"]: (row["record_type"], row["refers_to"], row["payload_bytes"]) for row in warc.read_archive(index).collect()}
    assert read == {
        1: ("response", None, 2),
        2: ("revisit", 1, 2),
        3: ("response", None, 0),
        None: ("revisit", 1, 2),
        4: ("revisit", 3, 0),
        5: ("response", None, 6),
    }
    wanted = spark.createDataFrame([(2,), (5,)], "page_id bigint")
    assert {row["page_id"]: row["html"] for row in warc.fetch(index, wanted).collect()} == {2: "hi", 5: "日本"}
    assert warc.read_archive(warc.write_archive(pages.limit(0))).collect() == []


@pytest.mark.parametrize("stage", range(4))
def test_stages_return_the_columns_of_documents(spark, documents, stage):
    frame = documents(*ODD, clashes=False)
    name, run = corpus_pipeline.STAGES[stage]
    for table in (frame, frame.limit(0)):
        result = run(spark, table, "/root/testdata/sf0.001")
        assert result.columns == frame.columns, name
        assert result.schema.simpleString() == frame.schema.simpleString()
