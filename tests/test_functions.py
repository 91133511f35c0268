from __future__ import annotations

import datetime
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortline import functions as fn

D = datetime.date


def one(spark, column, **values):
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in values.items()) or "x int"
    row = tuple(value for _, value in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [("2020-07-15", D(2020, 7, 15)), ("2020-07", D(2020, 7, 1)), ("2020", None), (None, None), ("", None)],
)
def test_partial_date(spark, text, expected):
    assert one(spark, fn.partial_date(F.col("t")), t=("string", text)) == expected


def test_partial_date_raises_on_a_bad_day(spark):
    with pytest.raises(PySparkException):
        one(spark, fn.partial_date(F.col("t")), t=("string", "2020-02-31"))


@pytest.mark.parametrize(
    "text, expected",
    [("20200131", D(2020, 1, 31)), ("2020-01-31", None), ("202001310", None), ("", None), (None, None)],
)
def test_compact_date(spark, text, expected):
    assert one(spark, fn.compact_date(F.col("t")), t=("string", text)) == expected


@pytest.mark.parametrize(
    "first, last, expected", [(2018, 2020, [2018, 2019, 2020]), (2020, 2020, [2020]), (2020, 2018, [])]
)
def test_year_span(spark, first, last, expected):
    span = fn.year_span(F.col("a"), F.col("b"))
    assert one(spark, span, a=("int", first), b=("int", last)) == expected


def test_days_between_may_be_negative(spark):
    days = fn.days_between(F.col("a"), F.col("b"))
    assert one(spark, days, a=("date", D(2020, 1, 10)), b=("date", D(2020, 1, 1))) == -9
    assert one(spark, days, a=("date", None), b=("date", D(2020, 1, 1))) is None


def test_surrogate_key_counts_null_as_empty(spark):
    key = one(spark, fn.surrogate_key("a", "b", "c"), a=("string", "x"), b=("string", None), c=("int", 7))
    assert key == hashlib.md5(b"x||||7").hexdigest()


@pytest.mark.parametrize("text, expected", [(" Acme  ", "Acme"), ("  ", None), ("", None), (None, None)])
def test_trimmed_or_null(spark, text, expected):
    assert one(spark, fn.trimmed_or_null(F.col("t")), t=("string", text)) == expected


def test_blank_to_null_keeps_spaces(spark):
    assert one(spark, fn.blank_to_null(F.col("t")), t=("string", " ")) == " "


@pytest.mark.parametrize(
    "items, expected", [(["A", "B"], "A|B"), (["A"], "A"), ([], None), (None, None), (["A", None, "B"], "A|B")]
)
def test_joined_or_null(spark, items, expected):
    assert one(spark, fn.joined_or_null(F.col("i")), i=("array<string>", items)) == expected


@pytest.mark.parametrize(
    "code, expected", [("FED", "Federal"), ("OTHER_GOV", "Other Government"), ("ALIEN", "ALIEN"), (None, "Unknown")]
)
def test_decode_sponsor_class(spark, code, expected):
    assert one(spark, fn.decode_sponsor_class(F.col("c")), c=("string", code)) == expected


@pytest.mark.parametrize(
    "code, expected",
    [
        ("PHASE1|PHASE2", "Phase 1 / Phase 2"),
        ("EARLY_PHASE1", "Early Phase 1"),
        ("NA", "N/A"),
        ("PHASE9", "PHASE9"),
        (None, "Not Reported"),
    ],
)
def test_decode_phase(spark, code, expected):
    assert one(spark, fn.decode_phase(F.col("c")), c=("string", code)) == expected


@pytest.mark.parametrize(
    "phase, expected", [("PHASE1|PHASE2", True), ("phase2", True), ("PHASE3", False), (None, False)]
)
def test_is_combined_phase(spark, phase, expected):
    assert one(spark, fn.is_combined_phase(F.col("p"), "PHASE2"), p=("string", phase)) is expected


@pytest.mark.parametrize(
    "value, expected",
    [(0.0, "green"), (0.15, "green"), (0.16, "amber"), (0.35, "amber"), (0.36, "red")],
)
def test_traffic_light(spark, value, expected):
    assert one(spark, fn.traffic_light(F.col("v"), 0.15, 0.35), v=("double", value)) == expected


@pytest.mark.parametrize("part, whole, expected", [(1, 3, 0.3333), (2, 1, 2.0), (1, 0, None), (1, 32, 0.0313)])
def test_ratio(spark, part, whole, expected):
    assert one(spark, fn.ratio(F.col("p"), F.col("w")), p=("bigint", part), w=("bigint", whole)) == expected


def test_round_rates_leaves_other_columns(spark):
    frame = spark.createDataFrame([(0.123456, 0.123456)], "a_rate double, b double")
    assert tuple(fn.round_rates(frame).first()) == (0.1235, 0.123456)
