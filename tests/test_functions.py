from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from loanloom.functions import (
    binary_label,
    class_weight,
    hash_bucket,
    parse_failed,
    share_percent,
    split_item,
    unit_value,
)
from loanloom.operators.cleaning import UnitRule, parse_failures, parse_units
from loanloom.plans.loans import UNIT_RULES

UNIT_ROWS = [
    (" 36 months", "7.50%", "20%"),
    ("36 months", "9%", ""),
    (None, None, None),
    ("months", "%", "n/a"),
    ("", "12.25", "35.5%"),
]


@pytest.fixture(scope="module")
def unit_strings(spark):
    return spark.createDataFrame(UNIT_ROWS, "term string, int_rate string, revol_util string")


def test_unit_values_of_hand_rows(unit_strings):
    rows = parse_units(unit_strings, UNIT_RULES).collect()
    assert [tuple(r) for r in rows] == [
        (36, 7.5, 20.0),
        (None, 9.0, None),
        (None, None, None),
        (None, None, None),
        (None, 12.25, 35.5),
    ]


def test_parse_units_types_and_dropped_sources(unit_strings):
    out = parse_units(unit_strings, UNIT_RULES)
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("newTerm", "int"),
        ("intRate", "double"),
        ("revolUtil", "double"),
    ]


def test_parse_units_keeps_named_sources(unit_strings):
    out = parse_units(unit_strings, UNIT_RULES, keep=["revol_util"])
    assert out.columns == ["revol_util", "newTerm", "intRate", "revolUtil"]


def test_parse_failures_count_text_without_value(unit_strings):
    failed = {r.column_name: r.failed_rows for r in parse_failures(unit_strings, UNIT_RULES).collect()}
    assert failed == {"newTerm": 3, "intRate": 1, "revolUtil": 2}


def test_parse_failed_is_false_for_null_source(spark):
    df = spark.createDataFrame([(None,), ("x",), ("1",)], "t string")
    value = unit_value("t", "-", 0, "int")
    assert [r[0] for r in df.select(parse_failed("t", value)).collect()] == [False, True, False]


@pytest.mark.parametrize("sep", [".", "|", "%", "\\", "$", "+", "[", "||", "a.b"])
def test_separator_is_literal(spark, sep):
    df = spark.createDataFrame([(f"1{sep}2",)], "t string")
    assert df.select(split_item("t", sep, 1)).first()[0] == "2"


def test_item_out_of_range_is_null(spark):
    df = spark.createDataFrame([("a-b",)], "t string")
    assert df.select(split_item("t", "-", 2)).first()[0] is None


def test_unit_rule_as_column(spark):
    df = spark.createDataFrame([("Brand#17",)], "b string")
    assert df.select(UnitRule("b", "n", "#", 1, "int").column()).first()[0] == 17


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("int", [0, 1, 3, None], [0, 1, 1, None]),
        ("bigint", [0, 1, 3, None], [0, 1, 1, None]),
        ("string", ["0", "2", "x", None], [0, 1, None, None]),
        ("string", ["0.0", "1.0", "0.5", "-0"], [0, 1, 1, 0]),
        ("bigint", [3_000_000_000, 2**62], [1, 1]),
        ("double", [0.5, 3e9, 0.0, -0.0], [1, 1, 0, 0]),
    ],
)
def test_binary_label(spark, kind, values, expected):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}").select(
        binary_label("c").alias("label")
    )
    assert df.schema["label"].dataType.simpleString() == "int"
    assert [r.label for r in df.collect()] == expected


def test_class_weight_values(spark):
    df = spark.createDataFrame([(0,), (1,)], "label int")
    assert [r[0] for r in df.select(class_weight("label", F.lit(0.25))).collect()] == [0.25, 0.75]


def test_share_percent(spark):
    df = spark.createDataFrame([(0,), (1,), (None,), (0,)], "c int")
    assert df.agg(share_percent(F.col("c") == 1)).first()[0] == 25.0
    assert df.limit(0).agg(share_percent(F.col("c") == 1)).first()[0] is None


def test_hash_bucket_follows_its_definition(spark):
    keys = [0, 1, 17, 123456789]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r[0] for r in df.select(hash_bucket("k", seed=784)).collect()]
    want = [int(hashlib.md5(f"{k}:784".encode()).hexdigest()[:8], 16) % 10_000 for k in keys]
    assert got == want


@pytest.mark.parametrize("portable", [True, False])
def test_hash_buckets_cover_null_keys_evenly(spark, portable):
    df = spark.createDataFrame([(None,)], "id bigint").union(spark.range(20_000))
    b = df.select(hash_bucket("id", seed=1, portable=portable).alias("b"))
    low, high, first = b.agg(F.min("b"), F.max("b"), F.avg((F.col("b") < 7000).cast("int"))).first()
    assert 0 <= low < high < 10_000
    assert 0.68 < first < 0.72
