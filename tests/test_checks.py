"""Nested schemas and samples of exact size."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, MapType, StringType, StructField, StructType

from tapeloom.operators import sample_exact, schema_violations


def report(df, expected):
    return {(row["column"], row["problem"]): tuple(row)[2:] for row in schema_violations(df, expected).collect()}


@pytest.fixture(scope="module")
def nested(spark):
    schema = "id int, s struct<A: string, t: struct<b: int>>, l array<struct<x: string>>, m map<string, array<int>>, v string"
    rows = [
        (1, ("1", (None,)), [("5",), ("y",), (None,), None], {"1": [1, None], "k": None}, "a"),
        (None, (None, None), [], {}, None),
        (3, None, None, None, "7"),
    ]
    return spark.createDataFrame(rows, schema)


def test_every_path_is_held_against_the_schema(spark, nested):
    inner = StructType([StructField("b", IntegerType(), nullable=False), StructField("c", StringType())])
    expected = StructType(
        [
            StructField("ID", IntegerType(), nullable=False),
            StructField("s", StructType([StructField("a", LongType(), nullable=False), StructField("t", inner)]), nullable=False),
            StructField("l", ArrayType(StructType([StructField("X", IntegerType(), nullable=False)]), containsNull=False)),
            StructField("m", MapType(IntegerType(), ArrayType(IntegerType(), containsNull=False), valueContainsNull=False)),
            StructField("v", StructType([StructField("w", StringType())])),
        ]
    )
    assert report(nested, expected) == {
        ("ID", "null"): ("int", "int", 1, 3),
        ("s", "null"): ("struct<A:string,t:struct<b:int>>", "struct<A:string,t:struct<b:int>>", 1, 3),
        ("s.a", "mistyped"): ("bigint", "string", 0, 3),
        ("s.a", "null"): ("string", "string", 1, 3),
        ("s.t.b", "null"): ("int", "int", 1, 3),
        ("s.t.c", "missing"): ("string", None, None, 3),
        ("l.element", "null"): ("struct<x:string>", "struct<x:string>", 1, 3),
        ("l.element.X", "null"): ("string", "string", 1, 3),
        ("l.element.X", "mistyped"): ("int", "string", 1, 3),
        ("m.key", "mistyped"): ("int", "string", 1, 3),
        ("m.value", "null"): ("array<int>", "array<int>", 1, 3),
        ("m.value.element", "null"): ("int", "int", 1, 3),
        ("v", "mistyped"): ("struct<w:string>", "string", 2, 3),
    }


def test_a_schema_that_fits_has_no_report(spark, nested):
    assert report(nested, nested.schema) == {}
    empty = nested.limit(0)
    strict = StructType([StructField(f.name, f.dataType, nullable=False) for f in nested.schema.fields])
    assert report(empty, strict) == {}
    assert set(report(nested, StructType([]))) == {(name, "extra") for name in nested.columns}


def drawn(rows, size, seed=""):
    """rows: group, text and anything else; what SQL's row_number over MD5 gives."""
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append((hashlib.md5(f"{seed}|{'' if row[1] is None else row[1]}".encode()).hexdigest(), row))
    return {row for group in groups.values() for _, row in sorted(group, key=lambda entry: entry[0])[:size]}


@pytest.mark.parametrize("size", [1, 7, 400])
@pytest.mark.parametrize("group_rows", [20, 10**9])
def test_samples_have_their_size(spark, size, group_rows):
    rows = [(key, i) for key, n in (("hot", 3000), ("a", 300), (None, 50), ("one", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, id int").repartition(6)
    got = [tuple(row) for row in sample_exact(df, size, "id", "k", "s", group_rows).collect()]
    assert set(got) == drawn(rows, size, "s") and len(got) == sum(min(size, n) for n in (3000, 300, 50, 1))
    again = [tuple(row) for row in sample_exact(df.repartition(2), size, "id", "k", "s").collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)


def test_a_sample_of_copies_and_of_all_rows(spark):
    copies = spark.createDataFrame([("a", i % 3, i) for i in range(2000)] + [("a", None, -1)], "k string, id int, n int")
    got = sample_exact(copies, 900, "id", "k").collect()
    assert len(got) == 900 and len({row["n"] for row in got}) == 900
    whole = sample_exact(copies.withColumn("id", F.col("n")), 10, ["id", "n"])
    assert whole.columns == ["k", "id", "n"] and whole.count() == 10
    assert sample_exact(copies.limit(0), 5, "id", "k").count() == 0
    for bad in ((0, "id"), (1, [])):
        with pytest.raises(ValueError):
            sample_exact(copies, *bad)


def test_no_sort_before_the_bound(spark, capsys):
    df = spark.range(20_000).selectExpr("id % 3 as k", "id")
    sample_exact(df, 5, "id", "k").explain("formatted")
    plan = capsys.readouterr().out
    assert "Range" not in plan.split("Window")[0] and "drawn" in plan
