"""Types that drift between runs, and their schema versions."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import types as T

from feedmerge.operators import widen, widest
from feedmerge.sinks import run_path, write_run
from feedmerge.sources.evolution import read_evolved, register_schema, schema_versions, stored_schema
from helpers import plan

AT = dt.datetime(2024, 1, 20, 6)

scalars = st.sampled_from(
    [T.NullType(), T.BooleanType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2),
     T.DateType(), T.TimestampType(), T.StringType(), T.BinaryType()]
)
kinds = st.recursive(
    scalars,
    lambda inner: st.one_of(
        inner.map(T.ArrayType),
        st.dictionaries(st.sampled_from("abc"), inner, min_size=1).map(lambda d: T.StructType([T.StructField(k, d[k]) for k in sorted(d)])),
    ),
    max_leaves=5,
)


def shape(kind):
    """A type without the order of its fields."""
    if isinstance(kind, T.StructType):
        return "struct", frozenset((f.name, shape(f.dataType)) for f in kind.fields)
    return ("array", shape(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


@settings(max_examples=300, deadline=None)
@given(kinds, kinds, kinds)
def test_the_order_of_runs_does_not_matter(a, b, c):
    assert shape(widest(a, b)) == shape(widest(b, a))
    assert shape(widest(widest(a, b), c)) == shape(widest(a, widest(b, c)))
    assert widest(a, a) == a
    assert shape(widest(widest(a, b), b)) == shape(widest(a, b))


def test_values_of_every_kind_are_widened(spark):
    narrow = spark.createDataFrame(
        [(1, 2, {"k": 3}, Row(x=1, y=[Row(z=5)]), Row(q=7), dt.date(2024, 1, 2), None), (None,) * 7],
        "n int, t bigint, m map<string, int>, s struct<x: int, y: array<struct<z: int>>>, j struct<q: int>, d date, gone void",
    )
    wide = T.StructType.fromDDL(
        "d timestamp_ntz, n double, T string, m map<string, bigint>, s struct<x: bigint, y: array<struct<z: string, w: int>>, v: date>, j string, gone int, new array<int>"
    )
    got = widen(narrow, wide)
    assert got.schema.simpleString() == wide.simpleString()
    first, empty = got.collect()
    assert first.asDict(recursive=True) == {
        "d": dt.datetime(2024, 1, 2), "n": 1.0, "T": "2", "m": {"k": 3}, "s": {"x": 1, "y": [{"z": "5", "w": None}], "v": None},
        "j": json.dumps({"q": 7}, separators=(",", ":")), "gone": None, "new": None,
    }
    assert set(empty) == {None}
    with pytest.raises(ValueError, match="narrower"):
        widen(narrow, T.StructType.fromDDL("n boolean"))


def test_versions_grow_only_when_a_run_adds_something(spark, tmp_path):
    base = str(tmp_path)
    assert stored_schema(spark, base) == (0, T.StructType())
    first = T.StructType.fromDDL("a bigint, b struct<x: int>")
    assert register_schema(spark, base, first) == 1
    assert register_schema(spark, base, T.StructType.fromDDL("A int")) == 1
    assert register_schema(spark, base, T.StructType.fromDDL("a double, c string, b struct<y: int>")) == 2
    assert schema_versions(spark, base) == [1, 2]
    assert stored_schema(spark, base)[1].simpleString() == "struct<a:double,b:struct<x:int,y:int>,c:string>"
    assert stored_schema(spark, base, 1)[1] == first


def test_runs_read_as_one_and_the_result_does_not_depend_on_the_days(spark, tmp_path):
    base, days = str(tmp_path), ["2024-01-18", "2024-01-19", "2024-01-20"]
    for day, (values, schema) in zip(days, [([(1, 5)], "id int, v bigint"), ([(2, 0.5)], "id int, v double"), ([(3, "x", True)], "id int, v string, w boolean")]):
        rows = spark.createDataFrame(values, schema)
        register_schema(spark, base, rows.schema)
        write_run(rows, run_path(base, day, AT))
    assert {tuple(r) for r in read_evolved(spark, base, days).collect()} == {(1, "5", None), (2, "0.5", None), (3, "x", True)}
    one = read_evolved(spark, base, days[:1])
    assert one.dtypes == read_evolved(spark, base, days).dtypes
    assert read_evolved(spark, base, ["2023-01-01"]).count() == 0
    # an old version takes the runs that fit it and refuses others
    assert read_evolved(spark, base, days[:1], version=1).dtypes == [("id", "int"), ("v", "bigint")]
    with pytest.raises(ValueError, match="narrower"):
        read_evolved(spark, base, days, version=1)
    # filters on columns that kept their type reach every scan
    assert plan(read_evolved(spark, base, days).where("id = 2")).count("EqualTo(id,2)") == 3


def test_unregistered_runs_unfinished_ones_and_day_folders(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(ValueError, match="no run and no schema"):
        read_evolved(spark, base, ["2024-01-20"])
    dated = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, None)], "id int, at timestamp")
    write_run(dated, run_path(base, "2024-01-20", AT), "at")
    write_run(dated.selectExpr("cast(id as bigint) id"), run_path(base, "2024-01-20", AT + dt.timedelta(hours=1)))
    got = read_evolved(spark, base, ["2024-01-20"])
    assert got.dtypes == [("id", "bigint"), ("at", "timestamp")]
    assert sorted(r.id for r in got.collect()) == [1, 1, 2, 2]
    (tmp_path / "20240121" / "run=1").mkdir(parents=True)
    with pytest.raises(ValueError, match="no finished run"):
        read_evolved(spark, base, ["2024-01-21"])
