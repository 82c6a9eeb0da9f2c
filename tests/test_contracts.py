import datetime as dt

import pytest
from pyspark.sql import types as T

from huddlekit.operators.contracts import (ADP_SCHEMA, ADP_SPECS, ColumnSpec, align_to_schema,
                                           contract_report, declared_type, spec_names, specs_from_frame,
                                           to_struct)


def test_spec_validation():
    with pytest.raises(ValueError):
        ColumnSpec("x", "INT32")
    with pytest.raises(ValueError):
        ColumnSpec("x", "INT64", "OPTIONAL")
    f = ColumnSpec("x", "INT64", "REQUIRED", "d", valid_range=(0, 5)).to_field()
    assert not f.nullable and f.metadata["valid_range"] == [0, 5]


def test_adp_contract_shape():
    assert len(ADP_SPECS) == 25
    assert spec_names(ADP_SPECS)[-1] == "ingested_at"
    assert isinstance(ADP_SCHEMA["snapshot_date"].dataType, T.DateType)


def test_specs_from_frame():
    schema = T.StructType([T.StructField("season", T.IntegerType()), T.StructField("w", T.FloatType()),
                           T.StructField("flag", T.BooleanType()), T.StructField("junk", T.StringType())])
    specs = specs_from_frame(schema, table="t", type_overrides={"w": "INT64"}, required=("season",),
                             drop=("junk",), enrichment={
                                 "season": {"description": "year", "unit": "years"},
                                 "w": {"type": "STRING", "source_field": "wt"}, "flag": {"mode": "REPEATED"}})
    assert [(s.name, s.type, s.mode) for s in specs] == [
        ("season", "INT64", "REQUIRED"), ("w", "STRING", "NULLABLE"), ("flag", "BOOL", "REPEATED"),
        ("ingested_at", "TIMESTAMP", "REQUIRED")]
    assert specs[0].description == "year" and specs[0].extra == {"unit": "years"}
    assert specs[1].source_field == "wt"
    with pytest.raises(ValueError):
        specs_from_frame(schema, table="t", required=("nope",))
    assert declared_type(T.TimestampNTZType()) == "TIMESTAMP"


def test_align_and_coerce(spark):
    schema = to_struct([ColumnSpec("a", "INT64"), ColumnSpec("b", "STRING"), ColumnSpec("c", "DATE"),
                        ColumnSpec("d", "BOOL"), ColumnSpec("e", "FLOAT64"), ColumnSpec("f", "STRING"),
                        ColumnSpec("ingested_at", "TIMESTAMP", "REQUIRED")])
    df = spark.createDataFrame([("4107.0", 1.0, "2024-01-05", "true", "x", None, 9),
                                ("6.75", 2.5, "nope", "maybe", "1e3", "s", 9)],
                               "a string, b double, c string, d string, e string, f string, extra int")
    out = align_to_schema(df, schema)
    assert out.columns == ["a", "b", "c", "d", "e", "f", "ingested_at"]
    r1, r2 = out.collect()
    assert (r1.a, r1.b, r1.c, r1.d, r1.e, r1.f) == (4107, "1", dt.date(2024, 1, 5), True, None, None)
    assert (r2.a, r2.b, r2.c, r2.d, r2.e) == (None, "2.5", None, None, 1000.0)
    assert r1.ingested_at is not None
    missing = align_to_schema(spark.createDataFrame([(1,)], "z int"), schema, stamp=False)
    assert missing.columns == ["a", "b", "c", "d", "e", "f"] and missing.first().a is None


def test_contract_report_is_a_report(spark):
    schema = to_struct([ColumnSpec("week", "INT64", valid_range=(1, 22)),
                        ColumnSpec("source", "STRING", valid_values=("ffc", "mfl"))])
    df = spark.createDataFrame([(1, "ffc"), (30, "xyz"), (None, None)], "week long, source string")
    got = {(r.column, r.rule): r.outside for r in contract_report(df, schema).collect()}
    assert got == {("week", "valid_range"): 1, ("source", "valid_values"): 1}
    assert df.count() == 3
