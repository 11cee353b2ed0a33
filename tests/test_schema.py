import json

import pytest
from pyspark.sql import types as T

from rastertab.sources.schemas import (conform, declared, enforce_required, read_declared, read_schema_json,
                                       required_violations, to_struct)


def test_recursive_schema_with_defaults():
    s = to_struct(json.loads("""[
      {"name": "a"},
      {"name": "b", "type": "integer", "mode": "REQUIRED", "description": "bee"},
      {"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "x", "type": "FLOAT"}]},
      {"name": "e", "type": "record", "fields": []}
    ]"""))
    assert s["a"].dataType == T.StringType() and s["a"].nullable
    assert s["b"].dataType == T.LongType() and not s["b"].nullable and s["b"].metadata["comment"] == "bee"
    assert s["r"].dataType == T.ArrayType(T.StructType([T.StructField("x", T.DoubleType())]), False)
    assert s["e"].dataType == T.StringType()  # record without fields does not nest


def test_declared_schemas():
    g = declared("gfs_group")
    assert g.fieldNames() == ["creation_time", "geography", "geography_polygon", "forecast"]
    assert g["creation_time"].dataType == T.TimestampNTZType()
    elem = g["forecast"].dataType.elementType
    assert elem.fieldNames()[:2] == ["hours", "time"] and len(elem.fieldNames()) == 11
    assert declared("gfs")["forecast_hours"].nullable


def test_read_schema_json_file(tmp_dir):
    p = f"{tmp_dir}/s.json"
    with open(p, "w") as fh:
        fh.write('[{"name": "x", "type": "FLOAT", "mode": "REQUIRED"}]')
    assert to_struct(read_schema_json(p))["x"].dataType == T.DoubleType()


def test_conform_drops_unknown_and_nulls_missing(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "ID int, extra string, v double")
    s = to_struct([{"name": "id", "type": "INTEGER"}, {"name": "v", "type": "FLOAT"}, {"name": "w", "type": "FLOAT"}])
    r = conform(df, s).collect()[0]
    assert r.asDict() == {"id": 1, "v": 2.5, "w": None}


def test_declared_read_widens_and_reports_required(spark, tmp_dir):
    spark.createDataFrame([(1, None), (2, 3)], "a int, b int").write.parquet(f"{tmp_dir}/p")
    s = to_struct([{"name": "a", "type": "INTEGER", "mode": "REQUIRED"},
                   {"name": "b", "type": "INTEGER", "mode": "REQUIRED"},
                   {"name": "c", "type": "FLOAT", "mode": "REQUIRED"}])
    df = read_declared(spark, f"{tmp_dir}/p", s)
    assert dict(df.dtypes)["a"] == "bigint"
    rep = required_violations(df, s).collect()[0]
    assert (rep.rows, rep.null_a, rep.null_b, rep.null_c) == (2, 0, 1, 2)
    with pytest.raises(Exception, match="REQUIRED column b is null"):
        enforce_required(df.select("a", "b"), s).collect()


def test_unknown_type_raises():
    with pytest.raises(ValueError, match="unknown type INTERVAL"):
        to_struct([{"name": "x", "type": "INTERVAL"}])


def test_nested_required_fields_are_reported_and_enforced(spark):
    schema = to_struct([{"name": "k", "type": "INTEGER", "mode": "REQUIRED"},
                        {"name": "f", "type": "RECORD", "mode": "REPEATED", "fields": [
                            {"name": "h", "type": "INTEGER", "mode": "REQUIRED"}, {"name": "v", "type": "FLOAT"}]}])
    df = spark.createDataFrame([(1, [(1, None), (None, 2.0)]), (2, None), (None, [(None, None)])],
                               "k long, f array<struct<h:long,v:double>>")
    r = required_violations(df, schema).first()
    assert (r.rows, r.null_k, r.null_f_h) == (3, 1, 2)
    assert enforce_required(df.where("k = 2"), schema).count() == 1
    with pytest.raises(Exception, match="REQUIRED column f_h is null"):
        enforce_required(df.where("k = 1"), schema).collect()


def test_declared_descriptions_become_comments(spark):
    from rastertab.sinks.tables import create_table
    import uuid
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_table(spark, name, declared("world_pop"))
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    spark.sql(f"DROP TABLE {name}")
    assert comments["population"] == "people in the cell"
