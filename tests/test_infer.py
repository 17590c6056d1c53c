"""Schemas found in record pages, and how they drift."""

from __future__ import annotations

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from quayload.sources.infer import SchemaBroken, drift_rows, infer_record_schema, join_types, schema_drift
from quayload.sources.records import IncompletePages, extract_records


def land(folder, *pages):
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({"records": p} if isinstance(p, list) else p) for p in pages))
    return str(folder)


def ddl(schema):
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def test_mixed_pages_give_one_schema(spark, tmp_path):
    pages = land(
        tmp_path / "p",
        [{"id": 1, "price": 5, "note": None, "tags": [1], "at": {"lat": 1.5}, "odd name": True}],
        [{"id": 2, "price": 2.25, "mixed": "x", "tags": [], "at": {"lon": 100}}, {}],
        [{"id": 3, "price": 1000, "mixed": 7, "tags": ["a"], "at": None}],
        [],
    )
    schema, drift = infer_record_schema(spark, pages)
    found = ddl(schema)
    assert drift == [] and found["id"] == "bigint" and found["note"] == found["mixed"] == "string"
    assert found["tags"] == "array<string>" and found["odd name"] == "boolean"
    assert found["price"].startswith("decimal") and dict(ddl(schema["at"].dataType))["lon"] == "bigint"
    rows = extract_records(spark, pages, schema).orderBy("id").collect()
    assert [r.mixed for r in rows if r.id] == [None, "x", "7"] and [float(r.price) for r in rows if r.id] == [5, 2.25, 1000]


def test_drift_from_the_last_schema(spark, tmp_path):
    last = T.StructType.fromDDL("gone string, id bigint, name string, price bigint, at struct<lat: bigint>")
    pages = land(tmp_path / "p", [{"id": None, "name": 5, "price": 1.5, "at": {"lat": 2, "lon": 3}, "fresh": False}])
    schema, drift = infer_record_schema(spark, pages, last)
    assert [f.name for f in schema.fields] == ["gone", "id", "name", "price", "at", "fresh"]
    found = ddl(schema)
    assert found["name"] == "string" and found["id"] == "bigint" and found["fresh"] == "boolean"
    assert found["price"] == "decimal(20,1)" and found["at"] == "struct<lat:bigint,lon:bigint>"
    kinds = {d.path: d.kind for d in drift}
    assert kinds == {"gone": "missing", "id": "kept", "name": "kept", "price": "widened", "at.lon": "added", "fresh": "added"}
    assert drift_rows(spark, drift).count() == 6
    with pytest.raises(SchemaBroken, match="at"):
        infer_record_schema(spark, land(tmp_path / "q", [{"at": 5}]), last)
    with pytest.raises(SchemaBroken, match="id"):
        infer_record_schema(spark, land(tmp_path / "r", [{"id": [1]}]), last)


def test_faulty_and_empty_pages(spark, tmp_path):
    for i, page in enumerate(({"error": 1}, {"records": 5}, {"records": None})):
        with pytest.raises(Exception, match="no list of records"):
            infer_record_schema(spark, land(tmp_path / f"p{i}", [{"a": 1}], page))
    empty = land(tmp_path / "none", [])
    with pytest.raises(IncompletePages):
        infer_record_schema(spark, empty)
    last = T.StructType.fromDDL("a bigint")
    schema, drift = infer_record_schema(spark, empty, last)
    assert ddl(schema) == {"a": "bigint"} and [d.kind for d in drift] == ["missing"]
    with pytest.raises(IncompletePages):
        infer_record_schema(spark, land(tmp_path / "plain", [1, 2]))
    wrapped = land(tmp_path / "wrapped", [{"id": "r1", "fields": {"x": 1}}])
    assert ddl(infer_record_schema(spark, wrapped, values_in="fields")[0]) == {"x": "bigint"}


plain = st.sampled_from([T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.NullType(), T.DecimalType(5, 2), T.DecimalType(38, 30)])
kinds = st.recursive(plain, lambda inner: st.builds(T.ArrayType, inner) | st.dictionaries(st.sampled_from("ab"), inner).map(lambda d: T.StructType([T.StructField(k, v) for k, v in sorted(d.items())])), max_leaves=6)


def sorted_fields(kind):
    if isinstance(kind, T.StructType):
        return T.StructType(sorted((T.StructField(f.name, sorted_fields(f.dataType)) for f in kind.fields), key=lambda f: f.name))
    return T.ArrayType(sorted_fields(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


@given(kinds, kinds)
def test_joined_types_hold_both(a, b):
    joined = join_types(a, b)
    assert sorted_fields(joined) == sorted_fields(join_types(b, a)) and join_types(a, a) == a
    assert sorted_fields(join_types(joined, a)) == sorted_fields(joined) == sorted_fields(join_types(joined, b))


def test_no_drift():
    same = T.StructType.fromDDL("a bigint, b struct<c: string>")
    assert schema_drift(same, same) == []
