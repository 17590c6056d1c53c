"""The schema sidecar: one small JSON text that travels with a staged table."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quayload.spec import TableSpec
from quayload.workspace import delete_path, write_small_file

PLAIN_TYPES = (
    T.StringType,
    T.BinaryType,
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)
# Working columns of this library have names that begin so.
RESERVED = "_quayload_"
NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType)


def check_stageable(data_type: T.DataType, where: str) -> None:
    """Refuse types the staged text cannot carry without loss."""
    if isinstance(data_type, T.ArrayType):
        check_stageable(data_type.elementType, f"{where}.element")
    elif isinstance(data_type, T.MapType):
        if not isinstance(data_type.keyType, T.StringType):
            raise TypeError(f"{where}: a staged map must have string keys")
        check_stageable(data_type.valueType, f"{where}.value")
    elif isinstance(data_type, T.StructType):
        for field in data_type.fields:
            check_stageable(field.dataType, f"{where}.{field.name}")
    elif not isinstance(data_type, PLAIN_TYPES):
        raise TypeError(f"{where}: {data_type.simpleString()} cannot be staged")


def check_schema(schema: T.StructType) -> None:
    if not schema.fields:
        raise TypeError("a table without columns cannot be staged")
    for field in schema.fields:
        if field.name.startswith(RESERVED):
            raise TypeError(f"{field.name}: names beginning with {RESERVED} are reserved")
        if any(c in field.name for c in "\n\r\0"):
            raise TypeError(f"{field.name!r}: a staged column's name must be on one line")
        check_stageable(field.dataType, field.name)


def write_sidecar(spark: SparkSession, schema: T.StructType, spec: TableSpec, root: str) -> None:
    check_schema(schema)
    write_small_file(spark, f"{root}/{spec.sidecar_path}", schema.json())


def remove_sidecar(spark: SparkSession, spec: TableSpec, root: str) -> None:
    """A table being staged has no sidecar, so a run cut short leaves none that does not belong."""
    delete_path(spark, f"{root}/{spec.sidecar_path}")


def read_sidecar(spark: SparkSession, spec: TableSpec, root: str) -> T.StructType:
    text = spark.read.text(f"{root}/{spec.sidecar_path}", wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))
