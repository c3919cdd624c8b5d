"""Column kinds that table properties declare: vectors, blobs, large strings. They live in field metadata."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from ..errors import InvalidArgument

# Property names after the column's, and the metadata keys that stand for them. A vendor's name may stand
# before "encoding".
VECTOR_PROPERTY = r"\.arrow\.fixed-size-list\.size"
VECTOR_KEY = "arrow.fixed-size-list.size"
BLOB_PROPERTY = r"(?:\.\w+)?\.encoding"
BLOB_KEY = "encoding:blob"
LARGE_PROPERTY = r"\.arrow\.large_var_char"
LARGE_KEY = "arrow:large-var-char"


def _marked(schema: T.StructType, name: str, check, key: str, value) -> T.StructType:
    if name not in schema.names:
        raise InvalidArgument(f"no column {name}")
    fields = []
    for f in schema.fields:
        if f.name == name:
            check(f)
            f = T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, key: value})
        fields.append(f)
    return T.StructType(fields)


def _vector(f: T.StructField) -> None:
    if not isinstance(f.dataType, T.ArrayType):
        raise InvalidArgument(f"{f.name} must be ARRAY to be a vector")
    if not isinstance(f.dataType.elementType, (T.FloatType, T.DoubleType)):
        raise InvalidArgument(f"the elements of vector {f.name} must be FLOAT or DOUBLE")


def _blob(f: T.StructField) -> None:
    if not isinstance(f.dataType, T.BinaryType):
        raise InvalidArgument(f"{f.name} must be BINARY to be a blob")


def _large(f: T.StructField) -> None:
    if not isinstance(f.dataType, T.StringType):
        raise InvalidArgument(f"{f.name} must be STRING to be a large string")


def apply_properties(schema: T.StructType, properties: dict[str, str]) -> T.StructType:
    """``schema`` with the metadata that ``properties`` ask for; vectors first, then blobs, then large strings."""
    for suffix, check, key, wanted in (
        (VECTOR_PROPERTY, _vector, VECTOR_KEY, lambda v: int(v)),
        (BLOB_PROPERTY, _blob, BLOB_KEY, lambda v: True if v.lower() == "blob" else None),
        (LARGE_PROPERTY, _large, LARGE_KEY, lambda v: True if v.lower() == "true" else None),
    ):
        for name, value in properties.items():
            found = re.fullmatch(rf"(.+?){suffix}", name)
            if found and (made := wanted(str(value))) is not None:
                schema = _marked(schema, found[1], check, key, made)
    return schema


def vector_size(field: T.StructField) -> int | None:
    return field.metadata.get(VECTOR_KEY)


def is_blob(field: T.StructField) -> bool:
    return bool(field.metadata.get(BLOB_KEY))


def blob_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if is_blob(f)]


def check_storable(schema: T.StructType) -> None:
    """Raises for types that no table stores, and for a struct with two fields of one name."""
    supported = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.YearMonthIntervalType, T.DayTimeIntervalType, T.NullType)

    def walk(t: T.DataType, where: str) -> None:
        if isinstance(t, T.StructType):
            if len(set(t.names)) != len(t.names):
                raise InvalidArgument(f"{where} has two fields of one name")
            for f in t.fields:
                walk(f.dataType, f"{where}.{f.name}")
        elif isinstance(t, T.ArrayType):
            walk(t.elementType, f"{where}[]")
        elif isinstance(t, T.MapType):
            walk(t.keyType, f"{where} key")
            walk(t.valueType, f"{where} value")
        elif isinstance(t, T.UserDefinedType):
            walk(t.sqlType(), where)
        elif not isinstance(t, supported):
            raise InvalidArgument(f"unsupported data type {t.simpleString()} of {where}")

    walk(schema, "row")
