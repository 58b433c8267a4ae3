"""Record types from schema text, and the projection that shapes rows into them.

A schema is the JSON text of an Avro record. It becomes a struct type whose fields carry, as metadata, what a struct
type has no place for: aliases, defaults and the symbols of an enumeration.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the format calls its types.
PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
LOGICAL = {
    ("int", "date"): T.DateType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("long", "local-timestamp-millis"): T.TimestampNTZType(),
    ("long", "local-timestamp-micros"): T.TimestampNTZType(),
}
# Unions of two numbers that one type holds.
WIDER = {frozenset(("int", "long")): "long", frozenset(("float", "double")): "double"}


def record_type(schema: str) -> T.StructType:
    """The struct type of a record schema; a schema that is no record, or holds itself, is an error."""
    kind, nullable, _ = _Names().compiled(json.loads(schema), "")
    if not isinstance(kind, T.StructType) or nullable:
        raise ValueError("a record's schema must be of type record")
    return kind


class _Names:
    """The named types of one schema, each known from where it is defined on."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[T.DataType, dict] | None] = {}

    def compiled(self, schema: Any, space: str) -> tuple[T.DataType, bool, dict]:
        """Type, whether it may be null, and metadata."""
        if isinstance(schema, list):
            return self._union(schema, space)
        if isinstance(schema, str):
            if schema in PRIMITIVES:
                return PRIMITIVES[schema], False, {}
            return *self._named(schema, space), {}
        kind = schema["type"]
        if isinstance(kind, (dict, list)):
            return self.compiled(kind, space)
        if kind == "array":
            items, nullable, _ = self.compiled(schema["items"], space)
            return T.ArrayType(items, nullable), False, {}
        if kind == "map":
            values, nullable, _ = self.compiled(schema["values"], space)
            return T.MapType(T.StringType(), values, nullable), False, {}
        if schema.get("logicalType") == "decimal" and kind in ("bytes", "fixed"):
            return T.DecimalType(schema["precision"], schema.get("scale", 0)), False, {}
        if kind in ("record", "enum", "fixed"):
            return self._definition(schema, kind, space)
        if (logical := LOGICAL.get((kind, schema.get("logicalType")))) is not None:
            return logical, False, {}
        return self.compiled(kind, space)

    def _named(self, name: str, space: str) -> tuple[T.DataType, bool]:
        full = name if "." in name or not space else f"{space}.{name}"
        for candidate in (full, name):
            if candidate in self.known:
                if self.known[candidate] is None:
                    raise ValueError(f"{candidate} holds itself, which no struct type can")
                return self.known[candidate], False
        raise ValueError(f"unknown type {name!r}")

    def _definition(self, schema: dict, kind: str, space: str) -> tuple[T.DataType, bool, dict]:
        name = schema["name"]
        space = name.rpartition(".")[0] or schema.get("namespace", space)
        full = f"{space}.{name.rpartition('.')[2]}".lstrip(".")
        if kind == "fixed":
            made, more = T.BinaryType(), {}
        elif kind == "enum":
            made, more = T.StringType(), {"symbols": schema["symbols"]}
        else:
            self.known[full] = None
            made, more = T.StructType([self._field(f, space) for f in schema["fields"]]), {}
        self.known[full] = made
        return made, False, more

    def _field(self, field: dict, space: str) -> T.StructField:
        kind, nullable, more = self.compiled(field["type"], space)
        if "aliases" in field:
            more = more | {"aliases": field["aliases"]}
        if "default" in field:
            more = more | {"default": json.dumps(field["default"])}
        return T.StructField(field["name"], kind, nullable, more)

    def _union(self, branches: list, space: str) -> tuple[T.DataType, bool, dict]:
        rest = [b for b in branches if b != "null"]
        nullable = len(rest) < len(branches)
        if len(rest) == 1:
            kind, _, more = self.compiled(rest[0], space)
            return kind, nullable, more
        if all(isinstance(b, str) for b in rest) and (wider := WIDER.get(frozenset(rest))):
            return PRIMITIVES[wider], nullable, {}
        members = [T.StructField(f"member{k}", self.compiled(b, space)[0], True) for k, b in enumerate(rest)]
        return T.StructType(members), nullable, {}


def shaped(available: T.StructType, record: T.StructType, sources: Mapping[str, str] | None = None) -> list[Column]:
    """One column for each field of the record, taken from the columns available.

    A field is filled from the column that ``sources`` names, from the column of its own name, or from one of an alias.
    Without any, its default holds, or null where it may be null; else the record cannot be made, which is an error here
    and not in a task. A value that the field's type cannot hold whole, a null that it must not be, and a symbol that its
    enumeration lacks each fail the job.
    """
    sources = sources or {}
    if unknown := set(sources) - set(record.names):
        raise ValueError(f"the schema has no field {sorted(unknown)}")
    return [_filled(field, available, sources, None).alias(field.name) for field in record.fields]


def _filled(field: T.StructField, available: T.StructType, sources: Mapping[str, str], parent: Column | None) -> Column:
    names = [sources[field.name]] if field.name in sources else [field.name, *field.metadata.get("aliases", [])]
    for name in names:
        if name in available.names:
            value = F.col(f"`{name}`") if parent is None else parent.getField(name)
            return _whole(value, available[name].dataType, field.dataType, field)
    if field.name in sources:
        raise ValueError(f"no column {sources[field.name]!r} for the field {field.name!r}")
    if (default := json.loads(field.metadata.get("default", "null"))) is not None:
        return _literal(default, field.dataType)
    if field.nullable:
        return F.lit(None).cast(field.dataType)
    raise ValueError(f"no column fills the field {field.name!r}, and it has no default")


def _literal(default: Any, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(F.lit(json.dumps(default)), kind)
    if isinstance(kind, T.BinaryType):
        return F.lit(bytes(default, "latin-1"))
    if isinstance(kind, T.TimestampType):
        raise ValueError("a default of a timestamp is not supported")
    return F.lit(default).cast(kind)


def _whole(value: Column, given: T.DataType, wanted: T.DataType, field: T.StructField) -> Column:
    """The value in the wanted type, or an error raised by the task that meets it."""

    def failing(why: str) -> Column:
        return F.raise_error(F.lit(f"{field.name}: {why}")).cast(wanted)

    if isinstance(wanted, T.StructType) and isinstance(given, T.StructType):
        made = F.struct(*(_filled(f, given, {}, value).alias(f.name) for f in wanted.fields))
        out = F.when(value.isNotNull(), made)
    elif isinstance(wanted, T.ArrayType) and isinstance(given, T.ArrayType):
        item = T.StructField(field.name, wanted.elementType, wanted.containsNull)
        out = F.transform(value, lambda v: _whole(v, given.elementType, wanted.elementType, item))
    elif isinstance(wanted, T.MapType) and isinstance(given, T.MapType):
        item = T.StructField(field.name, wanted.valueType, wanted.valueContainsNull)
        out = F.transform_values(value, lambda _, v: _whole(v, given.valueType, wanted.valueType, item))
    elif given == wanted:
        out = value
    else:
        cast = value.try_cast(wanted)
        lossy = cast.isNull()
        if isinstance(given, (T.FractionalType, T.DecimalType)) and isinstance(wanted, T.IntegralType):
            lossy = lossy | (cast.cast(given) != value)
        out = F.when(value.isNotNull() & lossy, failing(f"a value that {wanted.simpleString()} cannot hold")).otherwise(cast)
    if symbols := field.metadata.get("symbols"):
        out = F.when(out.isNull() | out.isin(symbols), out).otherwise(failing("a symbol that the schema does not list"))
    return out if field.nullable else F.coalesce(out, failing("null in a field that must not be"))
