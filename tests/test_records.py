"""Schema text compiled to record types, rows shaped by them, and landed by batches and streams."""

import json
import os

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.record_schema import record_type, shaped
from millrace.sinks.files import UNTIL_CAUGHT_UP
from millrace.streaming import records

REGISTRY = "schema_id int, schema string"


def record(*fields, name="R", **more):
    return json.dumps({"type": "record", "name": name, "fields": list(fields), **more})


def field(name, kind, **more):
    return {"name": name, "type": kind, **more}


SMALL = record(field("n", "int"))
WIDE = record(field("n", "long"), field("tags", {"type": "array", "items": "string"}, default=[]), field("gap", ["null", "double"]))


@pytest.mark.parametrize(
    "kind, expected",
    [
        ("boolean", "boolean"), ("int", "int"), ("long", "bigint"), ("float", "float"), ("double", "double"),
        ("bytes", "binary"), ("string", "string"),
        (["null", "long"], "bigint"), (["int", "long"], "bigint"), (["float", "null", "double"], "double"),
        (["null", "string", "int"], "struct<member0:string,member1:int>"),
        ({"type": "int", "logicalType": "date"}, "date"),
        ({"type": "long", "logicalType": "timestamp-millis"}, "timestamp"),
        ({"type": "long", "logicalType": "local-timestamp-micros"}, "timestamp_ntz"),
        ({"type": "long", "logicalType": "unheard-of"}, "bigint"),
        ({"type": "string", "logicalType": "uuid"}, "string"),
        ({"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 3}, "decimal(20,3)"),
        ({"type": "fixed", "name": "Id", "size": 16}, "binary"),
        ({"type": "enum", "name": "Side", "symbols": ["left", "right"]}, "string"),
        ({"type": "map", "values": ["null", "int"]}, "map<string,int>"),
        ({"type": "array", "items": {"type": "record", "name": "P", "fields": [field("x", "int")]}}, "array<struct<x:int>>"),
    ],
)
def test_types(kind, expected):
    assert record_type(record(field("f", kind)))["f"].dataType.simpleString() == expected


def test_names_are_known_from_their_definition_on():
    point = {"type": "record", "name": "Point", "fields": [field("x", "int")]}
    made = record_type(record(field("a", point), field("b", "Point"), field("c", ["null", "geo.Point"]), namespace="geo"))
    assert made["a"].dataType == made["b"].dataType == made["c"].dataType and made["c"].nullable and not made["b"].nullable
    with pytest.raises(ValueError, match="holds itself"):
        record_type(record(field("next", ["null", "R"])))
    with pytest.raises(ValueError, match="unknown type"):
        record_type(record(field("a", "Point"), field("b", point)))
    with pytest.raises(ValueError, match="must be of type record"):
        record_type('{"type": "array", "items": "int"}')


def shape(df, schema, **sources):
    return df.select(*shaped(df.schema, record_type(schema), sources))


def test_fields_are_filled_by_source_name_alias_and_default(spark):
    df = spark.createDataFrame([(7, "x", [1, 2], (3, "in"))], "id long, old string, xs array<long>, s struct<a:long,b:string>")
    schema = record(
        field("n", "int"), field("new", "string", aliases=["older", "old"]), field("d", "double", default=0.5),
        field("xs", {"type": "array", "items": "int"}), field("m", {"type": "map", "values": "int"}, default={"k": 1}),
        field("s", {"type": "record", "name": "S", "fields": [field("b", "string"), field("c", ["null", "int"])]}),
    )
    row = shape(df, schema, n="id").first()
    assert row == T.Row(n=7, new="x", d=0.5, xs=[1, 2], m={"k": 1}, s=T.Row(b="in", c=None))
    assert shape(df, schema, n="id").schema.simpleString().startswith("struct<n:int,new:string,d:double,xs:array<int>")
    for wrong in ({"n": "absent"}, {"nowhere": "id"}, {}):
        with pytest.raises(ValueError):
            shape(df, schema, **wrong)


@pytest.mark.parametrize(
    "value, of, kind",
    [
        (2**31, "long", "int"), (1.5, "double", "long"), ("x", "string", "int"), (None, "long", "long"),
        ("up", "string", {"type": "enum", "name": "E", "symbols": ["down"]}), ([None], "array<int>", {"type": "array", "items": "int"}),
    ],
)
def test_values_that_do_not_fit_fail_the_job(spark, value, of, kind):
    df = spark.createDataFrame([(value,)], f"f {of}")
    with pytest.raises(PySparkException, match="f: "):
        shape(df, record(field("f", kind))).collect()


def test_each_schema_has_its_own_layout(spark, tmp_path):
    path = str(tmp_path / "out")
    elements = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 4).cast("int").alias("schema_id")).repartition(5)
    registry = spark.createDataFrame([(0, SMALL), (1, WIDE), (2, SMALL), (3, WIDE), (9, "not read")], REGISTRY)
    records.land_records(elements, registry, path)
    assert spark.read.parquet(f"{path}/p_schema_id=0").schema.simpleString() == "struct<n:int>"
    assert spark.read.parquet(f"{path}/p_schema_id=1").schema.simpleString() == "struct<n:bigint,tags:array<string>,gap:double>"
    for schema_id, text in ((0, SMALL), (1, WIDE), (2, SMALL), (3, WIDE)):
        got = records.read_records(spark, path, schema_id, text)
        assert sorted(r.n for r in got.collect()) == list(range(schema_id, 100, 4))
        assert len([f for f in os.listdir(f"{path}/p_schema_id={schema_id}") if f.startswith("part-")]) == 1
    with pytest.raises(FileExistsError):
        records.land_records(elements, registry, path)


@pytest.mark.parametrize(
    "entries, why",
    [([(0, SMALL)], "no schema for schema_id 1"), ([(0, SMALL), (1, SMALL), (1, WIDE)], "more than once"), ([(0, SMALL), (1, record(field("z", "int")))], "no column fills")],
)
def test_a_registry_that_does_not_do_leaves_nothing(spark, tmp_path, entries, why):
    elements = spark.createDataFrame([(1, 0), (2, 1)], "n int, schema_id int")
    with pytest.raises((PySparkException, ValueError), match=why):
        records.land_records(elements, spark.createDataFrame(entries, REGISTRY), str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out")


def stream(spark, tmp_path):
    return spark.readStream.schema("n long, schema_id int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def arrive(spark, tmp_path, first, last, ids):
    rows = spark.range(first, last).select(F.col("id").alias("n"), (F.col("id") % ids).cast("int").alias("schema_id"))
    rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_registry_grows_between_two_batches_of_one_run(spark, tmp_path):
    arrive(spark, tmp_path, 0, 10, 1)
    arrive(spark, tmp_path, 10, 30, 2)
    asked = []

    def registry(session):
        asked.append(1)
        return session.createDataFrame([(0, SMALL), (1, WIDE)][: len(asked)], REGISTRY)

    query = records.land_records(stream(spark, tmp_path), registry, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), trigger=UNTIL_CAUGHT_UP)
    query.awaitTermination()
    assert len(asked) == 2
    assert sorted(r.n for r in records.read_records(spark, str(tmp_path / "out"), 0, SMALL).collect()) == [*range(10), *range(10, 30, 2)]
    assert sorted(r.n for r in records.read_records(spark, str(tmp_path / "out"), 1, WIDE).collect()) == list(range(11, 30, 2))


def test_repeated_ids_fail_the_batch_that_meets_them(spark, tmp_path):
    for first in (0, 10):
        arrive(spark, tmp_path, first, first + 10, 1)
    entries = [(0, SMALL)]

    def registry(session):
        entries.append((0, WIDE))
        return session.createDataFrame(entries[:-1], REGISTRY)

    query = records.land_records(stream(spark, tmp_path), registry, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), trigger=UNTIL_CAUGHT_UP)
    with pytest.raises(StreamingQueryException, match="more than once"):
        query.awaitTermination()
    assert records.read_records(spark, str(tmp_path / "out"), 0, SMALL).count() == 10


def test_a_batch_that_is_repeated_replaces_itself_with_the_schemas_it_had(spark, tmp_path):
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    batch = spark.range(20).select(F.col("id").alias("n"), F.lit(0).alias("schema_id"))
    for text in (SMALL, WIDE):
        used = records.snapshot(batch, lambda s, text=text: s.createDataFrame([(0, text)], REGISTRY), state)
        records._write_each(batch, used, path, "schema_id", "schema", None, "parquet", 1, 3)
    landed = spark.read.parquet(f"{path}/p_schema_id=0")
    assert landed.columns == ["n", "batch_id"] and landed.count() == 20 and landed.schema["n"].dataType == T.IntegerType()
