"""Rescue through nested JSON and schemas that grow inside a run: nothing that lands is lost."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.sources import commits, evolve, landing
from stratiform.sources.commits import Position
from stratiform.streaming import ingest

DDL = "a int, s string, b struct<c: double, d: array<int>, e: struct<f: boolean>>, m map<string, bigint>, l array<struct<q: int, w: date>>, n decimal(6,2)"


def anything(rng, deep=2):
    made = rng.choice(["int", "big", "text", "bool", "none", "float", "list", "object"][: 8 if deep else 6])
    if made == "list":
        return [anything(rng, deep - 1) for _ in range(rng.randrange(3))]
    if made == "object":
        return {rng.choice("abcqf?\"é'"): anything(rng, deep - 1) for _ in range(rng.randrange(3))}
    return {"int": rng.randrange(-9, 99), "big": 99999999999999, "text": rng.choice(["", "x", "12", "2024-01-31", "é\"'"]), "bool": rng.random() < 0.5, "none": None, "float": 1.25}[made]


def value(rng, dtype):
    """A value of the type, or anything."""
    if rng.random() < 0.25:
        return anything(rng)
    if isinstance(dtype, T.StructType):
        known = {f.name: value(rng, f.dataType) for f in dtype if rng.random() < 0.8}
        return known | ({"extra": anything(rng)} if rng.random() < 0.2 else {})
    if isinstance(dtype, T.ArrayType):
        return [value(rng, dtype.elementType) for _ in range(rng.randrange(4))]
    if isinstance(dtype, T.MapType):
        return {k: value(rng, dtype.valueType) for k in rng.sample("xyz", rng.randrange(3))}
    return {"int": 7, "bigint": 2**40, "string": "text", "double": 2.5, "boolean": True, "date": "2024-02-29"}.get(dtype.simpleString(), 12.5)


def told(sent, dtype):
    """The input as far as a table can tell it: JSON null is no value, and a text column holds other values as text."""
    if isinstance(dtype, T.StructType) and isinstance(sent, dict):
        types = {f.name: f.dataType for f in dtype}
        return {k: told(v, types.get(k)) for k, v in sent.items() if v is not None}
    if isinstance(dtype, T.ArrayType) and isinstance(sent, list):
        return [told(v, dtype.elementType) for v in sent]
    if isinstance(dtype, T.MapType) and isinstance(sent, dict):
        return {k: told(v, dtype.valueType) for k, v in sent.items() if v is not None}
    return json.dumps(sent, separators=(",", ":"), ensure_ascii=False, sort_keys=True) if isinstance(dtype, T.StringType) and sent is not None and not isinstance(sent, str) else sent


def together(read, lost, dtype):
    """Typed and rescued parts put together."""
    if read is None:
        return lost
    if isinstance(dtype, T.ArrayType):
        return [together(v, (lost or {}).get(str(i)), dtype.elementType) for i, v in enumerate(read)]
    if not isinstance(dtype, (T.StructType, T.MapType)):
        return read
    types = {f.name: f.dataType for f in dtype} if isinstance(dtype, T.StructType) else defaultdict(lambda: dtype.valueType)
    merged = {k: together(read.get(k), (lost or {}).get(k), types[k] if k in read else None) for k in {*read, *(lost or {})}}
    return {k: v for k, v in merged.items() if v is not None}


@pytest.mark.parametrize("seed", range(3))
def test_typed_and_rescued_parts_are_the_input(spark, seed):
    rng, schema = random.Random(seed), T.StructType.fromDDL(DDL)
    sent = [{f.name: value(rng, f.dataType) for f in schema if rng.random() < 0.9} | ({"more": anything(rng)} if rng.random() < 0.3 else {}) for _ in range(400)]
    df = spark.createDataFrame([(n, json.dumps(x, ensure_ascii=False)) for n, x in enumerate(sent)], "i int, t string")
    read = landing.with_rescued_nested(df, "t", schema).select("i", F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"}).alias("typed"), "_rescued_data").collect()
    assert len(read) == len(sent)
    for r in read:
        got = together(json.loads(r["typed"]), json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}, schema)
        assert got == told(sent[r["i"]], schema), (sent[r["i"]], r)


def test_text_that_is_no_object_is_rescued_whole(spark):
    texts = ["[1]", "7", "nope", '{"a": 1, "a": 2}', "null", '{"a": 1}', None]
    df = spark.createDataFrame([(t, "kept") for t in texts], "t string, `x.y` string")
    read = landing.with_rescued_nested(df, "t", T.StructType.fromDDL("a int")).collect()
    assert [r["a"] for r in read] == [None] * 5 + [1, None] and [r["x.y"] for r in read] == ["kept"] * 7
    assert [json.loads(r["_rescued_data"])["_corrupt_record"] for r in read[:5]] == texts[:5] and read[5]["_rescued_data"] is read[6]["_rescued_data"] is None


def test_types_of_variants():
    found = evolve._TYPE_WORDS.findall("OBJECT<`OBJECT`: OBJECT<a: DECIMAL(3,1)>, v: VARIANT>")
    assert found == ["OBJECT", "`OBJECT`", "OBJECT", "DECIMAL(3,1)", "VARIANT"]


def test_schemas_merge_at_any_depth(spark):
    stored = T.StructType.fromDDL("a bigint, b struct<c: string, d: array<struct<e: int>>>, m map<string, bigint>, n decimal(5,2), s string, t timestamp")
    found = evolve.of_variants("OBJECT<a: STRING, b: OBJECT<c: BIGINT, d: ARRAY<OBJECT<e: BIGINT, f: BOOLEAN>>, g: DECIMAL(2,1)>, m: OBJECT<x: BIGINT, y: STRING>, n: BIGINT, new: VARIANT, none: VOID, s: BIGINT, t: STRING>")
    schema, conflicts = evolve.evolved(stored, found)
    assert conflicts == ["a", "m.y"]  # every whole number is found as a bigint
    assert schema.simpleString() == "struct<a:bigint,b:struct<c:string,d:array<struct<e:int,f:boolean>>,g:double>,m:map<string,bigint>,n:decimal(5,2),s:string,t:timestamp,new:string>"
    assert evolve.of_variants(None) == evolve.of_variants("BIGINT") == T.StructType()


def drop_lines(folder, name, rows):
    with open(f"{folder}/in/{name}", "w") as file:
        file.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def test_a_schema_grows_in_the_run_and_conflicts_are_kept(spark, folder, rows_of, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: ingest.ingest_commits(spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", "src", "ent")
    drop_lines(folder, "1.json", [{"id": 1, "v": {"x": 1}}, {"id": 2}, "", "broken"])
    assert run().schema.simpleString() == "struct<id:bigint,v:struct<x:bigint>>"
    drop_lines(folder, "2.json", [{"id": "three", "v": {"x": "one", "y": 2.5}}, {"id": 4, "w": None, "z": [1]}])
    found = run()
    assert found.conflicts == ["id", "v.x"] and found.schema.simpleString() == "struct<id:bigint,v:struct<x:bigint,y:double>,z:array<bigint>>"
    assert run().schema == found.schema  # nothing new, nothing changes
    rows = commits.read_after(spark, f"{folder}/b")
    assert rows_of(rows, "id", "v.x", "v.y", "z", "_rescued_data", "_commit") == sorted([
        (1, 1, None, None, None, 0), (2, None, None, None, None, 0), (None, None, None, None, '{"_corrupt_record":"broken"}', 0),
        (None, None, 2.5, None, '{"id":"three","v":{"x":"one"}}', 1), (4, None, None, [1], None, 1)], key=repr)
    assert commits.positions(spark, f"{folder}/b") == [Position(0, 0), Position(0, 1)]


def test_a_run_reads_no_old_file(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    drop_lines(folder, "1.json", [{"id": 1}])
    ingest.ingest_commits(spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", "src", "ent")
    drop_lines(folder, "2.json", [{"id": 2, "n": 1}])
    drop_lines(folder, "1.json", ["\x00 changed, which a reader of it would see"])
    assert ingest.ingest_commits(spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", "src", "ent").schema.names == ["id", "n"]
    assert [r["n"] for r in commits.read_after(spark, f"{folder}/b", Position(0, 0)).filter("id = 2").collect()] == [1]


def test_a_declared_start_and_caps(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        drop_lines(folder, f"{n}.json", [{"id": n, "d": "2024-01-0" + str(n + 1)}])
    start = T.StructType.fromDDL("id int, d date")
    found = ingest.ingest_commits(spark, f"{folder}/in", f"{folder}/b", f"{folder}/cp", "src", "ent", start, generation=2, max_files=1)
    assert found.schema == start and found.conflicts == [] and commits.positions(spark, f"{folder}/b") == [Position(2, n) for n in range(3)]
    assert commits.read_after(spark, f"{folder}/b").filter("d IS NOT NULL").count() == 3
