"""Schemas found in JSON lines, and what is counted of their fields."""

import json

from helpers import rows

from postlark import schemas
from postlark.sources import discovery, readers, writers

LINES = [
    '{"a":1,"b":{"c":[{"d":1.5},{"d":"x","e e":true}]},"n":null,"z":{},"big":123456789012345678901}',
    '{"a":"s","t":"2020-01-01","q\'`\\\\u":1}',
    '{"arr":[[1],[2,3]],"b":null,"f":1e300,"A.b":{"c?d":2}}',
    "broken {",
    "[1,2]",
    "5",
    "",
]


def frame(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value STRING")


def counted(spark, lines):
    found = discovery.field_counts(frame(spark, lines)).collect()
    return {(row.field, row.type): (row.documents, row["values"]) for row in found}


def test_types_are_merged(spark):
    assert discovery.ddl(discovery.found_schema(frame(spark, LINES))) == (
        "`A.b` STRUCT<`c?d`: BIGINT>, `a` STRING, `arr` ARRAY<ARRAY<BIGINT>>, "
        "`b` STRUCT<`c`: ARRAY<STRUCT<`d`: STRING, `e e`: BOOLEAN>>>, `big` DECIMAL(38,0), "
        "`f` DOUBLE, `n` STRING, `q'``\\u` BIGINT, `t` STRING, `z` STRING"
    )


def test_counts(spark):
    found = counted(spark, LINES)
    assert found["$", "object"] == (3, 3)
    assert found["$", "broken"] == found["$", "array"] == found["$", "bigint"] == (1, 1)
    assert found["a", "bigint"] == found["a", "string"] == (1, 1)
    assert found["b", "object"] == found["b", "null"] == (1, 1)
    assert found["b.c[]", "object"] == (1, 2)
    assert found["b.c[].e e", "boolean"] == (1, 1)
    assert found["arr[]", "array"] == (1, 2)
    assert found["arr[][]", "bigint"] == (1, 3)
    assert found["q'`\\u", "bigint"] == found["A.b.c?d", "bigint"] == (1, 1)


def test_counts_of_files_add_up(spark):
    parts = [discovery.field_counts(frame(spark, lines)) for lines in (LINES[:2], LINES[2:])]
    merged = discovery.merged_counts(parts[0].unionByName(parts[1]))
    whole = discovery.field_counts(frame(spark, LINES))
    # A field of two types is looked into where a file has one of them only.
    def of(counts):
        return {tuple(row) for row in counts.collect()}

    assert of(whole) <= of(merged)


def test_nothing_to_find(spark):
    for lines in ([], [""], ["broken"], ["[1]"]):
        assert discovery.ddl(discovery.found_schema(frame(spark, lines))) == ""
    assert counted(spark, []) == counted(spark, [""]) == {}
    assert counted(spark, ["x", "y"]) == {("$", "broken"): (2, 2)}


def test_conversion_with_the_found_schema(spark, tmp_path):
    """Files with different fields: every value is in its column, whatever file it came from."""
    source = tmp_path / "feed"
    source.mkdir()
    documents = [
        {"data": {"id": "1", "odd name": [1, 2]}},
        {"data": {"id": "2", "more": {"x": 1.5}}, "batch": 7},
        {"data": {"id": "3", "more": {"x": 2}}, "batch": "b"},
    ]
    for n, document in enumerate(documents):
        (source / f"part-{n}.json").write_text(json.dumps(document) + "\nbroken\n")
    target = str(tmp_path / "out")
    schema = discovery.read_schema(spark, str(source))
    writers.json_to_parquet(spark, str(source), target, schema)
    read = spark.read.parquet(target)
    found = read.where("data IS NOT NULL").select(
        "data.id", "data.`odd name`", "data.more.x", "batch"
    )
    assert sorted(rows(found), key=str) == [
        ("1", [1, 2], None, None), ("2", None, 1.5, "7"), ("3", None, 2.0, "b")
    ]
    assert read.where(f"{schemas.CORRUPT_RECORD} = 'broken'").count() == 3
    assert readers.read_documents(spark, str(source), schema).count() == 6


def test_elements_of_an_array_are_made_once_for_all_fields(spark):
    lines = ['{"a": [{"b": 1, "c": "x", "d": null}, {"b": 2}]}', '{"a": null}', "[1]", "3", "{", "null"]
    counts = discovery.field_counts(spark.createDataFrame([(x,) for x in lines], "value STRING"))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("flatten(") == 1
    assert sorted(map(tuple, counts.collect())) == [
        ("$", "array", 1, 1),
        ("$", "bigint", 1, 1),
        ("$", "broken", 1, 1),
        ("$", "null", 1, 1),
        ("$", "object", 2, 2),
        ("a", "array", 1, 1),
        ("a", "null", 1, 1),
        ("a[]", "object", 1, 2),
        ("a[].b", "bigint", 1, 2),
        ("a[].c", "string", 1, 1),
        ("a[].d", "null", 1, 1),
    ]
