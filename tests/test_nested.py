from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from starsmelt.operators.nested import (
    explode_bridge,
    explode_dimension,
    parse_json_columns,
    struct_dimension,
)
from starsmelt.schemas import DECODED_COLUMNS, NESTED_FIELDS
from starsmelt.sources import encode_nested

PAIRS = "array<struct<id:bigint,name:string>>"


@pytest.mark.parametrize("text, expected", [
    ('[{"id":1,"name":"a","x":9}]', [(1, "a")]),
    ('{"id":2,"name":"b"}', [(2, "b")]),
    ("[", None),
    ("[]", []),
    ("null", None),
    (None, None),
    ('[{"id":"7","name":5},null]', [(None, "5"), None]),
    ('[{"id":1.5}]', [(None, None)]),
])
def test_decode(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id bigint, j string")
    found = parse_json_columns(df, {"j": ("p", PAIRS)}).first()["p"]
    if expected is not None:
        expected = [None if item is None else tuple(item) for item in expected]
        found = [None if item is None else tuple(item) for item in found]
    assert found == expected


def test_text_columns_are_replaced(spark):
    df = spark.createDataFrame([(1, "{}")], "id bigint, j string")
    assert parse_json_columns(df, {"j": ("p", "struct<k:bigint>")}).columns == ["id", "p"]


SAMPLES = {
    "genres": [{"id": 1, "name": "a"}, {"id": 2, "name": None}],
    "platforms": [{"platform": {"id": 1, "name": 'quote " and \\ and ü'}}],
    "parent_platforms": [],
    "stores": [{"store": None}, {"store": {"id": 3, "name": ""}}],
    "tags": [{"id": 2**60, "name": "n/a", "language": "eng"}, None],
    "ratings": [{"id": 1, "title": "t", "count": 3, "percent": 100 / 3}],
    "added_by_status": {"yet": 1, "owned": None, "beaten": 3, "toplay": 4, "dropped": 5, "playing": 6},
    "esrb_rating": None,
}


@pytest.mark.parametrize("field", list(NESTED_FIELDS))
def test_encode_then_decode_is_identity(spark, field):
    schema = NESTED_FIELDS[field]
    typed = spark.createDataFrame([(json.dumps(SAMPLES[field]),), (None,)], "t string").select(
        F.from_json("t", schema).alias(field))
    encoded = encode_nested(typed, [field])
    assert dict(encoded.dtypes) == {field: "string"}
    target, _ = DECODED_COLUMNS[field]
    decoded = parse_json_columns(encoded, {field: DECODED_COLUMNS[field]})
    assert [r[target] for r in decoded.collect()] == [r[field] for r in typed.collect()]


def test_null_members_are_written(spark):
    typed = spark.sql("SELECT named_struct('id', 1L, 'name', CAST(NULL AS STRING)) AS s")
    assert encode_nested(typed, ["s"]).first()["s"] == '{"id":1,"name":null}'


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, [(1, "a"), (1, "a"), (2, "b")]), (2, [(1, "other"), (None, "lost"), None]), (3, []),
        (4, None), (None, [(9, None)]),
    ]
    return spark.createDataFrame(rows, "id bigint, e array<struct<id:bigint,name:string>>")


def test_dimension_is_distinct_on_all_outputs(items):
    dim = explode_dimension(items, "e", {"eid": "id", "ename": "name"}, "eid")
    assert sorted(map(tuple, dim.collect()), key=repr) == [
        (1, "a"), (1, "other"), (2, "b"), (9, None)]


def test_bridge_keeps_repeats_and_drops_unknown_ids(items):
    expected = sorted([(1, 1), (1, 1), (1, 2), (2, 1), (None, 9)], key=repr)
    narrow = explode_bridge(items, ("id", "item"), "e", {"eid": "id"}, "eid")
    wide = explode_bridge(items, ("id", "item"), "e", {"eid": "id", "ename": "name"}, "eid")
    assert narrow.columns == ["item", "eid"] and wide.columns == ["item", "eid", "ename"]
    assert sorted(map(tuple, narrow.collect()), key=repr) == expected
    assert sorted((tuple(row)[:2] for row in wide.collect()), key=repr) == expected


def test_bridge_through_two_levels(spark):
    df = spark.createDataFrame([(1, '[{"store":{"id":5,"name":"s"}},{"store":null},null]')],
                               "id bigint, stores string")
    parsed = parse_json_columns(df, {"stores": ("_s", NESTED_FIELDS["stores"])})
    bridge = explode_bridge(parsed, ("id", "item"), "_s", {"sid": "store.id"}, "sid")
    assert list(map(tuple, bridge.collect())) == [(1, 5)]


def test_struct_dimension(spark):
    df = spark.sql("SELECT * FROM VALUES (named_struct('id', 1L, 'name', 'T')), "
                   "(named_struct('id', 1L, 'name', 'T')), (NULL) AS t(s)")
    dim = struct_dimension(df, "s", {"rid": "id", "rname": "name"}, "rid")
    assert list(map(tuple, dim.collect())) == [(1, "T")]
