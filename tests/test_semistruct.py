"""Flattening of variants: kinds, missing values, any depth."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.semistruct import flatten_nested, flatten_variant

DOCUMENTS = [
    (1, '{"a": {"b": [1, {"c": 2}], "d": null}, "e": []}'), (2, "[[3], 4]"), (3, "5"), (4, "null"), (5, None), (6, "{}"),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(DOCUMENTS, "id int, text string").select("id", F.parse_json("text").alias("v"))


def test_every_depth(documents):
    found = {(r.id, r.path, r.key, r["index"]) for r in flatten_nested(documents, "v", ["id"]).collect()}
    assert found == {
        (1, "a", "a", None), (1, "e", "e", None), (1, "a.b", "b", None), (1, "a.d", "d", None), (1, "a.b[0]", None, 0),
        (1, "a.b[1]", None, 1), (1, "a.b[1].c", "c", None), (2, "[0]", None, 0), (2, "[1]", None, 1), (2, "[0][0]", None, 0)}


def test_only_arrays_or_objects(documents):
    paths = lambda mode: {(r.id, r.path) for r in flatten_nested(documents, "v", ["id"], mode).collect()}
    assert paths("array") == {(2, "[0]"), (2, "[1]"), (2, "[0][0]")}
    assert paths("object") == {(1, "a"), (1, "e"), (1, "a.b"), (1, "a.d")}


def test_nothing_to_open(documents):
    assert flatten_nested(documents.where("id > 2"), "v", ["id"]).count() == 0
    assert flatten_nested(documents.where("id > 9"), "v", ["id"]).count() == 0


def test_one_level(documents):
    rows = lambda **how: sorted((r.id, r.key or "", -1 if r["index"] is None else r["index"]) for r in flatten_variant(documents, "v", "", ["id"], **how).collect())
    assert rows() == [(1, "a", 0), (1, "e", 1), (2, "", 0), (2, "", 1)]
    assert rows(mode="array") == [(2, "", 0), (2, "", 1)]
    assert rows(mode="object", outer=True) == [(1, "a", 0), (1, "e", 1)] + [(i, "", -1) for i in range(2, 7)]
