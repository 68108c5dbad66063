"""Nested texts: only those nested deeper than usual take part in the recursion."""

import json

from mapsheaf.operators import inspector


def nested(depth, leaf="x"):
    value = leaf
    for n in range(depth):
        value = {"k": value} if n % 2 else [value]
    return json.dumps(value)


def walked(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    return {r.id: (r.path.count(".") + 1, r.text) for r in inspector.property_walk(frame).collect()}


def test_texts_of_some_levels_need_no_recursion(spark, monkeypatch):
    monkeypatch.setattr(inspector, "WALK_ROUNDS", 1)
    assert walked(spark, nested(3), nested(inspector.TREE_DEPTH)) == {0: (3, "x"), 1: (inspector.TREE_DEPTH, "x")}


def test_deeper_texts_are_followed_to_the_end_however_brackets_are_written(spark):
    depth = inspector.TREE_DEPTH + 1
    escaped = nested(depth)
    for _ in range(2):
        escaped = json.dumps([escaped])
    coded = json.dumps([nested(depth).replace("{", "@").replace("[", "!")]).replace("@", "\\u007b").replace("!", "\\u005b")
    assert walked(spark, nested(depth), nested(depth + 6), escaped, coded) == {
        0: (depth, "x"), 1: (depth + 6, "x"), 2: (depth + 2, "x"), 3: (depth + 1, "x")}
