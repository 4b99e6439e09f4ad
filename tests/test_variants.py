"""Compiled shape checks against those that walk each value in Python."""

import json
import random

from pyspark.sql import functions as F

from corpusloom.functions import jsontext, variants
from corpusloom.plans.catalog import QUERIES

NAMES = ["a", "b", "we.ird", "q'uote", "sp ace"]


def any_schema(draw, depth):
    kind = draw.choice(["object", "array", "string", "boolean", "integer", "number", None][: 7 if depth else 7])
    if depth == 0 and kind in ("object", "array"):
        kind = "string"
    out = {} if kind is None else {"type": kind}
    if kind == "object":
        known = draw.sample(NAMES, draw.randrange(4))
        out |= {"properties": {k: any_schema(draw, depth - 1) for k in known}, "required": draw.sample(NAMES, draw.randrange(3))}
        if draw.random() < 0.5:
            out["additionalProperties"] = False
    elif kind == "array" and draw.random() < 0.8:
        out["items"] = any_schema(draw, depth - 1)
    elif kind in ("string", "integer") and draw.random() < 0.5:
        out["enum"] = ["x", "y", None] if kind == "string" else [1, 2, 10**20]
    return out


def any_value(draw, depth):
    kind = draw.randrange(9 if depth else 7)
    if kind == 7:
        return {k: any_value(draw, depth - 1) for k in draw.sample(NAMES, draw.randrange(4))}
    if kind == 8:
        return [any_value(draw, depth - 1) for _ in range(draw.randrange(4))]
    return [None, True, False, draw.randrange(4), 10**20, 1.5, draw.choice("xyz")][kind]


def fitting(draw, schema):
    """A value that has the schema's shape, or nearly."""
    kind = schema.get("type")
    if draw.random() < 0.1 or kind not in ("object", "array", "string", "boolean", "integer"):
        return any_value(draw, 1)
    if kind == "object":
        names = {*schema["required"], *(k for k in schema["properties"] if draw.random() < 0.7)}
        return {k: fitting(draw, schema["properties"].get(k, {})) for k in sorted(names) if draw.random() < 0.9}
    if kind == "array":
        return [fitting(draw, schema.get("items", {})) for _ in range(draw.randrange(4))]
    return {"string": draw.choice("xyz"), "boolean": True, "integer": draw.choice((1, 2, 3, 10**20))}[kind]


def test_errors_are_those_of_a_walk(spark):
    draw, some = random.Random(3), 0
    for _ in range(12):
        schema = any_schema(draw, 3)
        texts = [json.dumps(fitting(draw, schema)) for _ in range(30)] + [json.dumps(any_value(draw, 3)) for _ in range(10)]
        texts += [None, "", "{", "nul", '{"a": 1,}', " [1] ", '"x"']
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
        got = {r["i"]: r["e"] for r in rows.select("i", variants.variant_errors(F.col("t"), schema).alias("e")).collect()}
        for i, t in enumerate(texts):
            try:
                want = None if t is None else jsontext.schema_errors(json.loads(t), schema)
            except ValueError:
                want = ["$: not JSON"]
            assert (got[i] is None) == (want is None) and sorted(got[i] or []) == sorted(want or []), (schema, t)
            some += bool(want)
    assert some > 100


def test_no_python_in_the_plan(spark):
    for name in ("json_props_valid", "nested_shape_errors"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
