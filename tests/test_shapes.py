"""Nested values of random types against a walk in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import shapes

NAMES = ["a", "b", "secret", "x.y", "long name"]


def any_type(draw, depth):
    kind = draw.randrange(5 if depth else 2)
    if kind < 2:
        return draw.choice((T.StringType(), T.LongType()))
    if kind == 2:
        return T.ArrayType(any_type(draw, depth - 1))
    if kind == 3:
        return T.MapType(T.StringType(), any_type(draw, depth - 1))
    return T.StructType([T.StructField(n, any_type(draw, depth - 1)) for n in draw.sample(["a", "b", "secret"], draw.randrange(1, 4))])


def any_value(draw, kind):
    if draw.random() < 0.1:
        return None
    if isinstance(kind, T.StringType):
        return "é" * draw.randrange(8)
    if isinstance(kind, T.LongType):
        return draw.randrange(9)
    if isinstance(kind, T.ArrayType):
        return [any_value(draw, kind.elementType) for _ in range(draw.randrange(6))]
    if isinstance(kind, T.MapType):
        return {k: any_value(draw, kind.valueType) for k in draw.sample(["a", "secret", "k"], draw.randrange(4))}
    return {f.name: any_value(draw, f.dataType) for f in kind.fields}


def named(patterns, path):
    """Whether a pattern names the path, by a regular expression over the whole of it."""
    text = "".join(f"{p}/" for p in path)
    for p in patterns:
        wanted = "".join(r"(?:[^/]*/)*" if s == "**" else ".*".join(map(re.escape, s.split("*"))).replace(".*", "[^/]*") + "/" for s in p.split("."))
        if re.fullmatch(wanted, text):
            return True
    return False


GONE = object()


def walk(kind, value, patterns, keep, chars, path=()):
    """What stays of a value; GONE if its type has nothing left."""
    if isinstance(kind, T.StringType):
        return value if value is None or chars is None or len(value) <= chars else f"{value[:chars]}... [truncated {len(value) - chars} chars]"
    if isinstance(kind, T.LongType):
        return value
    if isinstance(kind, T.StructType):
        kept = [f for f in kind.fields if not named(patterns, (*path, f.name)) and walk(f.dataType, None, patterns, keep, chars, (*path, f.name)) is not GONE]
        if not kept:
            return GONE
        return None if value is None else {f.name: walk(f.dataType, value[f.name], patterns, keep, chars, (*path, f.name)) for f in kept}
    if isinstance(kind, T.ArrayType):
        inner = (*path, "[]")
        if named(patterns, inner) or walk(kind.elementType, None, patterns, keep, chars, inner) is GONE:
            return GONE
        return None if value is None else [walk(kind.elementType, x, patterns, keep, chars, inner) for x in (value if keep is None else value[-keep:] if keep else [])]
    other = (*path, "\0")  # a key that no pattern names
    if named(patterns, other) or walk(kind.valueType, None, patterns, keep, chars, other) is GONE:
        return GONE
    return None if value is None else {k: walk(kind.valueType, v, patterns, keep, chars, other) for k, v in value.items() if not named(patterns, (*path, k))}


def plain(x):
    if isinstance(x, T.Row):
        return {k: plain(v) for k, v in x.asDict().items()}
    if isinstance(x, dict):
        return {k: plain(v) for k, v in x.items()}
    return [plain(v) for v in x] if isinstance(x, list) else x


def test_random_types_by_a_walk(spark):
    draw, seen = random.Random(6), 0
    for _ in range(25):
        kind = T.StructType([T.StructField(n, any_type(draw, 3)) for n in ("a", "b")])
        values = [any_value(draw, kind) or {"a": None, "b": None} for _ in range(12)]
        patterns = tuple(draw.sample(("**.secret", "a", "b.*", "**.b", "a.[].a", "*.secret", "b.**", "a.*.[]"), draw.randrange(3)))
        keep, chars = draw.choice((None, 2, 1)), draw.choice((None, 3))
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType().add("i", "integer").add("v", kind))
        try:
            cut = shapes.bounded_shape(F.col("v"), kind, keep, chars, patterns)
        except ValueError:
            continue
        got = {r["i"]: plain(r["c"]) for r in rows.select("i", cut.alias("c")).collect()}
        want = {i: walk(kind, v, patterns, keep, chars) for i, v in enumerate(values)}
        assert got == {i: None if v is GONE else v for i, v in want.items()}, (kind, patterns)
        seen += 1
    assert seen > 15


def test_maps_of_arrays_of_structs(spark):
    kind = T.StructType.fromDDL("m map<string, array<struct<text: string, `x.y`: long, secret: string>>>, n long")
    rows = spark.createDataFrame([(({"k": [("abcdef", i, "s") for i in range(5)], "gone": None, "none": []}, 1),)], T.StructType().add("v", kind))
    (row,) = rows.select(shapes.bounded_shape(F.col("v"), kind, keep=2, chars=3, drop=("**.secret", "m.gone", "n")).alias("c")).collect()
    assert plain(row["c"]) == {"m": {"k": [{"text": "abc... [truncated 3 chars]", "x.y": i} for i in (3, 4)], "none": []}}
    with pytest.raises(ValueError, match="one type"):
        shapes.bounded_shape(F.col("v"), kind, drop=("m.k.[].text",))
