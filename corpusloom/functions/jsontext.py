"""JSON in text columns: canonical form, lenient reading, shape checks."""

from __future__ import annotations

import json
import re
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*\n(.*?)\n?\s*```\s*$", re.S)
_TOKEN = re.compile(r'\s*(?:(?P<value>"(?:[^"\\]|\\.)*"|-?\d[\d.eE+-]*|true|false|null)|(?P<open>[{\[])|(?P<close>[}\]])|(?P<between>[,:]))', re.S)


def canonical(text: str, compact: bool = False) -> str:
    """Sorted keys, letters as they are; with ``compact`` no spaces. The two forms have different hashes."""
    return json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False, separators=(",", ":") if compact else None)


def with_commas(text: str) -> str:
    """``text`` with a comma wherever one value ends and another begins with white space between, or behind a bracket.

    As it is if it isn't JSON's tokens, or if a string touches the next value: there, a quote may stand in the string.
    """
    out, at, ended, string = [], 0, False, False
    for m in iter(lambda: _TOKEN.match(text, at), None):
        if ended and (m["value"] or m["open"]):
            if string and not m[0][0].isspace():
                return text
            out.append(",")
        out.append(m[0])
        at, ended, string = m.end(), bool(m["value"] or m["close"]), m[0].endswith('"')
    return text if text[at:].strip() else "".join(out)


def read_lenient(text: str | None) -> str | None:
    """The canonical JSON of an answer: bare, fenced, the outermost braces of prose, or with commas missing anywhere.

    A repair counts only if the result is JSON, and a text with an empty string is never repaired, as that could change it.
    """
    if text is None:
        return None
    fenced = _FENCE.match(text)
    body = fenced[1] if fenced else text
    inner = body[body.find("{") : body.rfind("}") + 1]
    repaired = (with_commas(x) for x in (inner, body) if '""' not in x)
    for candidate in chain((body, inner), repaired):
        try:
            return canonical(candidate)
        except ValueError:
            continue
    return None


def lenient_json(text: Column) -> Column:
    """``read_lenient`` in Arrow batches."""

    @F.pandas_udf("string")
    def read(values: pd.Series) -> pd.Series:
        return values.map(read_lenient, na_action="ignore")

    return read(text)


def json_digest(text: Column, compact: bool = False) -> Column:
    """SHA-256 of the canonical form; null if the text isn't JSON."""

    @F.pandas_udf("string")
    def form(values: pd.Series) -> pd.Series:
        def one(value: str) -> str | None:
            try:
                return canonical(value, compact)
            except ValueError:
                return None

        return values.map(one, na_action="ignore")

    return F.sha2(form(text), 256)


def schema_errors(value: object, schema: dict, path: str = "$") -> list[str]:
    """What is wrong with ``value`` under a subset of JSON Schema: objects, arrays, strings, booleans, integers, enums."""
    kind, out = schema.get("type"), []
    wanted = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int}.get(kind)
    if wanted and (not isinstance(value, wanted) or (kind == "integer" and isinstance(value, bool))):
        return [f"{path}: not {kind}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if kind == "object":
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}: not allowed" for k in value if k not in known]
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], f"{path}.{k}")
    elif kind == "array" and "items" in schema:
        for i, v in enumerate(value):
            out += schema_errors(v, schema["items"], f"{path}[{i}]")
    return out


def json_errors(text: Column, schema: dict) -> Column:
    """The errors of each JSON text under ``schema``; a text that isn't JSON has one."""

    @F.pandas_udf("array<string>")
    def check(values: pd.Series) -> pd.Series:
        def one(value: str | None) -> list[str] | None:
            if value is None:
                return None
            try:
                return schema_errors(json.loads(value), schema)
            except ValueError:
                return ["$: not JSON"]

        return values.map(one)

    return check(text)


def wrapped_or_bare(text: Column, key: str, inner: str) -> Column:
    """The struct ``inner`` (DDL) under ``key``, or the whole object where it was left unwrapped; null for anything else.

    An object is either only if it has all the fields of ``inner``.
    """
    names = T.StructType.fromDDL(inner).names
    wrapped = F.from_json(text, f"`{key}` map<string, string>")[key]
    bare = F.from_json(text, "map<string, string>")
    has_all = lambda fields: F.coalesce(F.size(F.array_except(F.array(*map(F.lit, names)), F.map_keys(fields))) == 0, F.lit(False))
    return F.when(has_all(wrapped), F.from_json(text, f"`{key}` struct<{inner}>")[key]).when(has_all(bare), F.from_json(text, f"struct<{inner}>"))
