"""Shape checks of JSON text as Column expressions over VARIANT: a schema is compiled once, and no Python runs in tasks.

The subset is that of ``jsontext.schema_errors``: objects with required, known and other properties, arrays with items, strings,
booleans, integers, enums of scalars; other types pass. The messages are the same, ``$.path[i]: what``. Fields of an object come
in order of the schema, and those that aren't allowed by name, as a VARIANT keeps no order of its own. A number is an integer if
it is written without fraction and exponent; one of over 18 digits may have a fraction of zeros, and one of over 38 digits isn't
one. An object that names a key twice isn't JSON here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NONE = "array<string>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it stands in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _errors(*messages: Column) -> Column:
    """The messages that aren't null."""
    return F.array_compact(F.array(*messages)) if messages else F.array().cast(_NONE)


def _is(kind: Column, wanted: str) -> Column:
    """Whether a VARIANT of the schema ``kind`` is of the type ``wanted``."""
    return {
        "object": F.startswith(kind, F.lit("OBJECT")),
        "array": F.startswith(kind, F.lit("ARRAY")),
        "string": kind == "STRING",
        "boolean": kind == "BOOLEAN",
        "integer": (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$"),
    }[wanted]


def _equals(value: Column, kind: Column, wanted: str | int | bool | None) -> Column:
    """Whether a VARIANT is the scalar ``wanted``."""
    if wanted is None:
        return kind == "VOID"
    name, ddl = ("boolean", "boolean") if isinstance(wanted, bool) else ("integer", "decimal(38,0)") if isinstance(wanted, int) else ("string", "string")
    return _is(kind, name) & (F.try_variant_get(value, "$", ddl) == F.lit(wanted if ddl == "boolean" else str(wanted)).cast(ddl))


def _object(value: Column, schema: dict, path: Column) -> Column:
    known = schema.get("properties", {})

    def fields(held: Column) -> Column:
        told = [F.when(~F.map_contains_key(held, k), F.concat(path, F.lit(f".{k}: missing"))) for k in schema.get("required", [])]
        parts = [_errors(*told)]
        if schema.get("additionalProperties") is False:
            others = F.array_except(F.map_keys(held), F.array(*map(F.lit, known)).cast(_NONE))
            parts.append(F.transform(others, lambda k: F.concat(path, F.lit("."), k, F.lit(": not allowed"))))
        for k, own in known.items():
            parts.append(_field(held, k, own, path))
        return F.concat(*parts)

    return _let(F.try_variant_get(value, "$", "map<string,variant>"), fields)


def _field(held: Column, key: str, schema: dict, path: Column) -> Column:
    """The errors of a property; none if it isn't there."""
    there = _let(F.try_element_at(held, F.lit(key)), lambda v: _compiled(v, schema, F.concat(path, F.lit(f".{key}"))))
    return F.when(F.map_contains_key(held, key), there).otherwise(F.array().cast(_NONE))


def _compiled(value: Column, schema: dict, path: Column) -> Column:
    """The errors of a VARIANT under ``schema``."""
    kind = schema.get("type")

    def checked(shape: Column) -> Column:
        parts = []
        if "enum" in schema:
            among = F.lit(False)
            for x in schema["enum"]:
                among = among | _equals(value, shape, x)
            parts.append(_errors(F.when(~F.coalesce(among, F.lit(False)), F.concat(path, F.lit(": not in enum")))))
        if kind == "object":
            parts.append(_object(value, schema, path))
        elif kind == "array" and "items" in schema:
            items = F.try_variant_get(value, "$", "array<variant>")
            each = F.transform(items, lambda x, i: _compiled(x, schema["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            parts.append(F.flatten(each))
        found = F.concat(*parts) if parts else F.array().cast(_NONE)
        if kind not in ("object", "array", "string", "boolean", "integer"):
            return found
        return F.when(_is(shape, kind), found).otherwise(F.array(F.concat(path, F.lit(f": not {kind}"))))

    return _let(F.schema_of_variant(value), checked)


def variant_errors(text: Column, schema: dict) -> Column:
    """The errors of each JSON text under ``schema``, as ``jsontext.json_errors`` tells them; null of null."""
    found = _let(F.try_parse_json(text), lambda v: F.when(v.isNull(), F.array(F.lit("$: not JSON"))).otherwise(_compiled(v, schema, F.lit("$"))))
    return F.when(text.isNotNull(), found)
