"""Expressions that go down a nested type of any depth: strings clipped, arrays cut to their last elements, fields dropped by path.

They are built from the type, once, and run as one expression: no value is turned to text or to Python. A path has a segment a
level: a field's name or a map's key, and ``[]`` for the elements of an array. In a pattern ``*`` stands for any characters of a
segment, and ``**`` for any number of segments, none included. A field that matches is dropped with all below; so is a map's
entry. A struct that has lost all its fields goes, too. Nulls stay nulls.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import clip

Patterns = frozenset[tuple[str, ...]]


def _here(patterns: Patterns) -> Patterns:
    """The patterns with those that remain where a ``**`` at their head stands for nothing."""
    out, todo = set(), list(patterns)
    while todo:
        p = todo.pop()
        if p not in out:
            out.add(p)
            if p and p[0] == "**":
                todo.append(p[1:])
    return frozenset(out)


def _below(patterns: Patterns, segment: str | None) -> Patterns:
    """What remains of the patterns below ``segment``; with None, below a key that no segment of theirs names."""
    rest = set()
    for p in _here(patterns):
        if not p:
            continue
        if p[0] == "**":
            rest.add(p)
        elif p[0] == "*" or (segment is not None and re.fullmatch(".*".join(map(re.escape, p[0].split("*"))), segment, re.S)):
            rest.add(p[1:])
    return frozenset(rest)


def _gone(patterns: Patterns) -> bool:
    """Whether some pattern ends here."""
    return () in _here(patterns)


def _walk(value: Column, kind: T.DataType, patterns: Patterns, keep: int | None, chars: int | None) -> Column | None:
    """The value as it stays; None if nothing of it does."""
    if isinstance(kind, T.StringType):
        return value if chars is None else clip(value, chars)
    if isinstance(kind, T.StructType):
        parts = []
        for f in kind.fields:
            below = _below(patterns, f.name)
            part = None if _gone(below) else _walk(value.getField(f.name), f.dataType, below, keep, chars)
            if part is not None:
                parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else None
    if isinstance(kind, T.ArrayType):
        below = _below(patterns, "[]")
        if _gone(below) or _walk(F.lit(None), kind.elementType, below, keep, chars) is None:
            return None
        if keep is not None:
            value = F.when(F.size(value) > keep, F.slice(value, F.greatest(F.size(value) - keep + 1, F.lit(1)), keep)).otherwise(value)
        return F.transform(value, lambda x: _walk(x, kind.elementType, below, keep, chars))
    if isinstance(kind, T.MapType):
        return _entries(value, kind, patterns, keep, chars)
    return value


def _entries(value: Column, kind: T.MapType, patterns: Patterns, keep: int | None, chars: int | None) -> Column | None:
    """A map's entries without those that a pattern names, and their values, walked alike."""
    below = _below(patterns, None)
    if _gone(below) or _walk(F.lit(None), kind.valueType, below, keep, chars) is None:
        return None
    named = [p for p in _here(patterns) if p and p[0] not in ("*", "**")]
    if any(len(p) > 1 and p[1:] != ("**",) for p in named):
        raise ValueError("the values of a map have one type: below it, state * for its key")
    for name in sorted({p[0] for p in named}):
        value = F.map_filter(value, lambda k, _: ~k.cast("string").rlike(_java(name)))  # noqa: B023  used at once
    return F.transform_values(value, lambda _, v: _walk(v, kind.valueType, below, keep, chars))


def _java(segment: str) -> str:
    """A segment's pattern for Java."""
    return "(?s)^" + ".*".join("".join(f"\\x{{{ord(c):x}}}" for c in part) for part in segment.split("*")) + "$"


def bounded_shape(value: Column, kind: T.DataType, keep: int | None = None, chars: int | None = None, drop: tuple[str, ...] = ()) -> Column:
    """``value``, of the type ``kind``, with strings clipped to ``chars``, arrays cut to their last ``keep`` elements, and without the
    paths that the patterns ``drop`` name, such as ``**.secret`` or ``turns.[].meta.*.raw``; a null struct if nothing stays."""
    patterns = frozenset(tuple(p.split(".")) for p in drop)
    found = _walk(value, kind, patterns, keep, chars)
    return F.lit(None).cast("struct<>") if found is None else found
