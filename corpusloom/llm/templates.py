"""A sandboxed template language for chat formats: parsed to a syntax tree, folded, compiled to Python closures.

Text, ``{{ expression }}``, ``{% for x in xs %}``, ``{% if %}``/``{% elif %}``/``{% else %}``, ``{% set x = expression %}`` and
``{% generation %}``, which marks the output under the loss mask. Expressions have string and integer literals, names,
keys (``m.role`` or ``m['role']``), ``==  !=  +  and  or  not`` and filters. There are no calls, no Python attributes and no
loops but those over what the caller passes, so a template can't reach anything else or run on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

_PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|(\w+)|(==|!=|[+|.()\[\]]))", re.S)
_UNQUOTED = {"n": "\n", "t": "\t"}


class TemplateError(ValueError):
    """The template isn't in the language, or names something that isn't there."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """An operator or filter over expressions."""

    op: str
    args: tuple


@dataclass(frozen=True)
class Put:
    value: object


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _key(value: object, key: object) -> object:
    if not isinstance(value, dict) or key not in value:
        raise TemplateError(f"no key {key!r}")
    return value[key]


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "+": lambda a, b: a + b,
    "not": lambda a: not a,
    "key": _key,
    "trim": lambda a: a.strip(),
    "upper": lambda a: a.upper(),
    "lower": lambda a: a.lower(),
    "length": lambda a: len(a),
}


class _Expression:
    def __init__(self, text: str, filters: dict[str, Callable]):
        self.tokens: list[tuple[str, str]] = []
        at, text = 0, text.strip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"can't read {text[at:]!r}")
            kind = ("string", "int", "name", "sign")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at, self.filters = 0, filters

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str:
        kind, value = self.peek()
        if kind == "string" or value not in values:
            return ""
        self.at += 1
        return value

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def whole(self) -> object:
        out = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"{self.peek()[1]!r} is too much")
        return out

    def either(self) -> object:
        out = self.both()
        while self.take("or"):
            out = Apply("or", (out, self.both()))
        return out

    def both(self) -> object:
        out = self.negated()
        while self.take("and"):
            out = Apply("and", (out, self.negated()))
        return out

    def negated(self) -> object:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> object:
        out = self.added()
        while op := self.take("==", "!="):
            out = Apply(op, (out, self.added()))
        return out

    def added(self) -> object:
        out = self.filtered()
        while self.take("+"):
            out = Apply("+", (out, self.filtered()))
        return out

    def filtered(self) -> object:
        out = self.keyed()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            out = Apply(name, (out,))
        return out

    def keyed(self) -> object:
        out = self.single()
        while sign := self.take(".", "["):
            if sign == ".":
                out = Apply("key", (out, Const(self.name())))
            else:
                out = Apply("key", (out, self.either()))
                self.need("]")
        return out

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        return value

    def single(self) -> object:
        kind, value = self.peek()
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        if kind not in ("string", "int", "name"):
            raise TemplateError(f"{value!r} can't begin an expression")
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _UNQUOTED.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        return Const(value == "true") if value in ("true", "false") else Name(value)


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The syntax tree: a tuple of statements."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in _PART.finditer(source):
        parts.append(("text", source[at : m.start()]))
        parts.append(("put", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    place = 0

    def body(*ends: str) -> tuple[tuple, str]:
        nonlocal place
        out: list[object] = []
        while place < len(parts):
            kind, value = parts[place]
            place += 1
            if kind == "text":
                out.append(Put(Const(value)))
            elif kind == "put":
                out.append(Put(_Expression(value, filters).whole()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return tuple(out), value
                out.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[0]!r} is missing")
        return tuple(out), ""

    def branch(test: str) -> If:
        then, end = body("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        other = (branch(rest),) if word == "elif" else body("endif")[0] if word == "else" else ()
        return If(_Expression(test, filters).whole(), then, other)

    def statement(word: str, rest: str) -> object:
        if word == "if":
            return branch(rest)
        if word == "for" and (m := re.fullmatch(r"(\w+)\s+in\s+(.+)", rest, re.S)):
            return For(m[1], _Expression(m[2], filters).whole(), body("endfor")[0])
        if word == "set" and (m := re.fullmatch(r"(\w+)\s*=\s*(.+)", rest, re.S)):
            return Assign(m[1], _Expression(m[2], filters).whole())
        if word == "generation" and not rest:
            return Generation(body("endgeneration")[0])
        raise TemplateError(f"can't read the tag {word!r}")

    return body()[0]


def fold(node: object, operators: dict[str, Callable]) -> object:
    """The tree with constant expressions evaluated, dead branches dropped and neighbouring texts joined."""
    if isinstance(node, tuple):
        out: list[object] = []
        for x in (fold(x, operators) for x in node):
            if isinstance(x, If) and isinstance(x.test, Const):
                out += x.then if x.test.value else x.other
            else:
                out.append(x)
        joined: list[object] = []
        for x in out:
            if isinstance(x, Put) and isinstance(x.value, Const):
                before = joined[-1].value if joined and isinstance(joined[-1], Put) else None
                if isinstance(before, Const):
                    joined[-1] = Put(Const(f"{before.value}{x.value.value}"))
                elif x.value.value != "":
                    joined.append(x)
            else:
                joined.append(x)
        return tuple(joined)
    if isinstance(node, Apply):
        args = tuple(fold(x, operators) for x in node.args)
        if node.op in ("and", "or") and isinstance(args[0], Const):
            return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
        if all(isinstance(x, Const) for x in args) and node.op != "key":
            return Const(operators[node.op](*(x.value for x in args)))
        return Apply(node.op, args)
    if isinstance(node, Put):
        return Put(fold(node.value, operators))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value, operators))
    if isinstance(node, For):
        return For(node.name, fold(node.over, operators), fold(node.body, operators))
    if isinstance(node, If):
        return If(fold(node.test, operators), fold(node.then, operators), fold(node.other, operators))
    return Generation(fold(node.body, operators)) if isinstance(node, Generation) else node


Piece = tuple[str, bool]


def _value(node: object, operators: dict[str, Callable]) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):

        def look(scope: dict, name: str = node.name) -> object:
            if name not in scope:
                raise TemplateError(f"no name {name!r}")
            return scope[name]

        return look
    args = [_value(x, operators) for x in node.args]
    if node.op == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.op == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    apply = operators[node.op]
    if len(args) == 1:
        return lambda scope, one=args[0]: apply(one(scope))
    return lambda scope, one=args[0], two=args[1]: apply(one(scope), two(scope))


def _body(nodes: tuple, marked: bool, operators: dict[str, Callable]) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(x, marked, operators) for x in nodes]

    def run(scope: dict) -> Iterator[Piece]:
        return chain.from_iterable(step(scope) for step in steps)

    return run


def _step(node: object, marked: bool, operators: dict[str, Callable]) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Put):
        value = _value(node.value, operators)
        return lambda scope: ((str(value(scope)), marked),)
    if isinstance(node, Generation):
        return _body(node.body, True, operators)
    if isinstance(node, Assign):
        value = _value(node.value, operators)

        def assign(scope: dict) -> tuple:
            scope[node.name] = value(scope)
            return ()

        return assign
    if isinstance(node, If):
        test, then, other = _value(node.test, operators), _body(node.then, marked, operators), _body(node.other, marked, operators)
        return lambda scope: (then if test(scope) else other)(scope)
    over, body = _value(node.over, operators), _body(node.body, marked, operators)

    def loop(scope: dict) -> Iterator[Piece]:
        inner, ended = dict(scope), object()
        rest = iter(over(scope))
        item, index = next(rest, ended), 0
        while item is not ended:
            following = next(rest, ended)  # one ahead, so that the rows may be as many as they like
            inner[node.name] = item
            inner["loop"] = {"first": index == 0, "last": following is ended, "index0": index}
            yield from body(inner)
            item, index = following, index + 1

    return loop


def compile_template(source: str, filters: dict[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function of the template's variables that yields pieces of output and whether each is under the loss mask."""
    operators = OPERATORS | (filters or {})
    allowed = {k: v for k, v in operators.items() if k.isidentifier() and k not in ("key", "not")}
    run = _body(fold(parse(source, allowed), operators), False, operators)
    return lambda **variables: run(dict(variables))
