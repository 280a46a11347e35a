"""A sandboxed chat template language, compiled to Python closures.

``{{ expression }}`` prints, ``{% if %} {% elif %} {% else %} {% endif %}``
chooses, ``{% for name in expression %} {% endfor %}`` repeats, ``{% generation
%} {% endgeneration %}`` marks what a model is trained to produce. A dash
inside a tag (``{%-``, ``-%}``) trims white space on that side. Expressions have
names, string and integer literals, ``a.b`` and ``a["b"]`` (entries of mappings,
nothing else), ``+ == != and or not``, parentheses and the filters given to
``compile_template``. There is no call, no attribute access and no assignment,
so a template reaches only the values it is given.

A template is parsed to a tree, constants are folded, and every node becomes a
closure that yields pieces of output; a loop takes any iterator, so output can
be longer than memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

TAG = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<name>[A-Za-z_]\w*)|(?P<int>\d+)|(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<op>==|!=|[().\[\]|+]))""")
ESCAPES = {"n": "\n", "t": "\t", "\\": "\\", '"': '"', "'": "'"}
KEYWORDS = frozenset("and or not in".split())


class TemplateError(ValueError):
    """A template that is not of the language, or that asks for something outside the sandbox."""


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Entry:
    of: Any
    key: Any


@dataclass(frozen=True)
class Binary:
    op: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Not:
    of: Any


@dataclass(frozen=True)
class Filter:
    name: str
    of: Any


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Print:
    of: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class Expression:
    """Parser of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:at + 20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            at = found.end()
        self.at = 0

    def whole(self) -> Any:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else ""

    def take(self, *wanted: str) -> str:
        if wanted and self.peek() not in wanted or self.at >= len(self.tokens):
            raise TemplateError(f"expected {' or '.join(wanted) or 'a value'}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self) -> Any:
        tree = self.both()
        while self.peek() == "or":
            self.take()
            tree = Binary("or", tree, self.both())
        return tree

    def both(self) -> Any:
        tree = self.negated()
        while self.peek() == "and":
            self.take()
            tree = Binary("and", tree, self.negated())
        return tree

    def negated(self) -> Any:
        if self.peek() == "not":
            self.take()
            return Not(self.negated())
        tree = self.sum()
        if self.peek() in ("==", "!="):
            tree = Binary(self.take(), tree, self.sum())
        return tree

    def sum(self) -> Any:
        tree = self.entry()
        while self.peek() == "+":
            self.take()
            tree = Binary("+", tree, self.entry())
        return tree

    def entry(self) -> Any:
        tree = self.value()
        while self.peek() in (".", "[", "|"):
            mark = self.take()
            if mark == "[":
                tree = Entry(tree, self.either())
                self.take("]")
            elif self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
                word = self.take()
                tree = Entry(tree, Const(word)) if mark == "." else Filter(word, tree)
            else:
                raise TemplateError(f"a name must follow {mark!r}")
        return tree

    def value(self) -> Any:
        kind = self.tokens[self.at][0] if self.at < len(self.tokens) else ""
        if kind == "op":
            self.take("(")
            tree = self.either()
            self.take(")")
            return tree
        word = self.take()
        if kind == "int":
            return Const(int(word))
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[0]), word[1:-1], flags=re.S))
        if word in KEYWORDS:
            raise TemplateError(f"{word!r} is no value")
        return Const(word == "true") if word in ("true", "false") else Name(word)


def parse(source: str) -> tuple:
    """The tree of a template."""
    items: list[tuple[str, str]] = []
    at = 0
    trim_next = False
    for tag in TAG.finditer(source):
        text = source[at:tag.start()]
        text = text.lstrip() if trim_next else text
        items.append(("text", text.rstrip() if tag[0][2] == "-" else text))
        items.append(("print", tag[1]) if tag[1] is not None else ("tag", tag[2].strip()))
        trim_next, at = tag[0][-3] == "-", tag.end()
    items.append(("text", source[at:].lstrip() if trim_next else source[at:]))
    body, rest, ended = _body(items, 0, ())
    if rest != len(items):
        raise TemplateError(f"unexpected {ended!r}")
    return body


def _body(items: list[tuple[str, str]], at: int, ends: tuple[str, ...]) -> tuple[tuple, int, str]:
    made: list[Any] = []
    while at < len(items):
        kind, content = items[at]
        at += 1
        if kind == "text":
            made.append(Text(content))
            continue
        if kind == "print":
            made.append(Print(Expression(content).whole()))
            continue
        word, _, rest = content.partition(" ")
        if word in ends:
            return tuple(made), at, content
        if word == "if":
            node, at = _choice(items, at, rest)
            made.append(node)
        elif word == "for":
            loop = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not loop:
                raise TemplateError(f"cannot read loop {content!r}")
            body, at, _ = _body(items, at, ("endfor",))
            made.append(For(loop[1], Expression(loop[2]).whole(), body))
        elif word == "generation":
            body, at, _ = _body(items, at, ("endgeneration",))
            made.append(Generation(body))
        else:
            raise TemplateError(f"unknown or misplaced tag {content!r}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return tuple(made), at, ""


def _choice(items: list[tuple[str, str]], at: int, test: str) -> tuple[If, int]:
    then, at, ended = _body(items, at, ("elif", "else", "endif"))
    other: tuple = ()
    if ended.startswith("elif"):
        node, at = _choice(items, at, ended[4:])
        other = (node,)
    elif ended == "else":
        other, at, _ = _body(items, at, ("endif",))
    return If(Expression(test).whole(), then, other), at


def fold_expression(tree: Any, filters: Mapping[str, Callable]) -> Any:
    """The expression with its constant parts computed."""
    if isinstance(tree, Entry):
        return Entry(fold_expression(tree.of, filters), fold_expression(tree.key, filters))
    if isinstance(tree, Not):
        of = fold_expression(tree.of, filters)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(tree, Filter):
        if tree.name not in filters:
            raise TemplateError(f"unknown filter {tree.name!r}")
        of = fold_expression(tree.of, filters)
        return Const(filters[tree.name](of.value)) if isinstance(of, Const) else Filter(tree.name, of)
    if isinstance(tree, Binary):
        left, right = fold_expression(tree.left, filters), fold_expression(tree.right, filters)
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(OPERATORS[tree.op](left.value, right.value))
        return Binary(tree.op, left, right)
    return tree


OPERATORS: dict[str, Callable[[Any, Any], Any]] = {
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else printed(a) + printed(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def fold(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    """The tree with constants folded: printed constants become text, decided choices vanish, texts merge."""
    made: list[Any] = []
    for node in body:
        if isinstance(node, Print):
            of = fold_expression(node.of, filters)
            made.append(Text(printed(of.value)) if isinstance(of, Const) else Print(of))
        elif isinstance(node, If):
            test = fold_expression(node.test, filters)
            then, other = fold(node.then, filters), fold(node.other, filters)
            made.extend((then if test.value else other) if isinstance(test, Const) else (If(test, then, other),))
        elif isinstance(node, For):
            made.append(For(node.name, fold_expression(node.over, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            made.append(Generation(fold(node.body, filters)))
        else:
            made.append(node)
    merged: list[Any] = []
    for node in made:
        if isinstance(node, Text) and merged and isinstance(merged[-1], Text):
            merged[-1] = Text(merged[-1].text + node.text)
        elif not isinstance(node, Text) or node.text:
            merged.append(node)
    return tuple(merged)


def printed(value: Any) -> str:
    return "" if value is None else str(value)


Scope = dict[str, Any]
Piece = tuple[str, bool]


def expression_closure(tree: Any, filters: Mapping[str, Callable]) -> Callable[[Scope], Any]:
    if isinstance(tree, Const):
        return lambda scope: tree.value
    if isinstance(tree, Name):
        return lambda scope: scope.get(tree.name)
    if isinstance(tree, Entry):
        of, key = expression_closure(tree.of, filters), expression_closure(tree.key, filters)

        def entry(scope: Scope) -> Any:
            value = of(scope)
            if not isinstance(value, Mapping):
                raise TemplateError("only mappings have entries")
            return value.get(key(scope))

        return entry
    if isinstance(tree, Not):
        of = expression_closure(tree.of, filters)
        return lambda scope: not of(scope)
    if isinstance(tree, Filter):
        of, apply = expression_closure(tree.of, filters), filters[tree.name]
        return lambda scope: apply(of(scope))
    left, right = expression_closure(tree.left, filters), expression_closure(tree.right, filters)
    if tree.op == "and":
        return lambda scope: left(scope) and right(scope)
    if tree.op == "or":
        return lambda scope: left(scope) or right(scope)
    operator = OPERATORS[tree.op]
    return lambda scope: operator(left(scope), right(scope))


def body_closure(body: tuple, filters: Mapping[str, Callable], trained: bool = False) -> Callable[[Scope], Iterator[Piece]]:
    """A closure that yields the pieces of a body, each with whether it is inside a generation block."""
    parts = [_node_closure(node, filters, trained) for node in body]

    def render(scope: Scope) -> Iterator[Piece]:
        for part in parts:
            yield from part(scope)

    return render


def _node_closure(node: Any, filters: Mapping[str, Callable], trained: bool) -> Callable[[Scope], Iterable[Piece]]:
    if isinstance(node, Text):
        piece = ((node.text, trained),)
        return lambda scope: piece
    if isinstance(node, Print):
        of = expression_closure(node.of, filters)
        return lambda scope: ((printed(of(scope)), trained),)
    if isinstance(node, Generation):
        return body_closure(node.body, filters, True)
    if isinstance(node, If):
        test = expression_closure(node.test, filters)
        then, other = body_closure(node.then, filters, trained), body_closure(node.other, filters, trained)
        return lambda scope: then(scope) if test(scope) else other(scope)
    over, inner, name = expression_closure(node.over, filters), body_closure(node.body, filters, trained), node.name

    def repeat(scope: Scope) -> Iterator[Piece]:
        for number, value in enumerate(over(scope) or ()):
            yield from inner({**scope, name: value, "loop": {"index": number + 1, "index0": number, "first": not number}})

    return repeat


def compile_template(source: str, filters: Mapping[str, Callable[[Any], Any]] | None = None) -> Callable[[Scope], Iterator[Piece]]:
    """A function from the template's values to its output, as an iterator of (text, inside generation)."""
    filters = {"trim": lambda v: printed(v).strip(), "upper": lambda v: printed(v).upper(),
               "lower": lambda v: printed(v).lower(), **(filters or {})}
    return body_closure(fold(parse(source), filters), filters)
