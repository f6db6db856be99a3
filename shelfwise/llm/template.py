"""A sandboxed template language, compiled to Python closures.

    {{ expression }}                      print a value
    {% for x in e %} ... {% endfor %}     repeat; `loop.index`, `loop.first`
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   mark what is printed as generated

Expressions: strings, whole numbers, true, false, none, names, `a.b` (a key of a
mapping), `a | filter`, `==`, `!=`, `~` (join as text), `not`, `and`, `or`,
brackets. There are no calls, no attributes of Python objects and no filters
but those passed in, so a template can reach nothing but its data. None prints
as nothing.

Source is parsed to a tree of tuples, constants are folded (joined texts,
decided branches, filters of constants), and the tree becomes closures that
write to an `Output`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from typing import Any


class TemplateError(ValueError):
    """The source is not a template of this language."""


class Output:
    """Text printed so far, and the spans of it that were marked as generated."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)

    def text(self) -> str:
        return "".join(self.parts)


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*')|([0-9]+)|([A-Za-z_]\w*)|(==|!=|[~|.()]))")
_NAMED = {"true": True, "false": False, "none": None}
_KEYWORDS = {"and", "or", "not", "in"}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"unexpected {source[at:at + 10]!r}")
        text, number, name, mark = found.groups()
        if text is not None:
            body = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1])
            out.append(("const", body))
        elif number is not None:
            out.append(("const", int(number)))
        elif name is not None:
            out.append(("word" if name in _KEYWORDS else "name", name))
        else:
            out.append(("mark", mark))
        at = found.end()
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def accept(self, kind: str, value: str) -> bool:
        hit = self.at < len(self.tokens) and self.tokens[self.at] == (kind, value)
        self.at += hit
        return hit

    def take(self, kind: str):
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def either(self):
        node = self.both()
        while self.accept("word", "or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self.accept("word", "and"):
            node = ("and", node, self.negated())
        return node

    def negated(self):
        return ("not", self.negated()) if self.accept("word", "not") else self.compared()

    def compared(self):
        node = self.joined()
        for mark in ("==", "!="):
            if self.accept("mark", mark):
                return (mark, node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while self.accept("mark", "~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self):
        node = self.plain()
        while True:
            if self.accept("mark", "."):
                node = ("key", node, self.take("name"))
            elif self.accept("mark", "|"):
                node = ("filter", node, self.take("name"))
            else:
                return node

    def plain(self):
        if self.accept("mark", "("):
            node = self.either()
            if not self.accept("mark", ")"):
                raise TemplateError(") expected")
            return node
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
        self.at += 1
        if kind == "const":
            return ("const", value)
        if kind == "name":
            return ("const", _NAMED[value]) if value in _NAMED else ("name", value)
        raise TemplateError("value expected")


def parse(source: str) -> list[tuple]:
    """The tree of a template: a list of nodes."""
    pieces, at = [], 0
    for found in _PIECE.finditer(source):
        if found.start() > at:
            pieces.append(("text", source[at:found.start()]))
        pieces.append(("print", found[1]) if found[1] is not None else ("tag", found[2].strip()))
        at = found.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    pieces.reverse()

    def block(*ends: str) -> tuple[list[tuple], str]:
        nodes = []
        while pieces:
            kind, body = pieces.pop()
            if kind == "text":
                nodes.append(("text", body))
                continue
            if kind == "print":
                nodes.append(("print", _Expression(body).whole()))
                continue
            word, _, rest = body.partition(" ")
            if word in ends:
                return nodes, body
            if word == "for":
                loop = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not loop:
                    raise TemplateError(f"for: {rest!r}")
                inner, _ = block("endfor")
                nodes.append(("for", loop[1], _Expression(loop[2]).whole(), inner))
            elif word == "if":
                arms, test = [], _Expression(rest).whole()
                while True:
                    inner, end = block("elif", "else", "endif")
                    arms.append((test, inner))
                    word, _, rest = end.partition(" ")
                    if word == "endif":
                        break
                    test = ("const", True) if word == "else" else _Expression(rest).whole()
                nodes.append(("if", arms))
            elif word == "generation":
                nodes.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown or misplaced tag {body!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} expected")
        return nodes, ""

    return block()[0]


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


_TWO = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: _shown(a) + _shown(b),
        "and": lambda a, b: a and b, "or": lambda a, b: a or b}


def fold(node: tuple, filters: Mapping[str, Callable[[str], str]]) -> tuple:
    """An expression with its constant parts worked out."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter" and node[2] not in filters:
        raise TemplateError(f"no filter {node[2]!r}")
    parts = [fold(x, filters) if isinstance(x, tuple) else x for x in node[1:]]
    if kind in _TWO and parts[0][0] == parts[1][0] == "const":
        return ("const", _TWO[kind](parts[0][1], parts[1][1]))
    if kind == "not" and parts[0][0] == "const":
        return ("const", not parts[0][1])
    if kind == "filter" and parts[0][0] == "const":
        return ("const", filters[parts[1]](_shown(parts[0][1])))
    return (kind, *parts)


def fold_block(nodes: list[tuple], filters: Mapping[str, Callable[[str], str]]) -> list[tuple]:
    """Statements with constants folded, decided branches taken and texts joined."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        else:
            out.append(node)

    for node in nodes:
        if node[0] == "print":
            value = fold(node[1], filters)
            add(("text", _shown(value[1])) if value[0] == "const" else ("print", value))
        elif node[0] == "if":
            arms = []
            for test, inner in node[1]:
                test = fold(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                arms.append((test, fold_block(inner, filters)))
                if test[0] == "const":
                    break
            if arms and arms[0][0][0] == "const":
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                add(("if", arms))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2], filters), fold_block(node[3], filters)))
        elif node[0] == "generation":
            add(("generation", fold_block(node[1], filters)))
        else:
            add(node)
    return out


def _value(node: tuple, filters) -> Callable[[dict], Any]:
    kind = node[0]
    if kind == "const":
        const = node[1]
        return lambda env: const
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    inner = _value(node[1], filters)
    if kind == "key":
        key = node[2]

        def get(env):
            whole = inner(env)
            return whole.get(key) if isinstance(whole, Mapping) else None
        return get
    if kind == "filter":
        apply = filters[node[2]]
        return lambda env: apply(_shown(inner(env)))
    if kind == "not":
        return lambda env: not inner(env)
    other = _value(node[2], filters)
    if kind == "and":
        return lambda env: inner(env) and other(env)
    if kind == "or":
        return lambda env: inner(env) or other(env)
    two = _TWO[kind]
    return lambda env: two(inner(env), other(env))


def _statement(node: tuple, filters) -> Callable[[dict, Output], None]:
    kind = node[0]
    if kind == "text":
        text = node[1]
        return lambda env, out: out.write(text)
    if kind == "print":
        value = _value(node[1], filters)
        return lambda env, out: out.write(_shown(value(env)))
    if kind == "if":
        arms = [(_value(test, filters), _sequence(inner, filters)) for test, inner in node[1]]

        def choose(env, out):
            for test, run in arms:
                if test(env):
                    run(env, out)
                    return
        return choose
    if kind == "for":
        name, items, run = node[1], _value(node[2], filters), _sequence(node[3], filters)

        def repeat(env, out):
            start = env.get("loop_start", 0)
            inner = dict(env)
            for i, item in enumerate(items(env) or (), start + 1):
                inner[name], inner["loop"] = item, {"index": i, "first": i == 1}
                run(inner, out)
        return repeat
    run = _sequence(node[1], filters)

    def mark(env, out):
        start = out.length
        run(env, out)
        if out.length > start:
            out.spans.append((start, out.length))
    return mark


def _sequence(nodes: list[tuple], filters) -> Callable[[dict, Output], None]:
    steps = [_statement(node, filters) for node in nodes]
    if len(steps) == 1:
        return steps[0]

    def run(env, out):
        for step in steps:
            step(env, out)
    return run


class Template:
    """A compiled template over `turns`."""

    def __init__(self, source: str, filters: Mapping[str, Callable[[str], str]]):
        self.tree = fold_block(parse(source), filters)
        self._run = _sequence(self.tree, filters)

    def render(self, turns: Iterable[Mapping], start: int = 0) -> Output:
        """Print `turns`; `start` is how many turns of the conversation came in earlier calls.

        A template that is one loop over turns can be printed in parts.
        """
        out = Output()
        self._run({"turns": turns, "loop_start": start}, out)
        return out
