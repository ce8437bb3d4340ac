"""A small, sandboxed template language for conversations, compiled to Python closures.

A template is parsed into a syntax tree, constants are folded, and every node left becomes a
closure. Rendering streams: messages are taken one by one, with one message looked ahead, and
fragments of output come out with a mark whether they lie in a generation block.

    {{ expression }}                         output
    {% for m in messages %}..{% endfor %}    once per message; loops don't nest and there is one
    {% if e %}..{% elif e %}..{% else %}..{% endif %}
    {% generation %}..{% endgeneration %}    text that a model has to learn to produce
    {# comment #}                            nothing

A hyphen inside a tag (``{%-``, ``-%}``) drops the white space on its side. Expressions are
strings, whole numbers, ``true``, ``false``, ``none``, names, ``m.field``, ``m['field']``,
``not``, ``and``, ``or``, ``==``, ``!=``, ``<``, ``in``, ``~`` (joins texts), ``+``, ``a if c else b``
and filters (``text|trim``). Inside the loop, ``loop`` has ``index``, ``index0``, ``first``,
``last``, ``previous`` and ``next``.

The sandbox: fields are keys of dictionaries, never attributes of Python objects; there are no
calls but those of the filters given; there is no assignment and no second loop, so the output of
a message is bounded by the template and the message. What the rules don't allow is refused when
the template is compiled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

Filter = Callable[..., object]
Fragment = tuple[str, bool]


class TemplateError(ValueError):
    """A template that can't be compiled, or a value that it can't render."""


# --- syntax tree -------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    base: object
    key: object


@dataclass(frozen=True)
class Operation:
    sign: str
    parts: tuple


@dataclass(frozen=True)
class Choice:
    test: object
    then: object
    otherwise: object


@dataclass(frozen=True)
class Filtered:
    name: str
    parts: tuple


@dataclass(frozen=True)
class Output:
    value: object
    masked: bool = False


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    otherwise: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


# --- words of the language ---------------------------------------------------

_OPEN = re.compile(r"\{\{-?|\{%-?|\{#-?")
_TOKEN = re.compile(
    r"""\s*(?:
        (?P<close>-?%\}|-?\}\})
      | (?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")
      | (?P<number>\d+)
      | (?P<name>[A-Za-z_]\w*)
      | (?P<sign>==|!=|[<~+|.,()\[\]])
    )""",
    re.VERBOSE | re.DOTALL,
)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}


def _unquoted(literal: str) -> str:
    return re.sub(
        r"\\(.)", lambda found: _ESCAPED.get(found[1], found[1]), literal[1:-1], flags=re.DOTALL
    )


def _pieces(source: str) -> Iterator[tuple[str, object]]:
    """("text", str), ("{{", tokens) and ("{%", tokens) in turn."""
    at, trim = 0, False
    while True:
        opened = _OPEN.search(source, at)
        text = source[at : opened.start() if opened else len(source)]
        if trim:
            text = text.lstrip()
        if opened and opened[0].endswith("-"):
            text = text.rstrip()
        if text:
            yield "text", text
        if not opened:
            return
        kind, at = opened[0][:2], opened.end()
        if kind == "{#":
            end = source.find("#}", at)
            if end < 0:
                raise TemplateError("a comment without end")
            trim, at = source[end - 1] == "-", end + 2
            continue
        tokens = []
        while True:
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"not understood: {source[at : at + 20]!r}")
            at = found.end()
            if found["close"]:
                if found["close"][-2:] != ("}}" if kind == "{{" else "%}"):
                    raise TemplateError(f"{kind} is closed by {found['close']}")
                trim = found["close"].startswith("-")
                break
            tokens.append((found.lastgroup, found[found.lastgroup]))
        yield kind, tokens


# --- parser ------------------------------------------------------------------

_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}
_KEYWORDS = {"and", "or", "not", "in", "if", "else"}


class _Expression:
    """Reads one expression from tokens, the loosest sign first."""

    def __init__(self, tokens: list[tuple[str, str]]):
        self.tokens, self.at = tokens, 0

    def peek(self) -> tuple[str | None, str | None]:
        return self.tokens[self.at] if self.at < len(self.tokens) else (None, None)

    def take(self, *values: str) -> str | None:
        """The next token if it is one of these signs or words."""
        kind, value = self.peek()
        if kind in ("sign", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def whole(self):
        found = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"more than an expression: {self.peek()[1]!r}")
        return found

    def choice(self):
        value = self.chain(("or",), self.conjunction)
        if not self.take("if"):
            return value
        test = self.chain(("or",), self.conjunction)
        otherwise = self.choice() if self.take("else") else Const("")
        return Choice(test, value, otherwise)

    def chain(self, signs: tuple[str, ...], part: Callable):
        value = part()
        while sign := self.take(*signs):
            value = Operation(sign, (value, part()))
        return value

    def conjunction(self):
        return self.chain(("and",), self.negation)

    def negation(self):
        if self.take("not"):
            return Operation("not", (self.negation(),))
        return self.comparison()

    def comparison(self):
        value = self.joined()
        if sign := self.take("==", "!=", "<", "in"):
            return Operation(sign, (value, self.joined()))
        if self.take("not"):
            self.need("in")
            return Operation("not", (Operation("in", (value, self.joined())),))
        return value

    def joined(self):
        return self.chain(("~", "+"), self.filtered)

    def filtered(self):
        value = self.field()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name":
                raise TemplateError("a filter has no name")
            self.at += 1
            parts = [value]
            if self.take("("):
                while not self.take(")"):
                    parts.append(self.choice())
                    if not self.take(","):
                        self.need(")")
                        break
            value = Filtered(name, tuple(parts))
        return value

    def field(self):
        value = self.atom()
        while sign := self.take(".", "["):
            if sign == "[":
                value = Field(value, self.choice())
                self.need("]")
                continue
            kind, name = self.peek()
            if kind != "name":
                raise TemplateError("a field has no name")
            self.at += 1
            value = Field(value, Const(name))
        return value

    def atom(self):
        kind, value = self.peek()
        self.at += 1
        if kind == "text":
            return Const(_unquoted(value))
        if kind == "number":
            return Const(int(value))
        if kind == "name" and value in _WORDS:
            return Const(_WORDS[value])
        if kind == "name" and value not in _KEYWORDS:
            return Name(value)
        if (kind, value) == ("sign", "("):
            inner = self.choice()
            self.need(")")
            return inner
        raise TemplateError(f"expected a value, found {value!r}")


class _Statements:
    """Reads a template into statements."""

    def __init__(self, source: str):
        self.pieces = _pieces(source)
        self.loops = 0

    def block(self, ends: tuple[str, ...], masked: bool) -> tuple[tuple, str, list]:
        """Statements up to one of ``ends``; that tag's word and its other tokens."""
        found = []
        for kind, content in self.pieces:
            if kind == "text":
                found.append(Output(Const(content), masked))
            elif kind == "{{":
                found.append(Output(_Expression(content).whole(), masked))
            else:
                word = content[0][1] if content else None
                if word in ends:
                    return tuple(found), word, content[1:]
                found.append(self.statement(word, content[1:], masked))
        if ends != ("",):
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return tuple(found), "", []

    def statement(self, word: str | None, rest: list, masked: bool):
        if word == "if":
            return self.branch(rest, masked)
        if word == "generation":
            if masked or rest:
                raise TemplateError("generation blocks don't nest and take nothing")
            body, _, _ = self.block(("endgeneration",), True)
            return If(Const(True), body, ())
        if word == "for":
            words = [value for _, value in rest]
            if len(words) != 3 or words[1:] != ["in", "messages"] or rest[0][0] != "name":
                raise TemplateError("only 'for name in messages' loops are allowed")
            self.loops += 1
            if self.loops > 1 or masked or words[0] in ("messages", "loop"):
                raise TemplateError("messages can be looped over once, outside generation")
            body, _, _ = self.block(("endfor",), masked)
            return Loop(words[0], body)
        raise TemplateError(f"unknown statement {word!r}")

    def branch(self, rest: list, masked: bool) -> If:
        test = _Expression(rest).whole()
        then, word, more = self.block(("elif", "else", "endif"), masked)
        if word == "elif":
            return If(test, then, (self.branch(more, masked),))
        otherwise: tuple = ()
        if word == "else":
            otherwise, _, _ = self.block(("endif",), masked)
        return If(test, then, otherwise)


def parse(source: str) -> tuple:
    """The statements of a template."""
    return _Statements(source).block(("",), False)[0]


# --- values ------------------------------------------------------------------


def shown(value: object) -> str:
    """A value as output: texts as they are, none as nothing."""
    if isinstance(value, str):
        return value
    if value is None:
        return ""
    if isinstance(value, (bool, int)):
        return str(value)
    raise TemplateError(f"a {type(value).__name__} has no text")


def _field(base: object, key: object) -> object:
    if base is None:
        return None
    if isinstance(base, Mapping):
        return base.get(key)
    raise TemplateError(f"a {type(base).__name__} has no fields")


def _plus(a: object, b: object) -> object:
    if type(a) is type(b) and isinstance(a, (str, int)):
        return a + b
    raise TemplateError("+ takes two texts or two numbers")


def _below(a: object, b: object) -> bool:
    if type(a) is type(b) and isinstance(a, (str, int)):
        return a < b
    raise TemplateError("< takes two texts or two numbers")


def _within(a: object, b: object) -> bool:
    if isinstance(b, str):
        return shown(a) in b
    if isinstance(b, Mapping):
        return a in b
    raise TemplateError("in takes a text or a message")


_SIGNS: dict[str, Callable] = {
    "not": lambda a: not a,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": _below,
    "in": _within,
    "~": lambda a, b: shown(a) + shown(b),
    "+": _plus,
}

FILTERS: dict[str, Filter] = {
    "trim": lambda text: shown(text).strip(),
    "upper": lambda text: shown(text).upper(),
    "lower": lambda text: shown(text).lower(),
    "length": lambda text: len(shown(text)),
    "default": lambda value, other: other if value is None else value,
}


# --- constant folding --------------------------------------------------------


class _Folder:
    """Replaces what doesn't depend on messages or variables by its value."""

    def __init__(self, filters: Mapping[str, Filter]):
        self.filters = filters

    def value(self, node):
        if isinstance(node, Field):
            return Field(self.value(node.base), self.value(node.key))
        if isinstance(node, Choice):
            test = self.value(node.test)
            if isinstance(test, Const):
                return self.value(node.then if test.value else node.otherwise)
            return Choice(test, self.value(node.then), self.value(node.otherwise))
        if isinstance(node, Operation):
            parts = tuple(map(self.value, node.parts))
            first = parts[0]
            if node.sign in ("and", "or"):
                if not isinstance(first, Const):
                    return Operation(node.sign, parts)
                return parts[1] if bool(first.value) == (node.sign == "and") else first
            if all(isinstance(part, Const) for part in parts):
                return Const(_SIGNS[node.sign](*(part.value for part in parts)))
            return Operation(node.sign, parts)
        if isinstance(node, Filtered):
            if node.name not in self.filters:
                raise TemplateError(f"unknown filter {node.name!r}")
            parts = tuple(map(self.value, node.parts))
            if all(isinstance(part, Const) for part in parts):
                return Const(self.filters[node.name](*(part.value for part in parts)))
            return Filtered(node.name, parts)
        return node

    def block(self, statements: Iterable) -> tuple:
        """Statements without dead branches; constant outputs side by side are one."""
        found: list = []
        for node in self.flat(statements):
            last = found[-1] if found else None
            if self.constant(node) and self.constant(last) and node.masked == last.masked:
                found[-1] = Output(Const(last.value.value + node.value.value), node.masked)
            else:
                found.append(node)
        return tuple(found)

    @staticmethod
    def constant(node) -> bool:
        return isinstance(node, Output) and isinstance(node.value, Const)

    def flat(self, statements: Iterable) -> Iterator:
        for node in statements:
            if isinstance(node, If):
                test = self.value(node.test)
                if isinstance(test, Const):
                    yield from self.flat(node.then if test.value else node.otherwise)
                else:
                    yield If(test, self.block(node.then), self.block(node.otherwise))
            elif isinstance(node, Loop):
                yield Loop(node.name, self.block(node.body))
            else:
                value = self.value(node.value)
                if isinstance(value, Const):
                    value = Const(shown(value.value))
                    if not value.value:
                        continue
                yield Output(value, node.masked)


def fold(statements: Iterable, filters: Mapping[str, Filter] = FILTERS) -> tuple:
    return _Folder(filters).block(statements)


# --- closures ----------------------------------------------------------------


class _Generator:
    """Makes closures of an environment (a dictionary of names)."""

    def __init__(self, filters: Mapping[str, Filter], names: set[str]):
        self.filters, self.names = filters, names

    def value(self, node) -> Callable[[dict], object]:
        if isinstance(node, Const):
            constant = node.value
            return lambda env: constant
        if isinstance(node, Name):
            name = node.name
            if name not in self.names:
                raise TemplateError(f"unknown name {name!r}")
            return lambda env: env[name]
        if isinstance(node, Field):
            base, key = self.value(node.base), self.value(node.key)
            return lambda env: _field(base(env), key(env))
        if isinstance(node, Choice):
            test, then, other = map(self.value, (node.test, node.then, node.otherwise))
            return lambda env: then(env) if test(env) else other(env)
        if isinstance(node, Filtered):
            applied, parts = self.filters[node.name], [self.value(p) for p in node.parts]
            return lambda env: applied(*[part(env) for part in parts])
        parts = [self.value(part) for part in node.parts]
        if node.sign == "and":
            return lambda env: parts[0](env) and parts[1](env)
        if node.sign == "or":
            return lambda env: parts[0](env) or parts[1](env)
        sign = _SIGNS[node.sign]
        return lambda env: sign(*[part(env) for part in parts])

    def block(self, statements: tuple) -> Callable[[dict], Iterator[Fragment]]:
        steps = [self.statement(node) for node in statements]

        def run(env: dict) -> Iterator[Fragment]:
            for step in steps:
                yield from step(env)

        return run

    def statement(self, node) -> Callable[[dict], Iterable[Fragment]]:
        if isinstance(node, Output):
            masked = node.masked
            if isinstance(node.value, Const):
                fixed = ((node.value.value, masked),)
                return lambda env: fixed
            value = self.value(node.value)
            return lambda env: ((shown(value(env)), masked),)
        if isinstance(node, If):
            test, then, other = self.value(node.test), self.block(node.then), self.block(node.otherwise)
            return lambda env: then(env) if test(env) else other(env)
        body = _Generator(self.filters, self.names | {node.name, "loop"}).block(node.body)
        name = node.name

        def loop(env: dict) -> Iterator[Fragment]:
            messages = iter(env["messages"])
            before, here = None, next(messages, None)
            number = 0
            while here is not None:
                after = next(messages, None)
                about = {
                    "index0": number,
                    "index": number + 1,
                    "first": before is None,
                    "last": after is None,
                    "previous": before,
                    "next": after,
                }
                yield from body(env | {name: here, "loop": about})
                before, here = here, after
                number += 1

        return loop


class Template:
    """A compiled template. ``variables`` names what ``render`` is given besides the messages."""

    def __init__(
        self, source: str, variables: Iterable[str] = (), filters: Mapping[str, Filter] = FILTERS
    ):
        self.variables = frozenset(variables)
        self.tree = fold(parse(source), filters)
        self._run = _Generator(filters, set(self.variables)).block(self.tree)

    def render(
        self, messages: Iterable[Mapping[str, object]], **variables: object
    ) -> Iterator[Fragment]:
        """Fragments (text, whether it lies in a generation block), none of them empty."""
        if variables.keys() != self.variables:
            raise TemplateError(f"expected the variables {sorted(self.variables)}")
        found = self._run(variables | {"messages": messages})
        return (fragment for fragment in found if fragment[0])
