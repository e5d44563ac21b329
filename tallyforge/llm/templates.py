"""Chat templates: a small sandboxed template language, compiled to Python closures.

Text is copied; ``{{ expression }}`` is replaced by its value; ``{# #}`` is a comment; a ``-`` next
to a mark strips the white space beside it.  Statements::

    {% for message in messages %} ... {% endfor %}
    {% if test %} ... {% elif test %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}      the text in between is to be learned

Expressions have text, whole numbers, true, false, none, names, ``message.role`` (keys of the given
values only: no attributes, calls or imports), ``~`` and ``+`` to join, comparisons, ``in``,
``and``, ``or``, ``not`` and filters: ``upper``, ``lower``, ``trim``, ``escape``, ``line``, ``length``,
``default(x)``.

A template is parsed to a tree, constant parts of which are folded, and turned into closures that
append to a ``Sink``.  Its one loop over ``messages`` must stand at the top, and only ``loop.first``,
``loop.last`` and ``loop.index0`` say where a message is; so turns can be rendered one by one, and a
conversation of any length needs no more memory than its longest turn.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

# Control strings start with this; ``escape`` makes sure that texts do not hold it.
OPEN = "<|"


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    """``text`` without ``<|``: backslashes are doubled, and one stands between the two signs.

    A ``<`` at the end gets one too, as a ``|`` may follow.
    """
    out = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return out[:-1] + "\\<" if out.endswith("<") else out


def escape_line(text: str) -> str:
    """``escape``, and a line feed as backslash and n."""
    return escape(text).replace("\n", "\\n")


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescape_line(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


# -- tree -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """kind: what it is; value: a constant or name; parts: its sub-trees."""

    kind: str
    value: Any = None
    parts: tuple = ()


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>~+().|,\[\]=]))""")
_TEXT = {"n": "\n", "t": "\t", "r": "\r"}


def tokens(source: str) -> list[tuple[str, Any]]:
    out, at = [], 0
    while at < len(source.rstrip()):
        m = _TOKEN.match(source, at)
        if m is None:
            raise TemplateError(f"cannot read {source[at:]!r}")
        at = m.end()
        if m[1]:
            out.append(("const", int(m[1])))
        elif m[2]:
            out.append(("const", re.sub(r"\\(.)", lambda e: _TEXT.get(e[1], e[1]), m[2][1:-1], flags=re.DOTALL)))
        elif m[3]:
            out.append(("name", m[3]))
        else:
            out.append(("sign", m[4]))
    return out


FILTERS: dict[str, Callable[..., Any]] = {
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "trim": lambda v: text_of(v).strip(),
    "escape": lambda v: escape(text_of(v)),
    "line": lambda v: escape_line(text_of(v)),
    "length": lambda v: len(v or ""),
    "default": lambda v, other: other if v is None else v,
}
CONSTANTS = {"true": True, "false": False, "none": None}
COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in (b or ""),
}


def text_of(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


class Reader:
    """Parses one expression, loosest first: or, and, not, comparison, join, filters, value."""

    def __init__(self, source: str) -> None:
        self.source, self.tokens, self.at = source, tokens(source), 0

    def peek(self) -> tuple[str, Any]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)

    def take(self, *wanted: tuple[str, Any]) -> Any:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, kind: str, value: Any = None) -> Any:
        token = self.peek()
        if token[0] != kind or (value is not None and token[1] != value):
            raise TemplateError(f"expected {value or kind} in {self.source!r}")
        self.at += 1
        return token[1]

    def whole(self) -> Node:
        node = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r} in {self.source!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take(("name", "or")):
            node = Node("or", None, (node, self.both()))
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take(("name", "and")):
            node = Node("and", None, (node, self.negated()))
        return node

    def negated(self) -> Node:
        return Node("not", None, (self.negated(),)) if self.take(("name", "not")) else self.compared()

    def compared(self) -> Node:
        node = self.joined()
        sign = self.take(*(("sign", s) for s in COMPARE if s != "in"), ("name", "in"))
        return Node("compare", sign, (node, self.joined())) if sign else node

    def joined(self) -> Node:
        node = self.filtered()
        while self.take(("sign", "~"), ("sign", "+")):
            node = Node("join", None, (node, self.filtered()))
        return node

    def filtered(self) -> Node:
        node = self.single()
        while self.take(("sign", "|")):
            name, given = self.need("name"), ()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take(("sign", "(")):
                given = (self.either(),)
                self.need("sign", ")")
            if len(given) != (name == "default"):
                raise TemplateError(f"filter {name!r} in {self.source!r} has the wrong number of values")
            node = Node("filter", name, (node, *given))
        return node

    def single(self) -> Node:
        kind, value = self.peek()
        self.at += 1
        if kind == "const":
            node = Node("const", value)
        elif (kind, value) == ("sign", "("):
            node = self.either()
            self.need("sign", ")")
        elif kind == "name" and value not in ("and", "or", "not", "in"):
            node = Node("const", CONSTANTS[value]) if value in CONSTANTS else Node("name", value)
        else:
            raise TemplateError(f"a value is missing in {self.source!r}")
        while sign := self.take(("sign", "."), ("sign", "[")):
            if sign == ".":
                node = Node("key", self.need("name"), (node,))
            else:
                node = Node("key", self.need("const"), (node,))
                self.need("sign", "]")
        return node


def parse(source: str) -> Node:
    """The tree of a template."""
    root: list[Node] = []
    # Open statements: (name, head, parts so far, finished branches).
    stack: list[tuple[str, Any, list[Node], list]] = [("", None, root, [])]
    at, strip = 0, False

    def text(piece: str, strip_end: bool) -> None:
        piece = piece.lstrip() if strip else piece
        piece = piece.rstrip() if strip_end else piece
        if piece:
            stack[-1][2].append(Node("text", piece))

    for m in _TAG.finditer(source):
        group = 1 if m[2] is not None else 4 if m[5] is not None else 7
        text(source[at : m.start()], bool(m[group]))
        at, strip = m.end(), bool(m[group + 2])
        body = m[group + 1].strip()
        if group == 1:
            stack[-1][2].append(Node("print", None, (Reader(body).whole(),)))
        elif group == 4:
            _statement(body, stack)
    text(source[at:], False)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]!r} is not closed")
    return Node("block", None, tuple(root))


def _statement(body: str, stack: list) -> None:
    name, _, rest = body.partition(" ")
    if name == "for":
        m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
        if not m or len(stack) > 1:
            raise TemplateError("the loop must be 'for NAME in messages', outside other statements")
        stack.append((name, m[1], [], []))
    elif name == "if":
        stack.append((name, Reader(rest).whole(), [], []))
    elif name == "generation":
        if any(s[0] == "generation" for s in stack):
            raise TemplateError("generation within generation")
        stack.append((name, None, [], []))
    elif name == "set":
        target, eq, value = rest.partition("=")
        if not eq or not target.strip().isidentifier():
            raise TemplateError(f"cannot read {body!r}")
        stack[-1][2].append(Node("set", target.strip(), (Reader(value).whole(),)))
    elif name in ("elif", "else") and stack[-1][0] == "if":
        opened, test, parts, done = stack.pop()
        if test is None:
            raise TemplateError("something follows else")
        done.append((test, Node("block", None, tuple(parts))))
        stack.append((opened, Reader(rest).whole() if name == "elif" else None, [], done))
    elif name in ("endfor", "endif", "endgeneration") and stack[-1][0] == name[3:]:
        opened, head, parts, done = stack.pop()
        inner = Node("block", None, tuple(parts))
        if opened == "if":
            done.append((Node("const", True) if head is None else head, inner))
            node = Node("if", None, tuple(x for pair in done for x in pair))
        else:
            node = Node(opened, head, (inner,))
        stack[-1][2].append(node)
    else:
        raise TemplateError(f"unexpected {body!r}")


def fold(node: Node) -> Node:
    """The tree with constant parts replaced by their values, and neighbouring texts joined."""
    parts = tuple(map(fold, node.parts))
    node = Node(node.kind, node.value, parts)
    constant = [p.kind == "const" for p in parts]
    if node.kind in ("not", "compare", "join", "filter", "key") and all(constant):
        return Node("const", expression(node)({}))
    if node.kind in ("and", "or") and constant[0]:
        return parts[1] if bool(parts[0].value) == (node.kind == "and") else parts[0]
    if node.kind == "print" and constant[0]:
        return Node("text", text_of(parts[0].value))
    if node.kind == "if":
        kept: list[Node] = []
        for test, body in zip(parts[::2], parts[1::2]):
            if test.kind != "const" or test.value:
                kept += [test, body]
            if test.kind == "const" and test.value:
                break
        if not kept:
            return Node("block")
        return kept[1] if kept[0].kind == "const" else Node("if", None, tuple(kept))
    if node.kind == "block":
        flat: list[Node] = []
        for p in parts:
            for q in p.parts if p.kind == "block" else (p,):
                if q.kind == "text" and flat and flat[-1].kind == "text":
                    flat[-1] = Node("text", flat[-1].value + q.value)
                elif q.kind != "text" or q.value:
                    flat.append(q)
        return Node("block", None, tuple(flat))
    return node


# -- closures -------------------------------------------------------------------------------------


@dataclass
class Sink:
    """Rendered text, and the (start, end) of what is to be learned, in code points."""

    pieces: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)


def expression(node: Node) -> Callable[[dict], Any]:
    parts = [expression(p) for p in node.parts]
    value = node.value
    if node.kind == "const":
        return lambda env: value
    if node.kind == "name":
        return lambda env: env.get(value)
    if node.kind == "key":
        return lambda env: v.get(value) if isinstance(v := parts[0](env), dict) else None
    if node.kind == "or":
        return lambda env: parts[0](env) or parts[1](env)
    if node.kind == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if node.kind == "not":
        return lambda env: not parts[0](env)
    if node.kind == "compare":
        test = COMPARE[value]
        return lambda env: test(parts[0](env), parts[1](env))
    if node.kind == "join":
        return lambda env: text_of(parts[0](env)) + text_of(parts[1](env))
    apply = FILTERS[value]
    return lambda env: apply(*(p(env) for p in parts))


Render = Callable[[dict, Sink], None]


def statement(node: Node) -> Render:
    value = node.value
    if node.kind == "text":
        return lambda env, sink: sink.add(value)
    if node.kind == "print":
        given = expression(node.parts[0])
        return lambda env, sink: sink.add(text_of(given(env)))
    if node.kind == "set":
        given = expression(node.parts[0])
        return lambda env, sink: env.__setitem__(value, given(env))
    if node.kind == "if":
        branches = [(expression(t), statement(b)) for t, b in zip(node.parts[::2], node.parts[1::2])]

        def choose(env: dict, sink: Sink) -> None:
            for test, body in branches:
                if test(env):
                    return body(env, sink)

        return choose
    if node.kind == "generation":
        inner = statement(node.parts[0])

        def learned(env: dict, sink: Sink) -> None:
            start = sink.size
            inner(env, sink)
            sink.spans.append((start, sink.size))

        return learned
    bodies = [statement(p) for p in node.parts]

    def block(env: dict, sink: Sink) -> None:
        for body in bodies:
            body(env, sink)

    return block


@dataclass(frozen=True)
class Template:
    """A compiled template: what comes before the messages, for each message, and after them."""

    before: Render
    name: str
    body: Render
    after: Render

    def turn(self, message: dict, index: int, first: bool, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """The part of the output that belongs to one message, and its learned spans."""
        sink = Sink()
        if first:
            self.before({}, sink)
        loop = {"first": first, "last": last, "index0": index, "index": index + 1}
        self.body({self.name: message, "loop": loop}, sink)
        if last:
            self.after({}, sink)
        return "".join(sink.pieces), sink.spans


def compile_template(source: str) -> Template:
    """Parse, fold and compile; raises TemplateError for what the language does not have.

    Names set outside the loop cannot be used in it, and the other way round.
    """
    root = fold(parse(source))
    at = [i for i, p in enumerate(root.parts) if p.kind == "for"]
    if len(at) != 1:
        raise TemplateError("there must be one loop over messages")
    loop = root.parts[at[0]]
    outer = [Node("block", None, p) for p in (root.parts[: at[0]], root.parts[at[0] + 1 :])]
    return Template(statement(outer[0]), loop.value, statement(loop.parts[0]), statement(outer[1]))
