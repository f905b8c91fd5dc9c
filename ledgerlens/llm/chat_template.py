"""Chat formatting: a compiler for a small, sandboxed template language.

A template is parsed into a syntax tree, constants are folded, and the tree becomes nested Python closures that render a
conversation and mark what the model is to learn (between ``generation`` tags) as spans of code points.

Language: ``{{ expr }}``; ``{% for x in expr %} .. {% endfor %}`` with loop.index, loop.first and loop.last; ``{% if %}``, ``{% elif %}``,
``{% else %}``, ``{% endif %}``; ``{% set x = expr %}``; ``{% generation %} .. {% endgeneration %}``; ``{# comment #}``.
Expressions: strings, integers, true, false, none; names; ``a.key`` and ``a[expr]``; ``+``, ``==``, ``!=``, ``<``, ``>``, ``in``, ``not``,
``and``, ``or``, ``x if c else y``; filters ``escape``, ``unescape``, ``trim``, ``upper``, ``lower``, ``length``. Nothing else can be reached: there
are no calls, and keys are looked up in dictionaries and lists only, never as Python attributes. An unknown name or key is none, and
none renders as nothing.

``escape`` makes control strings in texts harmless and can be undone: a backslash is doubled, and a control string gets a backslash
after its first character, so that no control string is left in the text.
"""

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from .common import bounded_batches


class TemplateError(ValueError):
    """The template is not valid."""


# ---- escaping


@dataclass(frozen=True)
class Controls:
    """Control strings; none contains a backslash, each has two characters at least."""

    strings: tuple[str, ...]

    def __post_init__(self) -> None:
        if any("\\" in s or len(s) < 2 for s in self.strings):
            raise TemplateError("control strings have two characters at least and no backslash")

    def pattern(self) -> str:
        return "|".join(re.escape(s) for s in sorted(self.strings, key=len, reverse=True)) or r"(?!)"

    def escape(self, text: str) -> str:
        out = re.sub(self.pattern(), lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))
        # A control string that overlaps an escaped one has lost a character to it or is met again here.
        while (again := re.sub(self.pattern(), lambda m: f"{m[0][0]}\\{m[0][1:]}", out)) != out:
            out = again
        return out

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


# ---- syntax tree


@dataclass(frozen=True)
class Node:
    """kind with its parts: expressions are const, name, get, op, filter, choice; statements text, show, loop, branch, set, learn, block."""

    kind: str
    parts: tuple = ()


TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|[.\[\]()+|<>=]))""")
WORDS = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
FILTERS: dict[str, Callable[[Any, Controls], Any]] = {
    "escape": lambda x, c: c.escape(_text(x)),
    "unescape": lambda x, c: c.unescape(_text(x)),
    "trim": lambda x, c: _text(x).strip(),
    "upper": lambda x, c: _text(x).upper(),
    "lower": lambda x, c: _text(x).lower(),
    "length": lambda x, c: len(x) if isinstance(x, (str, list, dict)) else 0,
}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.source, self.tokens, at = source, [], 0
        while source[at:].strip():
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unreadable: {source[at:].strip()[:40]}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> bool:
        found = self.peek(*values)
        self.at += found
        return found

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value} is missing in: {self.source}")

    def whole(self) -> Node:
        out = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]} in: {self.source}")
        return out

    def choice(self) -> Node:
        value = self.level(0)
        if self.take("if"):
            when = self.level(0)
            other = self.choice() if self.take("else") else Node("const", (None,))
            return Node("choice", (when, value, other))
        return value

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "in"), ("+",))

    def level(self, k: int) -> Node:
        if k == 2 and self.take("not"):
            return Node("op", ("not", self.level(2)))
        if k == len(self.LEVELS):
            return self.filtered()
        left = self.level(k + 1)
        while self.peek(*self.LEVELS[k]):
            op = self.tokens[self.at][1]
            self.at += 1
            left = Node("op", (op, left, self.level(k + 1)))
        return left

    def filtered(self) -> Node:
        value = self.primary()
        while True:
            if self.take("."):
                value = Node("get", (value, Node("const", (self.name(),))))
            elif self.take("["):
                value = Node("get", (value, self.choice()))
                self.need("]")
            elif self.take("|"):
                if (name := self.name()) not in FILTERS:
                    raise TemplateError(f"no such filter: {name}")
                value = Node("filter", (name, value))
            else:
                return value

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"a name is missing in: {self.source}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def primary(self) -> Node:
        if self.at >= len(self.tokens):
            raise TemplateError(f"unfinished: {self.source}")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Node("const", (re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.DOTALL),))
        if kind == "number":
            return Node("const", (int(value),))
        if value == "(":
            inner = self.choice()
            self.need(")")
            return inner
        if value in ("true", "false", "none"):
            return Node("const", ({"true": True, "false": False, "none": None}[value],))
        if kind == "name" and value not in WORDS:
            return Node("name", (value,))
        raise TemplateError(f"unexpected {value} in: {self.source}")


def parse(template: str) -> Node:
    """Syntax tree of a template."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", template, flags=re.DOTALL)
    tags = [p for p in pieces if p]
    at = 0

    def block(ends: tuple[str, ...]) -> tuple[Node, str]:
        nonlocal at
        out: list[Node] = []
        while at < len(tags):
            tag = tags[at]
            at += 1
            if tag.startswith("{#"):
                continue
            if tag.startswith("{{"):
                out.append(Node("show", (_Expression(tag[2:-2]).whole(),)))
            elif tag.startswith("{%"):
                body = tag[2:-2].strip().strip("-").strip()
                word = body.split(None, 1)[0] if body else ""
                rest = body[len(word) :].strip()
                if word in ends:
                    return Node("block", tuple(out)), body
                out.append(statement(word, rest))
            else:
                out.append(Node("text", (tag,)))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return Node("block", tuple(out)), ""

    def statement(word: str, rest: str) -> Node:
        if word == "for" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)):
            body, _ = block(("endfor",))
            return Node("loop", (m[1], _Expression(m[2]).whole(), body))
        if word == "if":
            branches, condition = [], _Expression(rest).whole()
            while True:
                body, end = block(("elif", "else", "endif"))
                branches.append((condition, body))
                if end == "endif":
                    return Node("branch", (tuple(branches), Node("block")))
                if end == "else":
                    other, _ = block(("endif",))
                    return Node("branch", (tuple(branches), other))
                condition = _Expression(end[4:]).whole()
        if word == "set" and (m := re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest, re.DOTALL)):
            return Node("set", (m[1], _Expression(m[2]).whole()))
        if word == "generation" and not rest:
            return Node("learn", (block(("endgeneration",))[0],))
        raise TemplateError(f"unknown statement: {word} {rest}")

    return block(())[0]


# ---- constant folding


def fold(node: Node, controls: Controls) -> Node:
    """The same tree with constant expressions computed, constant branches chosen and adjacent texts joined."""
    k, parts = node.kind, node.parts
    again = lambda n: fold(n, controls)
    if k in ("get", "op", "filter", "choice"):
        new = Node(k, tuple(again(p) if isinstance(p, Node) else p for p in parts))
        if all(p.kind == "const" for p in new.parts if isinstance(p, Node)):
            return Node("const", (_evaluator(new, controls)({}),))
        if k == "choice" and new.parts[0].kind == "const":
            return new.parts[1] if new.parts[0].parts[0] else new.parts[2]
        return new
    if k == "show":
        value = again(parts[0])
        return Node("text", (_text(value.parts[0]),)) if value.kind == "const" else Node("show", (value,))
    if k == "set":
        return Node("set", (parts[0], again(parts[1])))
    if k == "loop":
        return Node("loop", (parts[0], again(parts[1]), again(parts[2])))
    if k == "learn":
        return Node("learn", (again(parts[0]),))
    if k == "branch":
        left, other = [], again(parts[1])
        for condition, body in ((again(c), again(b)) for c, b in parts[0]):
            if condition.kind != "const":
                left.append((condition, body))
            elif condition.parts[0]:
                other = body
                break
        return Node("branch", (tuple(left), other)) if left else other
    if k == "block":
        out: list[Node] = []
        for p in map(again, parts):
            for q in p.parts if p.kind == "block" else (p,):
                if q.kind == "text" and out and out[-1].kind == "text":
                    out[-1] = Node("text", (out[-1].parts[0] + q.parts[0],))
                elif q != Node("text", ("",)):
                    out.append(q)
        return Node("block", tuple(out))
    return node


# ---- closures


def _evaluator(node: Node, controls: Controls) -> Callable[[dict], Any]:
    k, parts = node.kind, node.parts
    if k == "const":
        return lambda env, v=parts[0]: v
    if k == "name":
        return lambda env, n=parts[0]: env.get(n)
    if k == "filter":
        f, x = FILTERS[parts[0]], _evaluator(parts[1], controls)
        return lambda env: f(x(env), controls)
    if k == "choice":
        when, yes, no = (_evaluator(p, controls) for p in parts)
        return lambda env: yes(env) if when(env) else no(env)
    if k == "get":
        of, key = (_evaluator(p, controls) for p in parts)

        def get(env: dict) -> Any:
            value, at = of(env), key(env)
            if isinstance(value, dict):
                return value.get(at)
            if isinstance(value, list) and isinstance(at, int) and not isinstance(at, bool) and -len(value) <= at < len(value):
                return value[at]
            return None

        return get
    op, *sides = parts
    a, b = (_evaluator(p, controls) for p in (sides if len(sides) == 2 else sides * 2))
    if op == "not":
        return lambda env: not a(env)
    if op == "and":
        return lambda env: a(env) and b(env)
    if op == "or":
        return lambda env: a(env) or b(env)
    if op == "==":
        return lambda env: a(env) == b(env)
    if op == "!=":
        return lambda env: a(env) != b(env)
    if op == "in":
        return lambda env: isinstance(y := b(env), (str, list, dict)) and (not isinstance(y, str) or isinstance(a(env), str)) and a(env) in y
    if op in "<>":

        def compare(env: dict) -> bool:
            x, y = a(env), b(env)
            alike = isinstance(x, int) and isinstance(y, int) or isinstance(x, str) and isinstance(y, str)
            return alike and (x < y if op == "<" else x > y)

        return compare

    def add(env: dict) -> Any:
        x, y = a(env), b(env)
        return x + y if isinstance(x, int) and isinstance(y, int) else _text(x) + _text(y)

    return add


class _Output:
    """Rendered pieces with their total length, and the spans to learn."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


def _renderer(node: Node, controls: Controls) -> Callable[[dict, _Output], None]:
    k, parts = node.kind, node.parts
    if k == "text":
        return lambda env, out: out.add(parts[0])
    if k == "show":
        value = _evaluator(parts[0], controls)
        return lambda env, out: out.add(_text(value(env)))
    if k == "set":
        new = _evaluator(parts[1], controls)

        def assign(env: dict, out: _Output) -> None:
            env[parts[0]] = new(env)

        return assign
    if k == "learn":
        inner = _renderer(parts[0], controls)

        def learn(env: dict, out: _Output) -> None:
            start = out.length
            inner(env, out)
            if out.length > start:
                out.spans.append((start, out.length))

        return learn
    if k == "loop":
        name, over, body = parts[0], _evaluator(parts[1], controls), _renderer(parts[2], controls)

        def loop(env: dict, out: _Output) -> None:
            items = over(env)
            items = items if isinstance(items, list) else []
            for i, item in enumerate(items):
                body(env | {name: item, "loop": {"index": i + 1, "first": i == 0, "last": i == len(items) - 1}}, out)

        return loop
    if k == "branch":
        branches = [(_evaluator(c, controls), _renderer(b, controls)) for c, b in parts[0]]
        other = _renderer(parts[1], controls)

        def branch(env: dict, out: _Output) -> None:
            next((b for c, b in branches if c(env)), other)(env, out)

        return branch
    steps = [_renderer(p, controls) for p in parts]

    def block(env: dict, out: _Output) -> None:
        for step in steps:
            step(env, out)

    return block


def compile_template(template: str, controls: Controls) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """Function from messages (dictionaries with role and text) to the formatted text and its spans to learn."""
    render = _renderer(fold(parse(template), controls), controls)

    def run(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        render({"messages": messages}, out)
        return "".join(out.pieces), out.spans

    return run


# ---- the default format

CONTROLS = Controls(("<s>", "</s>", "[INST]", "[/INST]", "<|role|>", "<|text|>", "<|end|>"))
TEMPLATE = (
    "{% for m in messages %}"
    "{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}<s>{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}<|role|>{{ m.role | escape }}<|text|>{{ m.text | escape }}<|end|>{% endif %}"
    "{% endfor %}"
)
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|<s>(?P<assistant>.*?)</s>|<\|role\|>(?P<role>.*?)<\|text\|>(?P<text>.*?)<\|end\|>", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that the default template was given; raises if the text isn't its output."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        role = "user" if m["user"] is not None else "assistant" if m["assistant"] is not None else CONTROLS.unescape(m["role"])
        out.append((role, CONTROLS.unescape(next(x for x in (m["user"], m["assistant"], m["text"]) if x is not None))))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


# ---- over a table

FORMATTED = "conv_id {id}, n_turns long, formatted string, spans array<struct<start:long,stop:long>>"


def format_conversations(turns: DataFrame, template: str = TEMPLATE, controls: Controls = CONTROLS, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, n_turns, formatted, spans), one row for each conversation; spans are [start, stop) in code points.

    Rows are ordered by turn, then role, then text; nulls come first, and a null role or text is empty. Repeated rows are repeated
    turns. Rows with a null conv_id are one conversation. Other columns are not read. The rows are sorted by Spark, which spills, and
    streamed: a worker holds one conversation, which has to fit one string anyway.
    """
    compile_template(template, controls)  # errors show before the job
    bounded_batches(turns.sparkSession, 2000)
    kind = turns.schema[conv_id].dataType.simpleString()
    rows = turns.selectExpr(f"`{conv_id}` AS conv_id", f"`{turn}` AS turn", f"coalesce(`{role}`, '') AS role", f"coalesce(`{text}`, '') AS text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template, controls)
        nothing = object()
        now, messages, done = nothing, [], []

        def close() -> None:
            formatted, spans = render(messages)
            done.append((now, len(messages), formatted, [{"start": a, "stop": b} for a, b in spans]))

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(done, columns=["conv_id", "n_turns", "formatted", "spans"])
            done.clear()
            return out

        for batch in batches:
            for key, who, what in zip(batch["conv_id"].astype(object).where(batch["conv_id"].notna(), None), batch["role"], batch["text"], strict=True):
                if now is nothing or key != now:
                    if now is not nothing:
                        close()
                    now, messages = key, []
                messages.append({"role": who, "text": what})
            if done:
                yield frame()
        if now is not nothing:
            close()
            yield frame()

    return rows.mapInPandas(run, FORMATTED.format(id=kind))
