"""Chat formatting: a small sandboxed template language, compiled to Python closures, over conversations of any length.

    {% open %}<s>{% turn %}[INST]{{ message.text | escape }}[/INST]{% close %}</s>

Sections: what stands once at the start of a conversation, for each turn, and once at its end. In them

    {{ expression }}                               its value as text
    {% if expression %} {% elif %} {% else %} {% endif %}
    {% generation %} ... {% endgeneration %}       text that the loss is taken over
    {# comment #}

An expression has texts in quotes, whole numbers, `true`, `false`, `none`, the names `message.role`, `message.text`,
`message.turn` (in the turn section) and `conversation.id`, the operators `or`, `and`, `not`, `in`, `==`, `!=`, `<`, `<=`, `>`,
`>=`, `~` (join as text), parentheses, and filters after `|`: `escape`, `trim`, `lower`, `upper`, `length`, `default(x)`.
Nothing else can be named, called or indexed: a template reaches no attribute, function or loop of Python.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.tables import stored

# Strings that mark turns. No part of one but its first character begins another.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ASST]", "[ROLE]", "[/ROLE]")
TEMPLATE = (
    "{% open %}<s>"
    "{% turn %}"
    "{% if message.role == 'user' %}[INST]{{ message.text | escape }}[/INST]"
    "{% elif message.role == 'assistant' %}[ASST]{% generation %}{{ message.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ message.role | escape }}[/ROLE]{{ message.text | escape }}</s>"
    "{% endif %}"
    "{% close %}"
)
# Characters of a piece of a long conversation, more or less: a turn is never cut.
PIECE = 4_000_000


class TemplateError(ValueError):
    pass


class Escaping:
    """Reversible escaping of control strings: a backslash goes after the first character of each, and one more where
    backslashes stand there already. An escaped text holds no control string, and none forms at its ends."""

    def __init__(self, controls: tuple[str, ...] = CONTROLS):
        if any(len(c) < 2 or "\\" in c or {c[0] for c in controls} & set(c[1:]) for c in controls):
            raise ValueError("control strings need two characters, no backslash, and no other's first character inside")
        first = "|".join(f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in controls)
        slashed = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in controls)
        self.control = re.compile("|".join(map(re.escape, sorted(controls, key=len, reverse=True))))
        self._escape, self._unescape = re.compile(first), re.compile(slashed)

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub("", text)


# --- syntax tree ---

@dataclass(frozen=True)
class Constant:
    value: object


@dataclass(frozen=True)
class Name:
    path: str


@dataclass(frozen=True)
class Call:
    """An operator or filter of its arguments."""
    name: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, nodes); an else has a true one


@dataclass(frozen=True)
class Generation:
    body: tuple


SECTIONS = ("open", "turn", "close")
NAMES = {"open": {"conversation.id"}, "turn": {"conversation.id", "message.role", "message.text", "message.turn"}, "close": {"conversation.id"}}
_TOKEN = re.compile(r"""\s*(?:(?P<text>'[^']*'|"[^"]*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)|(?P<op>==|!=|<=|>=|[<>~|(),]))""")
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def _shown(value) -> str:
    """A value as text: none is empty."""
    return "" if value is None else str(value).lower() if isinstance(value, bool) else str(value)


def _ordered(compare: Callable) -> Callable:
    """Values of different kinds are in no order, and unequal."""
    def run(a, b):
        try:
            return compare(a, b)
        except TypeError:
            return False
    return run


# Operators and filters that see all their arguments, by name and number of arguments.
FUNCTIONS: dict[tuple[str, int], Callable] = {
    **{(name, 2): _ordered(compare) for name, compare in _COMPARE.items()},
    ("not", 1): operator.not_, ("in", 2): lambda a, b: _shown(a) in _shown(b), ("~", 2): lambda a, b: _shown(a) + _shown(b),
    ("trim", 1): lambda a: _shown(a).strip(), ("lower", 1): lambda a: _shown(a).lower(), ("upper", 1): lambda a: _shown(a).upper(),
    ("length", 1): lambda a: len(_shown(a)), ("default", 2): lambda a, b: b if a is None else a,
}


class _Expression:
    """Recursive descent over one expression: or < and < not < comparison < ~ < filters."""

    def __init__(self, source: str, names: set[str]):
        self.tokens, self.at, self.names, self.source = [], 0, names, source
        end = 0
        while source[end:].strip():
            found = _TOKEN.match(source, end)
            if not found:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            end = found.end()

    def parse(self):
        value = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return value

    def _take(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _need(self, text: str) -> None:
        if not self._take(text):
            raise TemplateError(f"{text!r} is missing in {self.source!r}")

    def _chain(self, name: str, below: Callable):
        value = below()
        while self._take(name):
            value = Call(name, (value, below()))
        return value

    def _or(self):
        return self._chain("or", lambda: self._chain("and", self._not))

    def _not(self):
        return Call("not", (self._not(),)) if self._take("not") else self._compared()

    def _compared(self):
        value = self._joined()
        while name := self._take(*_COMPARE, "in"):
            value = Call(name, (value, self._joined()))
        return value

    def _joined(self):
        return self._chain("~", self._filtered)

    def _filtered(self):
        value = self._atom()
        while self._take("|"):
            if self.at == len(self.tokens) or self.tokens[self.at][0] != "name":
                raise TemplateError(f"a filter is missing in {self.source!r}")
            name, args = self.tokens[self.at][1], [value]
            self.at += 1
            if self._take("("):
                while not self._take(")"):
                    args.append(self._or())
                    if not self._take(","):
                        self._need(")")
                        break
            if name != "escape" and (name, len(args)) not in FUNCTIONS or not name.isidentifier() or name in ("in", "not"):
                raise TemplateError(f"no filter {name!r} of {len(args) - 1} arguments")
            if name == "escape" and len(args) > 1:
                raise TemplateError("escape takes no arguments")
            value = Call(name, tuple(args))
        return value

    def _atom(self):
        if self._take("("):
            value = self._or()
            self._need(")")
            return value
        if self.at == len(self.tokens):
            raise TemplateError(f"a value is missing in {self.source!r}")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Constant(text[1:-1])
        if kind == "number":
            return Constant(int(text))
        if kind == "name" and text in ("true", "false", "none"):
            return Constant({"true": True, "false": False, "none": None}[text])
        if kind == "name" and text in self.names:
            return Name(text)
        raise TemplateError(f"{text!r} cannot be used here")


def parse(source: str) -> dict[str, tuple]:
    """The syntax tree: nodes of each section. Raises TemplateError on anything outside the language."""
    parts = re.split(r"(\{%.*?%\}|\{\{.*?\}\}|\{#.*?#\})", source, flags=re.S)
    sections: dict[str, tuple] = {}
    section, nodes = None, []
    stack: list[tuple[str, list, list]] = []  # kind, branches, nodes around

    def closed_section() -> None:
        if stack:
            raise TemplateError(f"{stack[-1][0]} is not ended")
        if section is not None:
            sections[section] = tuple(nodes)

    for part in parts:
        tag, body = part[:2], part[2:-2].strip()
        if tag == "{#" or not part:
            continue
        if tag == "{%":
            word, _, rest = body.partition(" ")
            if word in SECTIONS:
                closed_section()
                if word in sections:
                    raise TemplateError(f"section {word} stands twice")
                section, nodes = word, []
                if rest:
                    raise TemplateError(f"unexpected {rest!r}")
                continue
        if section is None:
            if part.strip():
                raise TemplateError("text before the first section")
            continue
        names = NAMES[section]
        if tag == "{{":
            nodes.append(Output(_Expression(body, names).parse()))
        elif tag != "{%":
            nodes.append(Output(Constant(part)))
        elif word == "if":
            stack.append(("if", [(_Expression(rest, names).parse(), own := [])], nodes))
            nodes = own
        elif word in ("elif", "else") and stack and stack[-1][0] == "if" and stack[-1][1][-1][0] is not None:
            condition = _Expression(rest, names).parse() if word == "elif" else None
            if word == "else" and rest:
                raise TemplateError(f"unexpected {rest!r}")
            stack[-1][1].append((condition, own := []))
            nodes = own
        elif body == "generation":
            if any(kind == "generation" for kind, _, _ in stack):
                raise TemplateError("generation inside generation")
            stack.append(("generation", nodes, nodes))
            nodes = []
        elif stack and body == f"end{stack[-1][0]}":
            kind, branches, around = stack.pop()
            if kind == "if":
                around.append(If(tuple((Constant(True) if c is None else c, tuple(b)) for c, b in branches)))
            else:
                around.append(Generation(tuple(nodes)))
            nodes = around
        else:
            raise TemplateError(f"unexpected {body!r}")
    closed_section()
    return {name: sections.get(name, ()) for name in SECTIONS}


# --- folding ---

def fold(node, escape: Callable[[str], str]):
    """An expression with its constant parts worked out; `or` and `and` give the value that decides."""
    if not isinstance(node, Call):
        return node
    args = tuple(fold(a, escape) for a in node.args)
    if node.name in ("or", "and") and isinstance(args[0], Constant):
        return args[1] if bool(args[0].value) == (node.name == "and") else args[0]
    if node.name not in ("or", "and") and all(isinstance(a, Constant) for a in args):
        return Constant(_function(node.name, len(args), escape)(*[a.value for a in args]))
    return Call(node.name, args)


def _function(name: str, size: int, escape: Callable[[str], str]) -> Callable:
    return (lambda a: escape(_shown(a))) if name == "escape" else FUNCTIONS[name, size]


def fold_nodes(nodes: tuple, escape: Callable[[str], str]) -> tuple:
    """Nodes with constants worked out: decided branches stand in place of their condition, neighbouring texts are one."""
    out: list = []
    for node in nodes:
        if isinstance(node, Output):
            value = fold(node.value, escape)
            new = [Output(Constant(_shown(value.value)) if isinstance(value, Constant) else value)]
        elif isinstance(node, Generation):
            new = [Generation(fold_nodes(node.body, escape))]
        else:
            branches, new = [], []
            for condition, body in node.branches:
                condition = fold(condition, escape)
                if isinstance(condition, Constant) and not condition.value:
                    continue
                branches.append((condition, fold_nodes(body, escape)))
                if isinstance(condition, Constant):
                    break
            if branches and isinstance(branches[0][0], Constant):
                new = list(branches[0][1])
            elif branches:
                new = [If(tuple(branches))]
        for n in new:
            text = isinstance(n, Output) and isinstance(n.value, Constant)
            if text and out and isinstance(out[-1], Output) and isinstance(out[-1].value, Constant):
                out[-1] = Output(Constant(out[-1].value.value + n.value.value))
            elif not text or n.value.value:
                out.append(n)
    return tuple(out)


# --- closures ---

Values = dict[str, object]


def _value(node, escape: Callable[[str], str]) -> Callable[[Values], object]:
    if isinstance(node, Constant):
        return lambda values, constant=node.value: constant
    if isinstance(node, Name):
        return operator.itemgetter(node.path)
    args = [_value(a, escape) for a in node.args]
    if node.name in ("or", "and"):
        a, b = args
        return (lambda v: a(v) or b(v)) if node.name == "or" else (lambda v: a(v) and b(v))
    run = _function(node.name, len(args), escape)
    if len(args) == 1:
        return lambda v, a=args[0]: run(a(v))
    return lambda v, a=args[0], b=args[1]: run(a(v), b(v))


class _Page:
    """Text as it is put together, and the spans of it under the loss mask."""

    def __init__(self):
        self.parts, self.size, self.spans = [], 0, []

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _closures(nodes: tuple, escape: Callable[[str], str]) -> Callable[[Values, _Page], None]:
    """One function that renders the nodes in turn."""
    def closure(node) -> Callable[[Values, _Page], None]:
        if isinstance(node, Output):
            if isinstance(node.value, Constant):
                return lambda values, page, text=node.value.value: page.add(text)
            value = _value(node.value, escape)
            return lambda values, page: page.add(_shown(value(values)))
        if isinstance(node, Generation):
            body = _closures(node.body, escape)

            def generation(values: Values, page: _Page) -> None:
                start = page.size
                body(values, page)
                page.spans.append((start, page.size))

            return generation
        branches = [(_value(c, escape), _closures(b, escape)) for c, b in node.branches]

        def decide(values: Values, page: _Page) -> None:
            for condition, body in branches:
                if condition(values):
                    body(values, page)
                    return

        return decide

    made = [closure(n) for n in nodes]

    def run(values: Values, page: _Page) -> None:
        for each in made:
            each(values, page)

    return run


class Template:
    """A compiled template: `open`, `turn` and `close` write to a page."""

    def __init__(self, source: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS):
        escape = Escaping(controls).escape
        self.tree = {name: fold_nodes(nodes, escape) for name, nodes in parse(source).items()}
        self._run = {name: _closures(nodes, escape) for name, nodes in self.tree.items()}

    def section(self, name: str, conv_id, page: _Page, role=None, text=None, turn=None) -> None:
        self._run[name]({"conversation.id": conv_id, "message.role": role, "message.text": text, "message.turn": turn}, page)

    def render(self, conv_id, turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
        """A whole conversation: its text and the spans under the loss mask."""
        page = _Page()
        self.section("open", conv_id, page)
        for k, (role, text) in enumerate(turns):
            self.section("turn", conv_id, page, role or "", text or "", k)
        self.section("close", conv_id, page)
        return "".join(page.parts), page.spans


# --- conversations as rows ---

_PIECES = "conv_id bigint, part bigint, n bigint, formatted string, spans array<struct<start:bigint,end:bigint>>, whole boolean"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECE_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("formatted", pa.string()), ("spans", _SPANS), ("whole", pa.bool_()),
])
_OPEN, _TURN, _CLOSE = 0, 1, 2


def format_conversations(conversations: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS, piece: int = PIECE) -> DataFrame:
    """`conv_id, part, n, formatted, spans, whole` of `conv_id, turn, role, text` rows.

    A conversation is formatted by the template, turns in order (null turns first; ties by role and text). It is one
    row, `whole`, unless it is long or lies on the border of two tasks: then it comes in pieces, in order of `part, n`.
    `spans` are the places, in characters of `formatted`, of what the loss is taken over. Null roles and texts are empty;
    rows without a conversation are one conversation, null; repeated rows are turns each; no rows: none.

    Rows are dealt out in ranges of (conversation, turn), so that turns of a long conversation go to several tasks, and
    are read in order: a task holds one piece, not one conversation. The start and end of a conversation are rows of
    their own, made from the distinct ids.
    """
    Template(template, controls)  # a bad template fails here
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.lit(_TURN).alias("kind"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    edge = F.explode(F.array(F.lit(_OPEN), F.lit(_CLOSE))).alias("kind")
    edges = turns.select("conv_id").distinct().select("conv_id", edge).select(
        "conv_id", "kind", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text")
    )
    order = ["conv_id", "kind", "turn", "role", "_h"]
    rows = turns.unionByName(edges).withColumn("_h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").withColumn("part", F.spark_partition_id().cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Template(template, controls)
        waiting: list[tuple] = []
        page, conv, n, opened, first = _Page(), None, 0, False, True
        part = None

        def ended(closed: bool) -> None:
            nonlocal page, n, opened
            if page.parts or page.spans or opened or n:
                waiting.append((conv, part, n, "".join(page.parts), [{"start": a, "end": b} for a, b in page.spans], opened and closed and n == 0))
            page, n, opened = _Page(), n + 1, False

        for batch in batches:
            for row in zip(*batch.columns):
                conv_id, kind, turn, role, text, part = (c.as_py() for c in row)
                if first or kind == _OPEN or conv_id != conv:
                    if not first and page.parts:
                        ended(False)
                    page, conv, n, opened, first = _Page(), conv_id, 0, kind == _OPEN, False
                made.section(("open", "turn", "close")[kind], conv_id, page, role, text, turn)
                if kind == _CLOSE:
                    ended(True)
                    page, n = _Page(), 0
                    first = True
                elif page.size >= piece:
                    ended(False)
                if sum(len(w[3]) for w in waiting) >= piece or len(waiting) >= 1_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), _PIECE_SCHEMA)], schema=_PIECE_SCHEMA)
                    waiting.clear()
        if not first and page.parts:
            ended(False)
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), _PIECE_SCHEMA)], schema=_PIECE_SCHEMA)

    return dealt.select("conv_id", "kind", "turn", "role", "text", "part").mapInArrow(run, _PIECES)


def read_turns(formatted: str, escaping: Escaping) -> list[tuple[str, str]]:
    """Role and text of the turns in a text made by TEMPLATE, by its unescaped control strings alone."""
    marks = [(m[0], m.start(), m.end()) for m in escaping.control.finditer(formatted)]
    turns: list[tuple[str, str]] = []
    role = None
    for (mark, _, end), following in zip(marks, [*marks[1:], ("", len(formatted), len(formatted))]):
        text = escaping.unescape(formatted[end:following[1]])
        if mark == "[INST]":
            turns.append(("user", text))
        elif mark == "[ASST]":
            turns.append(("assistant", text))
        elif mark == "[ROLE]":
            role = text
        elif mark == "[/ROLE]":
            turns.append((role, text))
    return turns


def read_back(pieces: DataFrame, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """`conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars` of what `format_conversations` made by TEMPLATE.

    Turns are read from the formatted text, unescaped; the loss text is what the spans cover, unescaped. A whole row is
    digested where it stands. Pieces are turned into what their digests run over, dealt out by conversation, and
    digested in order of the pieces as a stream that holds a piece at a time: a digest has one task by its nature.
    """
    fields = [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("n_turns", pa.int64()), ("loss_chars", pa.int64()),
        ("formatted_chars", pa.int64()), ("turns", pa.string()), ("loss", pa.string()), ("whole", pa.bool_()),
    ]
    schema = pa.schema(fields)
    ddl = "conv_id bigint, part bigint, n bigint, n_turns bigint, loss_chars bigint, formatted_chars bigint, turns string, loss string, whole boolean"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escaping = Escaping(controls)
        for batch in batches:
            rows = []
            for row in zip(*batch.columns):
                conv, part, n, text, spans, whole = (c.as_py() for c in row)
                turns = read_turns(text, escaping)
                stream = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(escaping.unescape(text[s["start"]:s["end"]]) for s in spans)
                chars = len(loss)
                if whole:
                    stream, loss = _sha256(stream), _sha256(loss)
                rows.append((conv, part, n, len(turns), chars, len(text), stream, loss, whole))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    out_schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, state, seen = None, None, False

        def ended() -> None:
            if seen:
                done.append((conv, state[0], state[3].hexdigest(), state[1], state[4].hexdigest(), state[2]))

        for batch in batches:
            for row in zip(*batch.columns):
                conv_id, n_turns, loss_chars, formatted_chars, turns, loss = (c.as_py() for c in row)
                if not seen or conv_id != conv:
                    ended()
                    conv, state, seen = conv_id, [0, 0, 0, hashlib.sha256(), hashlib.sha256()], True
                for k, x in enumerate((n_turns, loss_chars, formatted_chars)):
                    state[k] += x
                state[3].update(turns.encode("utf-8", "surrogatepass"))
                state[4].update(loss.encode("utf-8", "surrogatepass"))
        ended()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out_schema)], schema=out_schema)

    out = ["conv_id", "n_turns", F.col("turns").alias("turns_sha256"), "loss_chars", F.col("loss").alias("loss_sha256"), "formatted_chars"]
    parts = stored(pieces.select("conv_id", "part", "n", "formatted", "spans", "whole").mapInArrow(read, ddl), "read")
    streams = parts.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "n")
    digested = streams.select("conv_id", "n_turns", "loss_chars", "formatted_chars", "turns", "loss").mapInArrow(
        digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    return parts.filter("whole").select(*out).unionByName(digested)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def probe(spark, text: str, conv_id: int = -1) -> DataFrame:
    """A conversation of a user and an assistant who both say `text`."""
    said: Column = F.lit(text)
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(conv_id).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
