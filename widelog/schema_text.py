"""Schema text, read with one scanner into statements of a kind, a name, a body and properties.

Everything asked of a schema's text (its keyspaces, user types, tables and indexes) comes from these statements. Line breaks may be
real or written as a backslash and a letter, as in text that went through JSON; other backslashes, and comments, count as space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

SCANNER = re.compile(r"""\s+|\\[nrt]?|--[^\n]*|//[^\n]*|/\*.*?\*/|("(?:[^"]|"")*"|'(?:[^']|'')*'|\w+|.)""", re.DOTALL)
OPENING, CLOSING = "(<{[", ")>}]"


@dataclass(frozen=True)
class Token:
    text: str
    spaced: bool = False  # whether something that counts as space stood before it

    @property
    def word(self) -> str:
        """Upper case of a bare word; of anything else its text."""
        return self.text.upper()

    @property
    def name(self) -> str:
        """A quoted name as it is, any other in lower case."""
        return self.text[1:-1].replace('""', '"') if self.text.startswith('"') else self.text.lower()

    @property
    def value(self) -> str:
        return self.text[1:-1].replace("''", "'") if self.text.startswith("'") else self.text


def tokens(text: str) -> Iterator[Token]:
    spaced = False
    for m in SCANNER.finditer(text):
        if m[1] is None:
            spaced = True
        else:
            yield Token(m[1], spaced)
            spaced = False


def said(some: list[Token]) -> str:
    """Tokens as text again, with one space where there was any."""
    return "".join((" " if t.spaced else "") + t.text for t in some).strip()


def parted(some: list[Token], by: str) -> list[list[Token]]:
    """Runs of tokens between those that read ``by`` outside all brackets; empty runs are left out."""
    out: list[list[Token]] = [[]]
    depth = 0
    for t in some:
        depth += (t.text in OPENING) - (t.text in CLOSING)
        if depth == 0 and t.word == by:
            out.append([])
        else:
            out[-1].append(t)
    return [x for x in out if x]


def inside(some: list[Token]) -> tuple[list[Token], list[Token]]:
    """What the bracket at the start holds, and what follows it."""
    depth = 0
    for k, t in enumerate(some):
        depth += (t.text in OPENING) - (t.text in CLOSING)
        if depth == 0:
            return some[1:k], some[k + 1 :]
    raise ValueError(f"unbalanced brackets in {said(some)[:80]!r}")


@dataclass(frozen=True)
class ColumnText:
    name: str
    type: str
    static: bool = False
    key: bool = False


@dataclass
class Statement:
    """CREATE something. For an index, keyspace and name are those of the table it is on."""

    kind: str
    keyspace: str
    name: str
    head: list[Token]
    body: list[Token] | None
    properties: list[list[Token]] = field(default_factory=list)

    def given(self, name: str) -> list[Token] | None:
        """The tokens after the equals sign of a property."""
        for p in self.properties:
            if p[0].name == name and len(p) > 2 and p[1].text == "=":
                return p[2:]
        return None

    @property
    def order(self) -> list[Token] | None:
        """The clustering order, from its first word on."""
        return next((p for p in self.properties if [t.word for t in p[:3]] == ["CLUSTERING", "ORDER", "BY"]), None)

    @property
    def descending(self) -> set[str]:
        return {x[0].name for x in parted(inside(self.order[3:])[0], ",") if x[-1].word == "DESC"} if self.order else set()

    def settings(self, name: str) -> dict[str, str]:
        """A property that is a map of strings."""
        found = self.given(name)
        if not found or found[0].text != "{":
            return {}
        pairs = [parted(x, ":") for x in parted(inside(found)[0], ",")]
        return {k[0].value: "".join(t.value for t in v) for k, v in pairs}

    def columns(self) -> tuple[list[ColumnText], list[str], list[str]]:
        """Columns as they are listed, the partition key and the clustering key."""
        if self.body is None:
            raise ValueError(f"{self.keyspace}.{self.name} lists no columns")
        columns, partition, clustering = [], [], []
        for part in parted(self.body, ","):
            if [t.word for t in part[:3]] == ["PRIMARY", "KEY", "("]:
                first, *rest = parted(inside(part[2:])[0], ",")
                partition = [x[0].name for x in (parted(inside(first)[0], ",") if first[0].text == "(" else [first])]
                clustering = [x[0].name for x in rest]
                continue
            name, kind = part[0], part[1:]
            key = [t.word for t in kind[-2:]] == ["PRIMARY", "KEY"]
            kind = kind[:-2] if key else kind
            static = bool(kind) and kind[-1].word == "STATIC"
            kind = kind[:-1] if static else kind
            if not kind:
                raise ValueError(f"cannot read column {said(part)!r}")
            columns.append(ColumnText(name.name, said(kind), static, key))
            if key:
                partition = [name.name]
        return columns, partition, clustering

    def text(self, kept: tuple[str, ...]) -> str:
        """The statement with its clustering order and of its properties those in kept."""
        some = ([self.order] if self.order else []) + [p for p in self.properties if p[0].name in kept]
        body = "" if self.body is None else f" ({said(self.body)})"
        return said(self.head) + body + (" WITH " + " AND ".join(map(said, some)) if some else "") + ";"


#: Words between CREATE and a statement's kind, and between its kind and its name.
BEFORE, AFTER = {"CUSTOM", "OR", "REPLACE"}, {"IF", "NOT", "EXISTS"}
KINDS = {"KEYSPACE", "TABLE", "COLUMNFAMILY", "TYPE", "INDEX"}


def statement(some: list[Token]) -> Statement | None:
    """One statement without its closing semicolon; None if it creates nothing that is read here."""
    if not some or some[0].word != "CREATE":
        return None
    at = 1
    while at < len(some) and some[at].word in BEFORE:
        at += 1
    if at >= len(some) or some[at].word not in KINDS:
        return None
    kind, at = some[at].word.lower().replace("columnfamily", "table"), at + 1
    if kind == "index":
        on = next((k for k in range(at, len(some)) if some[k].word == "ON"), None)
        if on is None:
            raise ValueError(f"an index on no table: {said(some)[:80]!r}")
        at = on + 1
    while at < len(some) and some[at].word in AFTER:
        at += 1
    if at >= len(some):
        raise ValueError(f"nothing is named in {said(some)[:80]!r}")
    first, keyspace, at = some[at].name, "", at + 1
    if at + 1 < len(some) and some[at].text == ".":
        keyspace, first, at = first, some[at + 1].name, at + 2
    head, rest, body = some[:at], some[at:], None
    if rest and rest[0].text == "(":
        body, rest = inside(rest)
    properties = parted(rest[1:], "AND") if rest and rest[0].word == "WITH" else []
    return Statement(kind, keyspace, first, head, body, properties)


class Schema:
    """All statements of a schema's text."""

    def __init__(self, text: str):
        found = map(statement, parted(list(tokens(text)), ";"))
        self.statements = [s for s in found if s]

    def of(self, kind: str, keyspace: str | None = None, name: str | None = None) -> list[Statement]:
        return [s for s in self.statements if s.kind == kind and keyspace in (None, s.keyspace) and name in (None, s.name)]

    def keyspaces(self, hidden: tuple[str, ...] = ("system_",)) -> set[str]:
        """Names of the keyspaces created, but for those with a hidden prefix."""
        return {s.name for s in self.of("keyspace") if not s.name.startswith(hidden)}

    def replication(self, keyspace: str) -> dict[str, str]:
        found = [s.settings("replication") for s in self.of("keyspace", name=keyspace)]
        if not found or not found[0]:
            raise ValueError(f"no replication of keyspace {keyspace}")
        return found[0]

    def table(self, keyspace: str, name: str) -> Statement:
        for s in self.of("table", keyspace, name):
            return s
        raise ValueError(f"no table {keyspace}.{name} in the schema")

    def types(self, keyspace: str) -> list[Statement]:
        return self.of("type", keyspace)

    def indexes(self, keyspace: str, table: str) -> int:
        return len(self.of("index", keyspace, table))
