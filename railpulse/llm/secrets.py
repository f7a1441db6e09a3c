"""Secrets in text and source code, found by pattern and by reading assignments.

Three patterns give the base spans. Beyond them the text is read as source or
configuration, and name-literal pairs are lexed out of it:

* targets: names, quoted names, ``box['name'] =``, ``name: type =``, ``--name value``,
  ``#define NAME``, ``setName(``, ``("name", ``, elements and attributes of XML;
* values: literals of one or three quotes with prefixes and escapes, next to each other or
  joined by ``+``, ``.``, ``..``, ``&`` or ``||``, in parentheses or on a following line,
  holes of formatted literals, block values of YAML, bare words of configuration.

A name that was given literals earlier stands for them, so constants are followed to where
they were written. A constant is known from its line to the first line indented less than
it. Calls, indexes, attribute chains and bare names without a digit are no literals. A pair
counts if its name sounds like a credential and its literals look like one; every literal
gets the best score of the pairs it is part of. No value is too long, and no step's cost
grows faster than the text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base kinds in the order that breaks ties, their patterns and the
# number of characters that the match (of assign: its value) must have.
BASE = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        6,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN_HINTS = ("passw", "secret", "token", "api")

#: How sensitive a part of a target name is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6,
    "authorization": 0.8, "bearer": 0.8, "private": 0.6, "key": 0.5, "signing": 0.6,
    "access": 0.4, "encryption": 0.5, "salt": 0.5, "pin": 0.4, "pass": 0.7,
}
#: Name parts that speak of something about a credential, not of its value.
HARMLESS = frozenset(
    "count limit length len size max min url uri path file name id type ttl expiry timeout "
    "public column field index header policy hint prompt label".split()
)
PLACEHOLDERS = re.compile(
    r"(?i)^(?:x+|\*+|\.+|change_?me|example|placeholder|redacted|none|null|true|false|todo|"
    r"your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)$"
)
LEAST_SCORE = 0.5
LEAST_LITERAL = 6

# Of a value longer than :data:`_SHOWN` characters only both ends are at hand.
_SHOWN = 64
_FRAMED = re.compile(r"(?i)^(?:your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%)$", re.DOTALL)

_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_NAME = r"[A-Za-z_$][A-Za-z0-9_$.-]*+"
# A name starts behind a quote or where no name runs already, and its run is never given
# back, so a long run of letters is read once.
_HEAD = re.compile(
    rf"""(?:(?P<quote>["'`])(?P<quoted>{_NAME})(?P=quote)(?:[\x20\t]*+\])?"""
    rf"""|(?<![A-Za-z0-9_$.-])(?P<dash>-{{1,2}}+)?(?P<bare>{_NAME}))"""
    r"""(?:(?P<blank>(?(dash)[\x20\t]++(?=[^\s=:-])|(?!)))"""
    r"""|[\x20\t]*+(?P<op>:=|=>|=(?![=~])|:(?!:|//)|,|\((?=[\x20\t]*+["'`]))"""
    r"""[\x20\t]*+(?=\S|\r?\n[\x20\t]*+["'`]))"""
    rf"""|\#[\x20\t]*+define[\x20\t]++(?P<define>{_NAME})[\x20\t]++"""
)
_SETTER = re.compile(r"(?:.*\.)?set_?(?=[A-Za-z])", re.IGNORECASE)
_TYPED = re.compile(r"""&?[A-Za-z_][A-Za-z0-9_.\[\]<>|?&\x20\t]{0,60}?=[\x20\t]*+(?=[A-Za-z@$]{0,2}["'`])""")
_BLOCK = re.compile(r"[|>][0-9+-]{0,2}[\x20\t]*+(?:\#[^\n]*+)?\r?\n")
_LINE = re.compile(r"[\x20\t]*+([^\n]*+)(?:\n|\Z)")
_INDENT = re.compile(r"^[\x20\t]*+(?=[^\s])", re.MULTILINE)
_ARMOUR = re.compile(r"-{5}(?:BEGIN|END) [A-Z0-9 ]+-{5}\Z")
_CONTINUED = re.compile(r"[\x20\t]*+(?:\\\r?\n\s*+)?")
_OPENED = re.compile(r"\(\s*+")
_BELOW = re.compile(r"\r?\n[\x20\t]*+")
_LITERAL = re.compile(
    r"""(?P<prefix>[rRbBuUfF]{1,2}|u8|L|@|\$@?|)"""
    r"""(?:(?P<triple>\"{3}|'{3})|(?P<body>"(?:[^"\\\n]|\\[\s\S])*+"|'(?:[^'\\\n]|\\[\s\S])*+'|`(?:[^`\\\n]|\\[\s\S])*+`))"""
)
_BARE = re.compile(r"[^\s\"'`,;+(){}\[\]<>]+")
_JOINED = re.compile(r"""[\x20\t]*+(?:\+|\.\.?(?=\s*+["'$])|&(?!&)|\|\|)[\x20\t]*+(?:\\?\r?\n\s*+)?""")
_JOINED_INSIDE = re.compile(r"\s*+(?:\+|\.\.?|&(?!&)|\|\|)\s*+")
_BESIDE = re.compile(r"""[\x20\t]*+(?:\\\r?\n\s*+)?(?=[A-Za-z@$0-9]{0,2}["'`])""")
_BESIDE_INSIDE = re.compile(r"""\s*+(?=[A-Za-z@$0-9]{0,2}["'`])""")
_ANOTHER_NAME = re.compile(r"[\x20\t]*+[:=]")
_HOLE = re.compile(r"\$?\{\s*+([A-Za-z_$][A-Za-z0-9_$.]*+)?[^{}]*+\}")
_REFERENCE = re.compile(r"\$\{?([A-Za-z_][A-Za-z0-9_]*+)\}?\Z")
_ESCAPE = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4})|(\r?\n)|([\s\S]))")
# A bare name without a digit, or names chained by dots and arrows.
_CHAIN = re.compile(
    r"\$?[A-Za-z_]++\Z|(?:[A-Za-z_$][A-Za-z0-9_$]*+(?:\.|->|::))++[A-Za-z_$][A-Za-z0-9_$]*+\Z"
)

_TAG = re.compile(r"<(?P<tag>[A-Za-z_][A-Za-z0-9_.:-]*+)(?P<attributes>(?:\s[^<>]*+)?)>")
_BODY = re.compile(r"\s*+(?:<!\[CDATA\[(?P<data>[^<\]]*+)\]\]>|(?P<text>[^<]*+))\s*+</(?P<tag>[A-Za-z0-9_.:-]++)")
_ATTRIBUTE = re.compile(r"""(?<![A-Za-z0-9_.:-])(?P<key>[A-Za-z_][A-Za-z0-9_.:-]*+)\s*+=\s*+(?:"(?P<two>[^"]*+)"|'(?P<one>[^']*+)')""")


@lru_cache(maxsize=1 << 14)
def name_score(name: str) -> float:
    """Sensitivity of a target name, from its parts in snake, kebab or camel case."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    if not parts or parts[-1] in HARMLESS:
        return 0.0
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


class Look(NamedTuple):
    """What scoring needs of a value; looks of parts add up to that of their sum.

    ``counts`` has a place for each ASCII character and 128 for all others.
    """

    length: int
    counts: dict[int, int]
    blank: bool
    head: str
    tail: str

    @classmethod
    def of(cls, value: str) -> Look:
        counts: dict[int, int] = {}
        for character, n in Counter(value).items():
            place = ord(character) if character < "\x80" else 128 + ord(character) % 128
            counts[place] = counts.get(place, 0) + n
        blank = re.search(r"\s", value) is not None
        return cls(len(value), counts, blank, value[:_SHOWN], value[-_SHOWN:])

    def then(self, other: Look) -> Look:
        counts = dict(self.counts)
        for place, n in other.counts.items():
            counts[place] = counts.get(place, 0) + n
        return Look(
            self.length + other.length,
            counts,
            self.blank or other.blank,
            (self.head + other.head)[:_SHOWN] if self.length < _SHOWN else self.head,
            (self.tail + other.tail)[-_SHOWN:],
        )

    def score(self) -> float:
        n = self.length
        if n < LEAST_LITERAL or self.blank:
            return 0.0
        if PLACEHOLDERS.match(self.head) if n <= _SHOWN else _FRAMED.match(self.head + self.tail):
            return 0.0
        bits = -sum(c / n * math.log2(c / n) for c in self.counts.values())
        classes = len({_class_of(place) for place in self.counts})
        return min(1.0, bits / 4 + 0.15 * (classes - 1))


def _class_of(place: int) -> str:
    character = chr(place) if place < 128 else ""
    if character.islower():
        return "lower"
    if character.isupper():
        return "upper"
    return "digit" if character.isdigit() else "other"


def literal_score(value: str) -> float:
    """How much a literal looks like a credential: long enough, no prose or placeholder,
    and characters that vary."""
    return Look.of(value).score()


class Value(NamedTuple):
    """A literal's place and text, or the numbers of the values it is put together from."""

    look: Look
    span: tuple[int, int] | None
    text: str
    parts: tuple[int, ...]


class Reader:
    """Name-literal pairs of one text: ``pairs`` holds (name, number of the value).

    A value is only put together from earlier ones, so whatever holds for a value is
    passed on to its parts by one walk from the last value to the first.
    """

    def __init__(self, text: str):
        self.text = text
        self.values: list[Value] = []
        self.pairs: list[tuple[str, int]] = []
        self._scopes: list[tuple[int, dict[str, int]]] = [(0, {})]
        self._never: set[str] = set()
        if "=" in text or ":" in text or "--" in text or "#" in text or "(" in text:
            self._read_assignments()
        if "</" in text or "/>" in text:
            self._read_elements()

    # --- values

    def _literal(self, start: int, end: int, value: str | None = None) -> int:
        value = self.text[start:end] if value is None else value
        self.values.append(Value(Look.of(value), (start, end), value, ()))
        return len(self.values) - 1

    def _sum(self, parts: list[int]) -> int | None:
        if len(parts) < 2:
            return parts[0] if parts else None
        look = self.values[parts[0]].look
        for part in parts[1:]:
            look = look.then(self.values[part].look)
        self.values.append(Value(look, None, "", tuple(parts)))
        return len(self.values) - 1

    def _constant(self, name: str) -> int | None:
        for _, names in reversed(self._scopes):
            if name in names:
                return names[name]
        return None

    def _quoted(self, found: re.Match) -> tuple[list[int], int] | None:
        """Values of a quoted literal and its end."""
        text, prefix = self.text, found["prefix"].lower()
        if mark := found["triple"]:
            start = found.end()
            end = -1 if mark in self._never else text.find(mark, start)
            if end < 0:  # nor will any later one be closed
                self._never.add(mark)
                return None
            after = end + 3
        else:
            start, end, after = found.start("body") + 1, found.end() - 1, found.end()
            mark = text[start - 1]
        whole = text[start:end]
        if (reference := _REFERENCE.match(whole)) and (known := self._constant(reference[1])) is not None:
            return [known], after
        if ("f" in prefix or prefix.startswith("$") or mark == "`") and "{" in whole:
            return self._holes(start, whole), after
        value = whole if "r" in prefix or "\\" not in whole else _ESCAPE.sub(_unescaped, whole)
        return [self._literal(start, end, value)], after

    def _holes(self, start: int, whole: str) -> list[int]:
        parts, at = [], 0
        for hole in _HOLE.finditer(whole):
            if hole.start() > at:
                parts.append(self._literal(start + at, start + hole.start()))
            at = hole.end()
            if hole[1] and (known := self._constant(hole[1])) is not None:
                parts.append(known)
        if at < len(whole):
            parts.append(self._literal(start + at, start + len(whole)))
        return parts

    def _value(self, at: int, quoted_only: bool) -> int | None:
        """The value that starts at a place, None where no literal is part of it."""
        text, parts, several = self.text, [], False
        at = _CONTINUED.match(text, at).end()
        inside = _OPENED.match(text, at)
        if inside:
            at = inside.end()
        elif below := _BELOW.match(text, at):
            found = _LITERAL.match(text, below.end())
            if not found or _ANOTHER_NAME.match(text, found.end()):
                return None  # a name on a line of its own, not a value
            at = below.end()
        word: tuple[int, int] | None = None
        while True:
            beside = False
            if (found := _LITERAL.match(text, at)) and (got := self._quoted(found)):
                more, at = got
                parts += more
                beside = True
            elif not quoted_only and (found := _BARE.match(text, at)):
                start, at = at, found.end()
                name = found[0]
                known = self._constant(name)
                if known is None and name.startswith("$"):
                    known = self._constant(name[1:])
                if text[at : at + 1] in ("(", "[", "{"):
                    break  # a call or an index: what it gives is not written here
                if known is not None:
                    parts.append(known)
                elif not several and not inside:
                    word = (start, at)
            else:
                break
            joined = (_JOINED_INSIDE if inside else _JOINED).match(text, at)
            if not joined and beside:
                joined = (_BESIDE_INSIDE if inside else _BESIDE).match(text, at)
            if not joined:
                break
            several, at = True, joined.end()
        if word and not several and not parts and not _CHAIN.match(text[word[0] : word[1]]):
            parts.append(self._literal(*word))
        return self._sum(parts)

    def _block(self, at: int, indent: int) -> tuple[int | None, int]:
        """The value of the lines below that are indented more, and their end."""
        text, parts = self.text, []
        while at < len(text) and (line := _LINE.match(text, at)):
            content = line[1].rstrip()
            if content:
                if line.start(1) - at <= indent:
                    break
                if not _ARMOUR.match(content):
                    parts.append(self._literal(line.start(1), line.start(1) + len(content)))
            at = line.end()
        return self._sum(parts), at

    # --- targets

    def _read_assignments(self) -> None:
        text, at, line, indent, seen = self.text, 0, -1, 0, 0
        while found := _HEAD.search(text, at):
            at = found.end()
            new = max(line, text.rfind("\n", seen, found.start()) + 1)
            if new > line:
                if len(self._scopes) > 1:
                    # Lines without a pair end scopes as well.
                    for other in _INDENT.finditer(text, seen, new):
                        self._leave(other.end() - other.start())
                line, indent = new, _INDENT.match(text, new).end() - new
                self._leave(indent)
            seen = found.start()
            op, name = found["op"], found["quoted"] or found["bare"] or found["define"]
            if op == "," and not (found["quoted"] and text[found.start() - 1 : found.start()] == "("):
                continue
            if op == "(":
                if found["quoted"] or not (setter := _SETTER.match(name)):
                    continue
                name = name[setter.end() :]
            if op == ":":
                if typed := _TYPED.match(text, at):
                    at = typed.end()
                elif block := _BLOCK.match(text, at):
                    if name_score(name):
                        value, at = self._block(block.end(), indent)
                        if value is not None:
                            self.pairs.append((name, value))
                    continue
            # A bare word may itself be the name of a pair: its text is read again.
            value = self._value(at, quoted_only=op in (",", "("))
            if value is not None:
                self.pairs.append((name, value))
                if op not in (",", "("):
                    self._define(name, value, indent)

    def _leave(self, indent: int) -> None:
        while self._scopes[-1][0] > indent:
            self._scopes.pop()

    def _define(self, name: str, value: int, indent: int) -> None:
        if self._scopes[-1][0] < indent:
            self._scopes.append((indent, {}))
        self._scopes[-1][1][name] = value

    def _read_elements(self) -> None:
        for tag in _TAG.finditer(self.text):
            name, key = tag["tag"], None
            for found in _ATTRIBUTE.finditer(tag["attributes"]):
                side = "two" if found["two"] is not None else "one"
                if found["key"].lower() in ("name", "key", "id"):
                    key = found[side]
                elif found["key"].lower() == "value" and key:
                    start = tag.start("attributes") + found.start(side)
                    self.pairs.append((key, self._literal(start, start + len(found[side]))))
            body = None if tag["attributes"].endswith("/") else _BODY.match(self.text, tag.end())
            if body and body["tag"] == name:
                side = "data" if body["data"] is not None else "text"
                start, content = body.start(side), body[side].rstrip()
                if content and (sensitive := [n for n in (key, name) if n and name_score(n)]):
                    self.pairs.append((sensitive[0], self._literal(start, start + len(content))))

    # --- results

    def written(self, number: int) -> Iterator[Value]:
        """The literals that a value is put together from, in order."""
        left = [number]
        while left:
            value = self.values[left.pop()]
            if value.span:
                yield value
            left += reversed(value.parts)

    def scores(self) -> Iterator[tuple[int, int, float]]:
        """(start, end, score) of every literal that counts as a secret."""
        best = [0.0] * len(self.values)
        for name, number in self.pairs:
            if sense := name_score(name):
                score = sense * self.values[number].look.score()
                if score >= LEAST_SCORE:
                    best[number] = max(best[number], score)
        for number in range(len(best) - 1, -1, -1):
            if best[number]:
                value = self.values[number]
                if value.span and value.span[1] > value.span[0]:
                    yield *value.span, best[number]
                for part in value.parts:
                    best[part] = max(best[part], best[number])


def _unescaped(found: re.Match) -> str:
    if code := found[1] or found[2]:
        return chr(int(code, 16))
    if found[3]:
        return ""
    return {"n": "\n", "t": "\t", "r": "\r"}.get(found[4], found[4])


def pairs(text: str) -> Iterator[tuple[str, str, list[tuple[int, int]]]]:
    """(target name, value, spans of the literals it is made of), in reading order.

    Values are written out here; :func:`spans_of` scores them without.
    """
    reader = Reader(text)
    for name, number in reader.pairs:
        literals = list(reader.written(number))
        yield name, "".join(v.text for v in literals), [v.span for v in literals]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the pattern matches."""
    found = []
    for kind, (name, pattern, group, least) in enumerate(BASE):
        if name == "access" and "AKIA" not in text:
            continue
        if name == "assign":
            low = text.lower()
            if not any(h in low for h in _ASSIGN_HINTS):
                continue
        found += [
            (m.start(), m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least
        ]
    return found


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every secret in a text, by start, then kind.

    A literal that a base span covers already is not given again.
    """
    if not text:
        return []
    base = base_spans(text)
    starts = sorted(a for a, _, _ in base)
    reach = list(accumulate((b for _, b, _ in sorted(base)), max))
    scored = {(a, b, k): 1.0 for a, b, k in base}
    for a, b, score in Reader(text).scores():
        before = bisect_right(starts, a)
        if not (before and reach[before - 1] >= b):
            key = (a, b, len(BASE))
            scored[key] = max(score, scored.get(key, 0.0))
    order = sorted(scored, key=lambda s: (s[0], s[2], s[1]))
    return [(KINDS[k], a, b, scored[a, b, k]) for a, b, k in order]


_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
)


def find_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans hold kind, start, end (code points, end
    exclusive) and score.

    Texts are read whole, in place, without a shuffle. Null and empty texts have no
    spans; repeated rows are each given; an empty table gives no rows; other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "score")
        for batch in batches:
            found = [
                [dict(zip(names, s, strict=True)) for s in spans_of(t)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"]
            )

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run,
        f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>",
    )
