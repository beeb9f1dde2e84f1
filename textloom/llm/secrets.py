"""Secret scans that link the parts of a credential."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.ship import ship

#: What counts as a secret by itself, and the shortest that does.
BASE = (
    ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
#: Parts that mean something only beside other parts, by the role they play.
WEAK = (
    ("identifier", re.compile(r"""(?ai:\b(?:user(?:name)?|login|client_?id|access_?key_?id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})"""), 1),
    ("key", re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}"), 0),
    ("endpoint", re.compile(r"(?ai:\b(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://)[^\s\"'<>]+"), 0),
)
#: The role of a kind: who, what or where. A weak part counts beside a part of another role.
ROLE = {"assign": "what", "hex": "what", "key": "what", "access": "who", "identifier": "who", "endpoint": "where"}
KINDS = tuple(k for k, *_ in BASE) + tuple(k for k, *_ in WEAK)
#: A scope ends at an empty line.
_SCOPE = re.compile(r"\n[ \t\r]*\n")
_WORDS = ("passw", "secret", "token", "api")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The secrets of each kind, leftmost and not overlapping within a kind; ends are exclusive."""
    found, low = [], text.lower()
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not any(w in low for w in _WORDS):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end()))
    return found


def weak_spans(text: str) -> list[Span]:
    """Candidates that are no secret by themselves."""
    return [(kind, m.start(group), m.end(group)) for kind, pattern, group in WEAK for m in pattern.finditer(text)]


def linked(text: str, strong: list[Span], weak: list[Span]) -> list[Span]:
    """The weak spans that have a part of another role in their scope, however far away.

    The intervals of parts are joined with that of the scope they begin in.
    At least one of the two roles has to be a secret: an identifier beside an
    endpoint is an address, no credential. A part that overlaps a strong span
    says nothing new and is left out.
    """
    if not weak:
        return []
    ends = [m.end() for m in _SCOPE.finditer(text)]
    covered = _Intervals((s, e) for _, s, e in strong)
    fresh = [w for w in weak if not covered.touch(w[1], w[2])]
    roles: dict[int, set[str]] = {}
    for kind, s, _ in [*strong, *fresh]:
        roles.setdefault(_place(ends, s), set()).add(ROLE[kind])
    out = []
    for kind, s, e in fresh:
        wanted = {"who", "where"} if ROLE[kind] == "what" else {"what"}
        if wanted & roles[_place(ends, s)]:
            out.append((kind, s, e))
    return out


def _place(ends: list[int], at: int) -> int:
    return bisect_left(ends, at + 1)


class _Intervals:
    """Intervals by their starts, each with the furthest end up to it."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.reached = list(accumulate((e for _, e in spans), max))

    def touch(self, start: int, end: int) -> bool:
        """Whether one of them overlaps ``start`` to ``end``."""
        before = bisect_left(self.starts, end)
        return before > 0 and self.reached[before - 1] > start


def written(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then by kind in the order listed."""
    order = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in order)


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and the weak spans that link; none in a null or empty text."""
    text = text or ""
    strong = base_spans(text)
    return strong, linked(text, strong, weak_spans(text))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``id_col, base array<struct<kind,start,end>>, linked array<...>`` per row of ``docs``.

    Positions are code points of the whole text, ends exclusive. A scope lies
    within one text, so parts are joined in the task that has the text, and
    nothing is shuffled. Null and empty texts have empty arrays. Null and
    repeated ids and rows keep their row; other columns are not looked at.
    """
    ship(docs.sparkSession)
    struct = "struct<base:array<struct<kind:string,start:int,end:int>>,linked:array<struct<kind:string,start:int,end:int>>>"
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(struct)
    def of(texts: pa.Array) -> pa.Array:
        found = [find(t.as_py()) for t in texts]
        sides = [
            pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in sorted(side, key=_order)] for side in column], spans)
            for column in ([f[0] for f in found], [f[1] for f in found])
        ]
        return pa.StructArray.from_arrays(sides, ["base", "linked"])

    found = docs.select(F.col(id_col), of(F.col(text_col)).alias("found"))
    return found.select(id_col, "found.base", "found.linked")


def _order(span: Span) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with a mark in place of every secret; overlapping spans become one mark.

    Of an assignment the value goes and the name stays. Null stays null.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py(), mark) for t in texts], pa.string())

    return docs.withColumn(text_col, of(F.col(text_col)))


def redacted(text: str | None, mark: str) -> str | None:
    if not text:
        return text
    strong, weak = find(text)
    cuts = [_value(text, s, e) if kind == "assign" else (s, e) for kind, s, e in [*strong, *weak] if kind != "endpoint"]
    out, at = [], 0
    for s, e in sorted(cuts):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def _value(text: str, start: int, end: int) -> tuple[int, int]:
    m = BASE[0][1].match(text, start, end)
    return m.span(2)
