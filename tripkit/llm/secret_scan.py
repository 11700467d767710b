"""Find secrets: fixed patterns, and literals that reach sensitive names by assignment."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns and lengths of the base scan.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{32}")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
KINDS = ["assign", "access", "hex", "literal"]

# How strongly a word of a target's name suggests a secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.8, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "private": 0.6, "signing": 0.6,
    "encryption": 0.6, "access": 0.4, "api": 0.4, "key": 0.5, "salt": 0.5, "session": 0.3, "client": 0.1,
}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example|sample|dummy|todo|none|null|true|false|your[_-]?\w*|<.*>|\$\{.*\}|\{\{.*\}\}|%\w+%)$")
LITERAL_CHARS, THRESHOLD = 8, 1.0
HEAD_CHARS = 4096  # beginning of a value that is compared with placeholders

# An operand: a quoted string, or a bare run of value characters.
_OPERAND = re.compile(r"""[bruf]?"((?:[^"\\\n]|\\.)*)"|[bruf]?'((?:[^'\\\n]|\\.)*)'|([A-Za-z0-9_$@%+/~^!?*.:=-]+)""")
# A target: optional quotes around a name, then an assignment sign that isn't a comparison.
_TARGET = re.compile(r"""["']?([A-Za-z_$][\w$.\-]{0,127})["']?[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*""")
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.|<>|&)[ \t]*(?=[\"'\w$])")
_NAME = re.compile(r"^[A-Za-z_$][\w$.\-]*$")
_NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_SIGN = re.compile(r"[=:]")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and not overlapping per kind."""
    spans = []
    if _SIGN.search(text):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    at = 0
    while m := HEX_RUN.search(text, at):
        end = HEX.match(text, m.start()).end()
        spans.append((m.start(), end, "hex"))
        at = end
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def name_score(name: str) -> float:
    """How much the words of ``name`` (camelCase, snake_case, dotted) suggest a secret; 0 for plain names."""
    words = [w.lower() for part in re.split(r"[^A-Za-z0-9]+", name) for w in _NAME_WORD.findall(part)]
    score = sum(NAME_WEIGHTS.get(w, 0.0) for w in set(words))
    return max(score, 1.0 if re.search(r"(?i)password|passwd|secret|api_?key|token", name) else 0.0)


class Value:
    """What a name stands for: literals and earlier values, without joining them.

    Known of the joined text are its length, how often it holds each character (rounded beyond 2 ** 53 characters) and its beginning, so
    a value that doubles with every line stays small.
    """

    __slots__ = ("parts", "length", "_counts", "head")

    def __init__(self, parts: list[Value | tuple[str, int, int]]):
        self.parts = parts
        if len(parts) == 1 and isinstance(parts[0], Value):
            self.length, self._counts, self.head = parts[0].length, parts[0].counts, parts[0].head
            return
        if len(parts) == 1:  # a literal is counted when it is needed
            self.length, self._counts, self.head = len(parts[0][0]), None, parts[0][0][:HEAD_CHARS]
            return
        self.length, self._counts, self.head = 0, Counter(), ""
        for part in parts:
            inner = isinstance(part, Value)
            self.length += part.length if inner else len(part[0])
            self._counts.update(part.counts if inner else part[0])
            if len(self.head) < HEAD_CHARS:
                self.head += (part.head if inner else part[0])[: HEAD_CHARS - len(self.head)]
        if self.length > 1 << 53:
            self._counts = Counter({c: max(1, n >> 10) for c, n in self._counts.items()})
            self.length = self._counts.total()

    @property
    def counts(self) -> Counter:
        if self._counts is None:
            self._counts = Counter(self.parts[0][0])
        return self._counts

    def score(self) -> float:
        """0 for short values, placeholders and prose; up to 1 for values that look random. Only the beginning tells a placeholder."""
        if self.length < LITERAL_CHARS or PLACEHOLDER.match(self.head) or any(c.isspace() for c in self.counts):
            return 0.0
        entropy = -sum(n / self.length * math.log2(n / self.length) for n in self.counts.values())
        present = "".join(self.counts)
        kinds = sum(bool(re.search(p, present)) for p in ("[a-z]", "[A-Z]", r"\d", r"[^A-Za-z0-9]"))
        return min(1.0, entropy / 4) * (0.4 if kinds == 1 else 0.8 if kinds == 2 else 1.0)


def assignments(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) of each assignment, in order.

    Understood are ``name = value``, ``name: value``, ``"name": "value"``, ``name := value`` and ``name => value`` with
    quoted or bare values, and sums of literals and names. A name stands for what was last assigned to it, so
    constants reach the targets they are passed on to; a name without a value counts as bare text. Names are read up to 128
    characters, of longer ones the end.
    """
    known: dict[str, Value] = {}
    at = 0
    while m := _TARGET.search(text, at):
        at = m.end()
        parts, position, sums = [], m.end(), 0
        while operand := _OPERAND.match(text, position):
            group = operand.lastindex
            literal = operand[group]
            if group == 3 and _NAME.match(literal) and literal in known:
                parts.append(known[literal])
            else:
                parts.append((literal, *operand.span(group)))
            position = operand.end()
            step = _PLUS.match(text, position)
            if not step:
                break
            position, sums = step.end(), sums + 1
        if not parts:
            continue
        known[m[1]] = Value(parts)
        yield m[1], known[m[1]]
        # A bare value may itself hold an assignment (a=b=c), a quoted one is passed over.
        at = max(at, position) if sums or text[m.end() : m.end() + 1] in "\"'bruf" else at


def literal_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of literals whose target name and shape together reach the threshold. Each value is opened once."""
    if not _SIGN.search(text):
        return []
    found, opened, held = set(), set(), []
    for name, value in assignments(text):
        weight = name_score(name)
        if weight and (score := value.score()) > 0 and weight + score >= THRESHOLD + 0.5:
            todo = [value]
            while todo:
                one = todo.pop()
                if not isinstance(one, Value):
                    found.add((one[1], one[2], "literal"))
                elif id(one) not in opened:
                    opened.add(id(one))
                    held.append(one)  # so that no later value gets its identity
                    todo += one.parts
    return sorted(s for s in found if s[1] > s[0])


def all_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and these with the literals that no base span covers."""
    base = base_spans(text)
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
    covered = lambda a, b: (i := bisect_right(starts, a)) > 0 and reach[i - 1] >= b
    extra = [s for s in literal_spans(text) if not covered(s[0], s[1])]
    return base, sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per base kind, ``base_sha256``, ``spans`` (all, as ``kind:start:end`` in code points).

    Each row of ``docs`` (``doc_id``, ``text``; other columns are ignored) is scanned alone and whole; null is empty.
    A map over the rows: no shuffle.
    """

    def scan(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                base, spans = all_spans(text or "")
                count = Counter(kind for _, _, kind in base)
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((count["assign"], count["access"], count["hex"], digest, _joined(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, "doc_id", frame["doc_id"].array)
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(text: str, mark: str = "<secret>") -> str:
    """``text`` with every span, overlapping ones joined, replaced by ``mark``."""
    out, at = [], 0
    for a, b, _ in all_spans(text)[1]:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, if there, counted anew; rows and columns stay."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else redact(t))

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        kept = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", kept)
    return out
