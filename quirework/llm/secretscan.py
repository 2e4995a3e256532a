"""Secret scans: fixed patterns, and an assignment-aware lexer over names and literals.

The patterns give the spans ``assign``, ``access`` and ``hex``. The lexer reads source and
configuration syntax (``name = "x"``, ``name: x``, ``"name": "x"``, ``<name>x</name>``,
``export NAME=x``, ``--name x``, ``a.b['name'] = ...``, literals in triple quotes and YAML blocks over
several lines) into name-literal pairs in order. A right side that
is a bare name takes the value which that name was last given (constants propagate, also
along chains), and string concatenations of literals and names are followed. A literal is
scored by the names it reaches, directly or through constants, and by its own make-up:
length, character classes and entropy, minus placeholders and plain words. Literals that reach
``threshold`` give ``lexed`` spans, unless a pattern span overlaps them already. A PEM block of
a private key is a literal whose name stands in its own marks: it gives a ``lexed`` span as it is.

A name holds what it was last given in the text; blocks of code don't end a name. A text
without any sensitive name can't give a lexed span and is not lexed. Spans count code points, the
end exclusive, over the whole text.

Defined results: a null text counts as empty and has no spans; repeated rows are scanned
alike; an empty table gives no rows. A map without any shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import keyed_text, sliced

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "lexed")

#: Parts of names that make a literal sensitive, and their weight.
SENSITIVE = {
    "password": 0.6, "passwd": 0.6, "passphrase": 0.6, "pwd": 0.5, "secret": 0.6, "token": 0.5, "apikey": 0.6,
    "api_key": 0.6, "api-key": 0.6, "private_key": 0.6, "access_key": 0.6, "auth": 0.4, "credential": 0.5, "connection_string": 0.4,
}
SENSITIVE_NAME = re.compile("|".join(map(re.escape, SENSITIVE)))
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|changeme|change_me|example|placeholder|todo|none|null|true|false|undefined|your[-_ ].*|<.*>|\$\{.*\}|\$\(.*\)|%\(.*\)s|\{\{.*\}\})$")

# names are possessive, and a name without a value is taken whole (``run``), so long runs stay linear
INDEX = re.compile(r"\[\s*+[\"']([^\"'\n]++)[\"']\s*+\]")
NAME = r"[A-Za-z_$][\w$]*+(?:(?:\.|->|::)[A-Za-z_$][\w$]*+|\[\s*+[\"'][^\"'\n]++[\"']\s*+\]|-[A-Za-z][\w$]*+)*+"
LITERAL = r"\"\"\"(?:[^\"\\]++|\\(?s:.)|\"(?!\"\"))*+\"\"\"|'\''(?:[^'\\]++|\\(?s:.)|'(?!''))*+'\''|\"[^\"\\\n]*+(?:\\.[^\"\\\n]*+)*+\"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|`[^`\n]*+`"
PAIR = re.compile(
    rf"(?P<q>[\"']?)(?P<name>{NAME})(?P=q)\s*+(?::=|=>|=(?!=)|:(?!:))[ \t]*+(?![|>][-+\d]*+[ \t]*+\n)(?P<value>(?:{LITERAL}|{NAME})(?:[ \t]*+\+[ \t]*+(?:{LITERAL}|{NAME}))*+|[^\s\"'`,;#<>(){{}}\[\]]+)"
    rf"|(?P<bq>[\"']?)(?P<bname>{NAME})(?P=bq)[ \t]*+:[ \t]*+[|>][-+\d]*+[ \t]*+\n(?P<block>(?P<indent>[ \t]++)[^\s][^\n]*+(?:\n(?P=indent)[^\n]*+|\n[ \t]*+(?=\n))*+)"
    rf"|(?<![\w-])--(?P<option>[A-Za-z][\w-]*+)[ \t]++(?P<argument>{LITERAL}|(?!-)[^\s\"'`,;|&<>(){{}}\[\]=:]+)"
    rf"|<(?P<tag>[A-Za-z_][\w.-]*+)>(?P<body>[^<>\n]++)</(?P=tag)>"
    rf"|(?P<run>{NAME})",
    re.ASCII,
)
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----(?:[^-]++|-(?!----END ))*+-----END \1PRIVATE KEY-----")
PART = re.compile(rf"(?P<literal>{LITERAL})|(?P<name>{NAME})", re.ASCII)


class Span(NamedTuple):
    kind: str
    start: int
    end: int


class Literal(NamedTuple):
    text: str
    start: int
    end: int


def pattern_spans(text: str) -> list[Span]:
    """The spans of the three fixed patterns, leftmost and non-overlapping in each kind."""
    spans = []
    lower = text.lower()
    if any(x in lower for x in ASSIGN_STEMS):
        spans += [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [Span("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def matches(text: str) -> Iterator[re.Match]:
    """The matches of ``PAIR`` that are pairs. A later start in a run reaches the same end, so only
    the strings of its indices can hold other pairs."""
    for m in PAIR.finditer(text):
        if not m["run"]:
            yield m
        elif "[" in m["run"]:
            for i in INDEX.finditer(text, *m.span()):
                yield from (x for x in PAIR.finditer(text, *i.span(1)) if not x["run"])


def quotes(literal: str) -> int:
    """How many characters quote a literal at either end."""
    if literal[:1] not in ("\"", "'", "`"):
        return 0
    return 3 if literal[0] != "`" and len(literal) >= 6 and literal[:3] == literal[0] * 3 else 1


def assignments(text: str) -> Iterator[tuple[str, list[Literal | int]]]:
    """(name, the parts of its value) in order: literals, and the numbers of earlier pairs for the constants they set."""
    known: dict[str, int] = {}
    for n, m in enumerate(matches(text)):
        if m["tag"]:
            name, value = m["tag"], [Literal(m["body"], m.start("body"), m.end("body"))]
        elif m["bname"]:
            name, value = m["bname"], [Literal(m["block"], m.start("block") + len(m["indent"]), m.end("block"))]
        elif m["option"]:
            cut = quotes(m["argument"])
            name, value = m["option"], [Literal(m["argument"][cut : len(m["argument"]) - cut], m.start("argument") + cut, m.end("argument") - cut)]
        else:
            name, raw, at = m["name"], m["value"], m.start("value")
            value = []
            parts = list(PART.finditer(raw))
            if "".join(p[0] for p in parts) == re.sub(r"[ \t+]", "", raw) or any(p["literal"] for p in parts):
                for p in parts:
                    if p["literal"]:
                        cut = quotes(p[0])
                        value.append(Literal(p[0][cut:-cut], at + p.start() + cut, at + p.end() - cut))
                    elif p[0] in known:
                        value.append(known[p[0]])
                    elif len(parts) == 1:
                        value.append(Literal(p[0], at + p.start(), at + p.end()))
            else:
                value.append(Literal(raw, at, at + len(raw)))
        known[name] = n
        yield name, value


def lex_pairs(text: str) -> Iterator[tuple[str, list[Literal]]]:
    """(name, the literals that make up its value, each once) in order, constants already propagated."""
    values: list[list[Literal]] = []
    for name, parts in assignments(text):
        values.append(list(dict.fromkeys(x for p in parts for x in (values[p] if isinstance(p, int) else [p]))))
        yield name, values[-1]


def entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values()) if s else 0.0


def weight(name: str) -> float:
    low = name.lower()
    return max((w for k, w in SENSITIVE.items() if k in low), default=0.0)


def score(sensitive: float, literal: str) -> float:
    """Between 0 and about 1.2: the weight of its name plus what the literal looks like. Lines of
    one literal count as one run."""
    literal = "".join(map(str.strip, literal.splitlines()))
    if not sensitive or len(literal) < 8 or " " in literal or PLACEHOLDER.match(literal):
        return 0.0
    if literal.isalpha() and (literal.islower() or literal[1:].islower()):
        sensitive -= 0.2  # a word as prose has it
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return sensitive + 0.1 * (classes - 1) + 0.1 * (len(literal) >= 16) + 0.2 * (entropy(literal) >= 3.0)


def scan_text(text: str, threshold: float = 0.8) -> list[Span]:
    """All spans, by start, then in the order of kinds."""
    spans = pattern_spans(text)
    if SENSITIVE_NAME.search(text.lower()):
        taken = sorted((s.start, s.end) for s in spans)
        lexed = set()
        pairs = list(assignments(text))
        weights = [weight(name) for name, _ in pairs]
        # names only use earlier pairs: from the last on, each pair's weight is whole when it is handed on
        for n in range(len(pairs) - 1, -1, -1):
            for x in pairs[n][1]:
                if isinstance(x, int):
                    weights[x] = max(weights[x], weights[n])
                elif score(weights[n], x.text) >= threshold and not any(a < x.end and x.start < b for a, b in taken):
                    lexed.add(Span("lexed", x.start, x.end))
        spans += lexed
    if "PRIVATE KEY-----" in text:
        spans += [x for m in PEM.finditer(text) if (x := Span("lexed", *m.span())) not in spans]
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with the union of the spans replaced by a mark."""
    out, at = [], 0
    for start, end in sorted((s.start, s.end) for s in spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_documents(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of each row's whole text."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            found = [[s._asdict() for s in scan_text(x, threshold)] for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, kind)], ["id", "spans"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "id long, spans array<struct<kind:string,start:long,end:long>>")


def span_text(spans, kinds: tuple[str, ...] = KINDS):
    """kind:start:end of the spans of these kinds, joined by commas."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_documents(docs: DataFrame, threshold: float = 0.8, mark: str = "[SECRET]", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; all rows and columns stay, null texts too.

    ``length_col``: a column with the text's length, set anew where the text changes.
    """
    schema = docs.withColumn(text_col, F.col(text_col).cast("string")).schema
    text_at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            cols = list(b.columns)
            before = cols[text_at].to_pylist()
            after = [None if x is None else redact(x, scan_text(x, threshold), mark) for x in before]
            cols[text_at] = pa.array(after, pa.string())
            if length_at is not None:
                old = cols[length_at].to_pylist()
                cols[length_at] = pa.array([n if x == y else len(y) for n, x, y in zip(old, before, after, strict=True)], cols[length_at].type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
