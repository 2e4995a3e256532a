"""URL filters by a bit-parallel wildcard automaton.

Glob rules are packed side by side into one multiword Shift-And machine: one bit per glob
element, all patterns advance together over each canonical URL. A machine word holds 64
bits; a rule set of any length takes as many words as it needs. The automaton is stepped
for a batch of URLs of about the same length at a time, one character column after the other
(numpy), so the cost is (longest URL x words) vector operations a batch, and a very long URL
takes no room but its own.

Glob language: ``*`` any run of bytes except ``/``; ``**`` any run of bytes; ``?`` one
byte; anything else itself. Matching is anchored at both ends over UTF-8 bytes.

Defined results: a null URL, or one without ``://``, has empty host and path and canonical
form ``.``; an empty rule set matches nothing; of several matching rules of one list the
longest wins, ties go to the earlier rule. Repeated rows are judged alike; null ids stay; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A host-and-path rule: fits its host and all subdomains below a path prefix."""

    verdict: str
    name: str

    @property
    def glob(self) -> str:
        host, _, path = self.name.partition("/")
        return f"*.{host}/{path}**"


@dataclass(frozen=True)
class GlobRule:
    """A plain glob over ``.host/path`` (see :func:`canonical`)."""

    verdict: str
    glob: str


#: The default list of plain globs: endpoints that hold no prose but forms, feeds, lists and files.
DEFAULT_GLOBS = tuple(GlobRule("block", g) for g in (
    "*/cgi-bin/**", "**/wp-login.php", "**/wp-admin/**", "**/wp-json/**", "**/xmlrpc.php",
    "**/login", "**/signin", "**/signup", "**/register", "**/logout", "**/cart", "**/checkout", "**/checkout/**",
    "**/feed", "**/feed/", "**/rss.xml", "**/atom.xml", "**/sitemap*.xml", "**/robots.txt",
    "*/**.css", "*/**.js", "*/**.json", "*/**.jpg", "*/**.jpeg", "*/**.png", "*/**.gif", "*/**.svg", "*/**.ico", "*/**.webp", "*/**.mp3", "*/**.mp4", "*/**.avi", "*/**.zip", "*/**.gz", "*/**.exe", "*/**.dmg", "*/**.woff", "*/**.woff2",
))


class ShiftAnd:
    """All globs as one automaton. ``states``: one bit per glob element plus an end bit."""

    def __init__(self, globs: Sequence[str]):
        literal: list[set[int] | None] = []  # bytes that enter the state; None: any
        loop: list[str] = []  # what a state keeps alive: '' nothing, '*' no slash, '**' all
        first, final = [], []
        for g in globs:
            first.append(len(literal))
            literal.append(set())  # the start state of this glob: nothing enters it
            loop.append("")
            raw, i = g.encode(), 0
            while i < len(raw):
                if raw[i : i + 2] == b"**":
                    loop[-1], i = "**", i + 2
                elif raw[i : i + 1] == b"*":
                    loop[-1], i = loop[-1] or "*", i + 1
                else:
                    literal.append(None if raw[i : i + 1] == b"?" else {raw[i]})
                    loop.append("")
                    i += 1
            final.append(len(literal) - 1)
        self.n, self.words = len(globs), max(1, -(-len(literal) // 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.keep = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final = final
        one = np.uint64(1)
        for s, chars in enumerate(literal):
            w, bit = s // 64, one << np.uint64(s % 64)
            for c in range(256) if chars is None else chars:
                self.enter[c, w] |= bit
            if loop[s]:
                self.keep[:, w] |= bit
                if loop[s] == "*":
                    self.keep[ord("/"), w] &= ~bit
        for s in first:
            self.start[s // 64] |= one << np.uint64(s % 64)

    def match(self, urls: Sequence[bytes], room: int = 1 << 22) -> np.ndarray:
        """Boolean matrix URL x glob. URLs are stepped in groups by length, of ``room`` bytes at most
        or one URL, so that none is padded to more than its group's longest."""
        n = len(urls)
        out = np.zeros((n, self.n), bool)
        if not n or not self.n:
            return out
        lengths = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < n:
            longest = max(1, int(lengths[order[at]]))
            # a group ends where URLs get shorter than half its longest
            half = int(np.searchsorted(-lengths[order], -(longest // 2), "left"))
            end = max(at + 1, min(n, at + room // longest, max(half, at + 1)))
            self._step(urls, order[at:end], lengths, out)
            at = end
        return out

    def _step(self, urls: Sequence[bytes], rows: np.ndarray, lengths: np.ndarray, out: np.ndarray) -> None:
        """All globs over URLs by falling length."""
        sizes = lengths[rows]
        flat = np.zeros((len(rows), max(1, int(sizes[0]))), np.uint8)
        for r, i in enumerate(rows):
            flat[r, : sizes[r]] = np.frombuffer(urls[i], np.uint8)
        state = np.repeat(self.start[None, :], len(rows), 0)
        top = np.uint64(63)
        live_at = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")  # URLs longer than each column
        for col, live in enumerate(live_at.tolist()):
            s, c = state[:live], flat[:live, col]
            shifted = s << np.uint64(1)
            shifted[:, 1:] |= s[:, :-1] >> top
            state[:live] = (shifted & self.enter[c]) | (s & self.keep[c])
        for g, f in enumerate(self.final):
            out[rows, g] = (state[:, f // 64] >> np.uint64(f % 64)) & np.uint64(1) == 1


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lower = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """``.host/path``: the leading dot lets one glob fit a host and its subdomains."""
    return F.concat(F.lit("."), host, path)


def filter_urls(pages: DataFrame, rules: Sequence[Rule], globs: Sequence[GlobRule] = DEFAULT_GLOBS, id_col: str = "page_id", url_col: str = "url", batch: int = 4096) -> DataFrame:
    """(id, host, path, rule, glob, verdict) of each row.

    ``rules`` decide first (longest name wins); where none fits, the longest fitting glob
    of ``globs`` decides; where none fits either, the verdict is ``allow``. A map without
    any shuffle; the automaton travels in the closure (its size is that of the rules).
    """
    machine = ShiftAnd([r.glob for r in rules] + [g.glob for g in globs])
    n_rules = len(rules)
    rank_r = sorted(range(n_rules), key=lambda i: -len(rules[i].name))
    rank_g = sorted(range(len(globs)), key=lambda i: -len(globs[i].glob))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                b = whole.slice(at, batch)
                hit = machine.match([x.encode() for x in b.column("canon").to_pylist()])
                rule, glob, verdict = [], [], []
                for row in hit:
                    r = next((i for i in rank_r if row[i]), None)
                    g = next((i for i in rank_g if row[n_rules + i]), None)
                    rule.append(None if r is None else rules[r].name)
                    glob.append(None if g is None else globs[g].glob)
                    verdict.append(rules[r].verdict if r is not None else globs[g].verdict if g is not None else "allow")
                cols = [b.column("id"), b.column("host"), b.column("path")]
                cols += [pa.array(x, pa.string()) for x in (rule, glob, verdict)]
                yield pa.RecordBatch.from_arrays(cols, ["id", "host", "path", "rule", "glob", "verdict"])

    url = pages[url_col].cast("string")
    src = pages.select(pages[id_col].cast("long").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    src = src.withColumn("canon", canonical(F.col("host"), F.col("path")))
    return src.mapInArrow(run, "id long, host string, path string, rule string, glob string, verdict string")
