"""License scans by sentence rules.

A text is split into sentences, a sentence is normalised (lower case, one spelling of
*licence*, punctuation to spaces) and mapped to the identifier of a known licence sentence.
The sequence of identifiers of a text, repeats that follow one another merged, is matched from the
left against an ordered list of rules, each a sequence of identifiers with optional parts; the
first rule that fits at a place names the licence and consumes its identifiers. Identifiers no rule
takes are reported as they are. A sentence may state more of the name, such as a version or the
name itself in an SPDX tag: what its pattern's group ``more`` holds goes into the ``*`` of the
rule's licence, where that has one.

A sentence can only be known if it has one of the stems of ``STEMS``, words derived from the
table so that each known sentence holds one; texts and sentences without any are passed over
after a substring search, which changes no result.

Defined results: a null or empty text has no sentences and no licence; repeated rows are
scanned alike; sentences broken over lines are joined, a blank line ends one; an empty table
gives no rows. A map without any shuffle, over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame

from quirework.llm.common import keyed_text, sliced

# Identifier, and what the normalised sentence must hold.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("mit.grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit.notice", r"the above copyright notice and this permission notice shall be included"),
    ("asis.software", r"the software is provided as is without warrant(?:y|ies)"),
    ("mit.liable", r"in no event shall the authors or copyright holders be liable"),
    ("isc.grant", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd.grant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd.source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd.binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd.advert", r"all advertising materials mentioning features or use of this software"),
    ("bsd.endorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsd.asis", r"this software is provided by .* as is and any express or implied warrant(?:y|ies)"),
    ("bsd.liable", r"in no event shall .* be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("apache.2.ref", r"licen[sc]ed under (?:the )?apache license(?: version)? ?2(?: 0)?\b|under the terms of the apache license(?: version)? 2"),
    ("apache.2.name", r"^(?:the )?apache license(?: version)? 2(?: 0)?$"),
    ("apache.comply", r"you may not use this file except in compliance with the license"),
    ("apache.obtain", r"you may obtain a copy of the license at"),
    ("apache.asis", r"distributed under the license is distributed on an as is basis"),
    ("apache.see", r"see the license for the specific language governing permissions and limitations"),
    ("agpl.3.ref", r"gnu affero general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?3"),
    ("lgpl.3.ref", r"gnu lesser general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?3"),
    ("lgpl.2.ref", r"gnu (?:lesser|library) general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?2"),
    ("gpl.3.ref", r"gnu general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?3"),
    ("gpl.2.ref", r"gnu general public license(?: as published by the free software foundation)?(?: either)? v(?:ersion )?2"),
    ("gpl.ref", r"gnu general public license"),
    ("gpl.hope", r"distributed in the hope that it will be useful but without any warranty"),
    ("gpl.copy", r"you should have received a copy of the gnu"),
    ("gpl.later", r"or at your option any later version"),
    ("mpl.2.ref", r"mozilla public license v(?:ersion |)? ?2"),
    ("spdx.ref", r"spdx license identifier (?P<more>[a-z0-9]+(?: (?!spdx\b)[a-z0-9]+){0,11})"),
    ("epl.ref", r"eclipse public license(?: v(?:ersion )?)? ?(?P<more>[12] ?0)"),
    ("cddl.ref", r"common development and distribution license(?: v(?:ersion )?)? ?(?P<more>1 ?[01])"),
    ("artistic.ref", r"artistic license(?: v(?:ersion )?)? ?(?P<more>[12] ?0)"),
    ("eupl.ref", r"european union public license(?: v(?:ersion )?)? ?(?P<more>1 ?[012])"),
    ("bsl.ref", r"boost software license(?: v(?:ersion )?)? ?1 ?0"),
    ("ofl.ref", r"sil open font license(?: v(?:ersion )?)? ?1 ?[01]"),
    ("wtfpl.ref", r"do what the fuck you want to public license"),
    ("zlib.asis", r"this software is provided as is without any express or implied warranty"),
    ("zlib.grant", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib.origin", r"the origin of this software must not be misrepresented"),
    ("zlib.marked", r"altered source versions must be plainly marked as such"),
    ("zlib.notice", r"this notice may not be removed or altered from any source distribution"),
    ("zlib.ref", r"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?zlib license"),
    ("mit.ref", r"(?:licen[sc]ed|released|distributed|available|provided|published) under (?:the )?(?:terms of the )?mit(?: \w+)? license|^(?:the )?mit license(?: mit)?$"),
    ("bsd.ref", r"(?:licen[sc]ed|released|distributed|available) under (?:the |a )?(?:terms of the )?(?:[23] clause )?(?:modified )?bsd(?: style)? license"),
    ("isc.ref", r"(?:licen[sc]ed|released|distributed) under (?:the )?isc license"),
    ("cc.zero", r"\bcc0\b|creative commons zero"),
    ("cc.by.nc.nd", r"(?:\bcc by nc nd\b|attribution noncommercial noderiv(?:ative)?s)(?: (?P<more>[1-4] [05])\b)?"),
    ("cc.by.nc.sa", r"(?:\bcc by nc sa\b|attribution noncommercial sharealike)(?: (?P<more>[1-4] [05])\b)?"),
    ("cc.by.nc", r"(?:\bcc by nc\b|attribution noncommercial)(?: (?P<more>[1-4] [05])\b)?"),
    ("cc.by.nd", r"(?:\bcc by nd\b|attribution noderiv(?:ative)?s)(?: (?P<more>[1-4] [05])\b)?"),
    ("cc.by.sa", r"(?:\bcc by sa\b|attribution sharealike)(?: (?P<more>[1-4] [05])\b)?"),
    ("cc.by", r"(?:\bcc by\b|creative commons attribution)(?: (?P<more>[1-4] [05])\b)?"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("public.domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("reserved", r"\ball rights reserved\b"),
    ("no.copying", r"(?:may not be|no part .* may be) (?:reproduced|copied|redistributed)"),
    ("copyright", r"^(?:c )?copyright\b|^© ?"),
)

# Licence and its sequence of sentence identifiers; "?" marks an optional one, "*" what a sentence states.
RULES: tuple[tuple[str, str], ...] = (
    ("MIT", "copyright? reserved? mit.ref? copyright? mit.grant mit.notice asis.software mit.liable?"),
    ("BSD-4-Clause", "copyright? reserved? bsd.grant bsd.source bsd.binary bsd.advert bsd.endorse? bsd.asis bsd.liable?"),
    ("BSD-3-Clause", "copyright? reserved? bsd.ref? bsd.grant bsd.source bsd.binary bsd.endorse bsd.asis bsd.liable?"),
    ("BSD-2-Clause", "copyright? reserved? bsd.ref? bsd.grant bsd.source bsd.binary bsd.asis bsd.liable?"),
    ("ISC", "copyright? reserved? isc.ref? copyright? isc.grant asis.software?"),
    ("Apache-2.0", "copyright? apache.2.ref apache.comply? apache.obtain? apache.asis? apache.see?"),
    ("Apache-2.0", "copyright? apache.2.name"),
    ("AGPL-3.0-or-later", "copyright? agpl.3.ref gpl.later gpl.hope? gpl.copy?"),
    ("AGPL-3.0", "copyright? agpl.3.ref gpl.hope? gpl.copy?"),
    ("LGPL-3.0-or-later", "copyright? lgpl.3.ref gpl.later gpl.hope? gpl.copy?"),
    ("LGPL-3.0", "copyright? lgpl.3.ref gpl.hope? gpl.copy?"),
    ("LGPL-2.0-or-later", "copyright? lgpl.2.ref gpl.later gpl.hope? gpl.copy?"),
    ("LGPL-2.0", "copyright? lgpl.2.ref gpl.hope? gpl.copy?"),
    ("GPL-3.0-or-later", "copyright? gpl.3.ref gpl.later gpl.hope? gpl.copy?"),
    ("GPL-3.0", "copyright? gpl.3.ref gpl.hope? gpl.copy?"),
    ("GPL-2.0-or-later", "copyright? gpl.2.ref gpl.later gpl.hope? gpl.copy?"),
    ("GPL-2.0", "copyright? gpl.2.ref gpl.hope? gpl.copy?"),
    ("GPL", "copyright? gpl.ref gpl.later? gpl.hope? gpl.copy?"),
    ("MPL-2.0", "copyright? mpl.2.ref"),
    ("*", "copyright? reserved? spdx.ref"),
    ("EPL*", "copyright? epl.ref"),
    ("CDDL*", "copyright? cddl.ref"),
    ("Artistic*", "copyright? artistic.ref"),
    ("EUPL*", "copyright? eupl.ref"),
    ("BSL-1.0", "copyright? bsl.ref"),
    ("OFL-1.1", "copyright? reserved? ofl.ref"),
    ("WTFPL", "copyright? wtfpl.ref"),
    ("Zlib", "copyright? zlib.ref? zlib.asis? zlib.grant zlib.origin? zlib.marked? zlib.notice?"),
    ("Zlib", "copyright? zlib.ref"),
    ("MIT", "copyright? reserved? mit.ref"),
    ("BSD", "copyright? reserved? bsd.ref"),
    ("ISC", "copyright? reserved? isc.ref"),
    ("CC0-1.0", "copyright? cc.zero"),
    ("CC-BY-NC-ND*", "copyright? cc.by.nc.nd"),
    ("CC-BY-NC-SA*", "copyright? cc.by.nc.sa"),
    ("CC-BY-NC*", "copyright? cc.by.nc"),
    ("CC-BY-ND*", "copyright? cc.by.nd"),
    ("CC-BY-SA*", "copyright? cc.by.sa"),
    ("CC-BY*", "copyright? cc.by"),
    ("Unlicense", "unlicense asis.software?"),
    ("Public-Domain", "public.domain"),
    ("Proprietary", "copyright? reserved no.copying?"),
    ("Proprietary", "copyright no.copying"),
)

# possessive, so that long runs of white space stay linear
SENTENCE_END = re.compile(r"(?<=[.!?;])(?<!\b[vV]\.)\s++|\n[^\S\n]*+\n\s*+|\n(?=\s*+(?:[#*/\-]++\s*+)?(?:©|\([Cc]\)|[Cc]opyright\b))|(?<=:)[^\S\n]*+\n")
TAG = re.compile(r"(?i)(SPDX-License-Identifier:[^\n]*+)\n")
COMMENT = re.compile(r"(?m)^[ \t]*(?://+|#+|\*+|--|;+)[ \t]?")


@dataclass(frozen=True)
class Found:
    """A licence, or a sentence no rule takes (then named ``?`` and its identifier)."""

    name: str
    sentences: tuple[str, ...]


def spelled(text: str) -> str:
    return text.lower().replace("licence", "license")


def normalise(sentence: str) -> str:
    s = re.sub(r"[^\w©]+", " ", spelled(sentence).replace("_", " "))
    return s.strip()


def sentences_of(text: str) -> list[str]:
    """The sentences of a text without marks of comments; a licence tag ends with its line."""
    return SENTENCE_END.split(TAG.sub(r"\1\n\n", COMMENT.sub("", text)))


def _held(tree) -> set[str]:
    """Words of which each match of a parsed pattern holds one: the longest to be had; {""} if there are none."""
    choices, run = [], ""
    for op, arg in [*tree, (None, None)]:
        if op is _parser.LITERAL and (chr(arg).isalnum() or chr(arg) == "©"):
            run += chr(arg)
            continue
        choices.append({run})
        run = ""
        if op is _parser.SUBPATTERN:
            choices.append(_held(arg[-1]))
        elif op is _parser.BRANCH:
            choices.append(set().union(*map(_held, arg[1])))
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT) and arg[0] > 0:
            choices.append(_held(arg[2]))
    return max(choices, key=lambda c: min(map(len, c)))


def stems_of(sentences: Sequence[tuple[str, str]]) -> tuple[str, ...]:
    """Words of which every sentence that a pattern knows holds one. Normalising keeps words whole,
    so the text as ``spelled`` holds it too."""
    words = set().union(*(_held(_parser.parse(p)) for _, p in sentences))
    return tuple(sorted(w for w in words if not any(x != w and x in w for x in words)))


STEMS = stems_of(SENTENCES)


class Scanner:
    def __init__(self, sentences: Sequence[tuple[str, str]] = SENTENCES, rules: Sequence[tuple[str, str]] = RULES, stems: Sequence[str] | None = None):
        self.sentences = [(k, re.compile(p)) for k, p in sentences]
        self.rules = [(name, [(x.removesuffix("?"), x.endswith("?")) for x in seq.split()]) for name, seq in rules]
        self.stems = stems_of(sentences) if stems is None else stems

    def identify(self, text: str) -> list[tuple[str, int, str]]:
        """(identifier, number of the sentence, what it states) of the known sentences, in order.

        A sentence may be known by several identifiers (a licence and "or any later
        version"): all count, in the order in which they stand in it, but of overlapping
        ones only that of the earlier table entry.
        """
        low = spelled(text)
        if not any(s in low for s in self.stems):
            return []
        out: list[tuple[str, int, str]] = []
        for n, raw in enumerate(sentences_of(text)):
            low = spelled(raw)
            if not any(s in low for s in self.stems):
                continue
            s, taken = normalise(raw), []
            for key, p in self.sentences:
                if (m := p.search(s)) and not any(a < m.end() and m.start() < b for a, b, *_ in taken):
                    taken.append((m.start(), m.end(), key, m.groupdict().get("more") or ""))
            for _, _, key, more in sorted(taken):
                if not out or (out[-1][0], out[-1][2]) != (key, more):
                    out.append((key, n, more))
        return out

    def _fit(self, ids: list[str], at: int, seq: list[tuple[str, bool]]) -> int:
        """How many identifiers the rule takes from ``at`` on; 0: it doesn't fit."""
        i = at
        for key, optional in seq:
            if i < len(ids) and ids[i] == key:
                i += 1
            elif not optional:
                return 0
        return i - at

    def recognise(self, found: list[tuple[str, int, str]]) -> list[Found]:
        """The licences of what :meth:`identify` found."""
        ids = [k for k, *_ in found]
        out, at = [], 0
        while at < len(ids):
            for name, seq in self.rules:
                if n := self._fit(ids, at, seq):
                    stated = [x[2] for x in found[at : at + n] if x[2]]
                    out.append(Found(complete(name, stated[0] if stated else ""), tuple(ids[at : at + n])))
                    at += n
                    break
            else:
                out.append(Found(f"?{ids[at]}", (ids[at],)))
                at += 1
        return out


def complete(name: str, stated: str) -> str:
    """A rule's licence with what a sentence states of it in place of ``*``: digits of a version
    are joined by dots, words by dashes."""
    if "*" not in name:
        return name
    version = re.sub(r"(?<=\d) ?(?=\d)", ".", stated) if name != "*" else re.sub(r"(?<=\d) (?=\d)", ".", stated)
    version = version.replace(" ", "-")
    return name.replace("*", f"-{version}" if version and name != "*" else version)


def scan_documents(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentences array<string>, licenses array<string>): identifiers in order, and the
    names found by the rules in order of first appearance, without repeats."""
    scanner = scanner or Scanner()
    strings = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            ids, names = [], []
            for text in b.column("text").to_pylist():
                found = scanner.identify(text)
                ids.append([k for k, *_ in found])
                names.append(list(dict.fromkeys(x.name for x in scanner.recognise(found))))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, strings), pa.array(names, strings)], ["id", "sentences", "licenses"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "id long, sentences array<string>, licenses array<string>")
