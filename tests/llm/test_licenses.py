import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm.licenses import RULES, SENTENCES, STEMS, Scanner, complete, normalise, scan_documents, sentences_of

S = Scanner()

EXAMPLES = {
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    "mit.notice": "The above copyright notice and this permission notice shall be included.",
    "asis.software": "The software is provided \"as is\", without warranty.",
    "mit.liable": "In no event shall the authors or copyright holders be liable.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "bsd.source": "Redistributions of source code must retain the above copyright notice.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice.",
    "bsd.advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "bsd.endorse": "Neither the name of X nor of others may be used to endorse or promote products.",
    "bsd.asis": "This software is provided by X \"as is\" and any express or implied warranties are disclaimed.",
    "bsd.liable": "In no event shall X be liable for any direct, indirect, incidental, special, exemplary, or consequential damages.",
    "apache.2.ref": "Licenced under Apache License 2.0.",
    "apache.2.name": "Apache Licence, Version 2.0",
    "apache.comply": "You may not use this file except in compliance with the License.",
    "apache.obtain": "You may obtain a copy of the License at x.",
    "apache.asis": "Distributed under the License is distributed on an \"AS IS\" basis.",
    "apache.see": "See the License for the specific language governing permissions and limitations.",
    "agpl.3.ref": "GNU Affero General Public License v3",
    "lgpl.3.ref": "GNU Lesser General Public License version 3",
    "lgpl.2.ref": "GNU Library General Public License v2",
    "gpl.3.ref": "GNU General Public License v3",
    "gpl.2.ref": "GNU General Public License v2",
    "gpl.ref": "GNU General Public License",
    "gpl.hope": "Distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.",
    "gpl.copy": "You should have received a copy of the GNU thing.",
    "gpl.later": "Or (at your option) any later version.",
    "mpl.2.ref": "Mozilla Public License v2",
    "spdx.ref": "SPDX-License-Identifier: MIT",
    "epl.ref": "Eclipse Public License v2.0",
    "cddl.ref": "Common Development and Distribution License 1.1",
    "artistic.ref": "Artistic License 2.0",
    "eupl.ref": "European Union Public Licence v. 1.2",
    "bsl.ref": "Boost Software License - Version 1.0",
    "ofl.ref": "SIL Open Font License, Version 1.1",
    "wtfpl.ref": "Do What The Fuck You Want To Public License",
    "zlib.asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib.grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications.",
    "zlib.origin": "The origin of this software must not be misrepresented.",
    "zlib.marked": "Altered source versions must be plainly marked as such.",
    "zlib.notice": "This notice may not be removed or altered from any source distribution.",
    "zlib.ref": "Released under the zlib license.",
    "mit.ref": "Released under the MIT License.",
    "bsd.ref": "Released under a BSD-style license.",
    "isc.ref": "Released under the ISC license.",
    "cc.zero": "Released as CC0.",
    "cc.by.nc.nd": "It is CC BY-NC-ND 4.0.",
    "cc.by.nc.sa": "It is CC BY-NC-SA 4.0.",
    "cc.by.nc": "It is CC BY-NC 4.0.",
    "cc.by.nd": "It is CC BY-ND 4.0.",
    "cc.by.sa": "The data set is CC BY-SA 4.0.",
    "cc.by": "It is CC BY 4.0.",
    "unlicense": "This is free and unencumbered software released into the public\ndomain.",
    "public.domain": "It is in the public-domain.",
    "reserved": "All rights\nreserved.",
    "no.copying": "No part of this book may be reproduced in any form.",
    "copyright": "© 2020 X",
}


def names(text):
    return [f.name for f in S.recognise(S.identify(text))]


def plain_rules(ids):
    """Rules as regular expressions over the identifiers, tried in order at each place."""
    text, at, out = "".join(f"<{i}>" for i in ids), 0, []
    while at < len(text):
        for name, seq in RULES:
            m = re.compile("".join(f"(?:<{re.escape(x[:-1])}>)?+" if x.endswith("?") else f"<{re.escape(x)}>" for x in seq.split())).match(text, at)
            if m and m.end() > at:
                out.append(name)
                at = m.end()
                break
        else:
            end = text.index(">", at) + 1
            out.append("?" + text[at + 1 : end - 1])
            at = end
    return out


def plain_identifiers(text):
    """Every pattern tried on every sentence, without any gate."""
    out = []
    for raw in sentences_of(text):
        s, taken = normalise(raw), []
        for key, p in SENTENCES:
            m = re.search(p, s)
            if m and all(m.end() <= a or b <= m.start() for a, b, _ in taken):
                taken.append((m.start(), m.end(), key))
        out += [k for _, _, k in sorted(taken)]
    return out


PROSE = ["The committee met in spring.", "A license plate was found.", "Nothing else; the rest follows!", "It costs 3.0 pounds."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(sorted(EXAMPLES)), st.sampled_from(PROSE)), st.sampled_from([" ", "\n", "\n\n", "\n// "])), max_size=12))
def test_documents_equal_brute_force(parts):
    """Known sentences among prose: what is found is what was put in, and rules take it in order."""
    text = ""
    for key, gap in parts:
        text += EXAMPLES.get(key, key) + gap
    found = S.identify(text)
    merged = [k for k, _ in itertools.groupby(plain_identifiers(text))]
    assert [k for k, _ in itertools.groupby(k for k, *_ in found)] == merged
    ids = [k for k, *_ in found]
    assert [f.name for f in S.recognise([(k, 0, "") for k in ids])] == [complete(n, "") for n in plain_rules(ids)]


@pytest.mark.parametrize(("text", "want"), [
    ("SPDX-License-Identifier: Apache-2.0", ["apache-2.0"]), ("// SPDX-License-Identifier: MIT\nint x;", ["mit"]), ("# SPDX-License-Identifier: GPL-2.0-or-later\n", ["gpl-2.0-or-later"]), ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */", ["mit-or-apache-2.0"]),
    ("It is CC BY-SA 4.0.", ["CC-BY-SA-4.0"]), ("Creative Commons Attribution.", ["CC-BY"]), ("Eclipse Public License v2.0", ["EPL-2.0"]), ("Artistic License 2.0", ["Artistic-2.0"]),
    ("Boost Software License - Version 1.0", ["BSL-1.0"]), ("SIL Open Font License, Version 1.1", ["OFL-1.1"]), ("EUROPEAN UNION PUBLIC LICENCE v. 1.2", ["EUPL-1.2"]), ("Common Development and Distribution License 1.1", ["CDDL-1.1"]),
    ("This software is provided 'as-is', without any express or implied warranty. Permission is granted to anyone to use this software for any purpose, including commercial applications. The origin of this software must not be misrepresented; you must not claim it. Altered source versions must be plainly marked as such. This notice may not be removed or altered from any source distribution.", ["Zlib"]),
])
def test_more_licences(text, want):
    assert names(text) == want


@pytest.mark.parametrize(("text", "want"), [
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("You can use it under the GNU General Public Licence version 2, or (at your option) any later version.", ["GPL-2.0-or-later"]),
    ("Some prose.\nReleased under the MIT License.\nMore prose.", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("Copyright 2020 X. All rights reserved.", ["Proprietary"]),
    ("All rights reserved.\nReleased under the MIT License.", ["MIT"]),
    ("You may obtain a copy of the License at http://x.", ["?apache.obtain"]),
    ("no licence here", []),
    ("", []),
])
def test_rules(text, want):
    assert names(text) == want


def test_full_text_over_broken_lines():
    mit = (
        "// Copyright (c) 2020 X\n//\n// Permission is hereby granted, free of charge, to any person obtaining a copy\n// of this software.\n//\n"
        "// The above copyright notice and this permission notice shall be included in all\n// copies.\n//\n"
        "// THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE\n// AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.\n"
    )
    assert names(mit) == ["MIT"]


def test_passing_over_texts_changes_nothing(odd_docs):
    plain = Scanner(stems=("",))
    corpus = [r.text or "" for r in odd_docs.collect()] + list(EXAMPLES.values()) + [" ".join(EXAMPLES.values()), "\n\n".join(EXAMPLES.values())]
    assert sum(bool(plain.identify(t)) for t in corpus) >= len(EXAMPLES)
    for t in corpus:
        assert plain.identify(t) == S.identify(t)


def test_tables_are_sound():
    known = {k for k, _ in SENTENCES}
    assert all(x.removesuffix("?") in known for _, seq in RULES for x in seq.split())
    assert len(SENTENCES) == len(known) and STEMS


def test_normalise():
    assert normalise("  The Licence, v2.0 (c)!") == "the license v2 0 c"


def test_odd_rows(spark, odd_docs, no_docs):
    assert scan_documents(odd_docs).count() == odd_docs.count()
    assert scan_documents(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, None)], "doc_id long, text string")
    assert sorted((r.id, r.licenses) for r in scan_documents(docs).collect()) == [(1, ["MIT"]), (1, ["MIT"]), (2, [])]


@pytest.mark.parametrize("run", ["\n" * 200_000, "\n" + " " * 200_000, "\n#" * 100_000, "\n \t" * 70_000, ". " * 100_000, "license " * 20_000])
def test_long_runs_are_linear(run):
    import time

    began = time.time()
    S.identify("license " + run + "x")
    assert time.time() - began < 10




def test_every_sentence_passes_the_gate():
    plain = Scanner(stems=("",))
    assert EXAMPLES.keys() == {k for k, _ in SENTENCES}
    for key, text in EXAMPLES.items():
        for x in (text, f"Some prose.\n\n{text}"):
            found = S.identify(x)
            assert key in [k for k, *_ in found] and found == plain.identify(x), key


def test_stems_come_from_the_table():
    assert "" not in STEMS
    assert [k for k, *_ in Scanner([("x", r"(?:ab|c) (?:quux|corge)\w+ ?")]).identify("c corges")] == ["x"]
    assert [k for k, *_ in Scanner([("x", r"\d+")]).identify("12")] == ["x"]


def test_bsd_4_clause():
    bsd = (
        "Copyright (c) 1990 X\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that "
        "the following conditions are met:\n1. Redistributions of source code must retain the above copyright\n   notice.\n2. Redistributions in binary form must reproduce "
        "the above copyright\n   notice.\n3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n"
        "   This product includes software developed by X.\n4. Neither the name of X nor the names of its contributors may be used to endorse or promote products\n"
        "   derived from it.\n\nTHIS SOFTWARE IS PROVIDED BY X ``AS IS'' AND ANY EXPRESS OR IMPLIED\nWARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL X BE LIABLE FOR ANY\n"
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES.\n"
    )
    assert names(bsd) == ["BSD-4-Clause"]
    assert names("Released as CC0.") == ["CC0-1.0"] and names("The data set is CC BY-SA 4.0.") == ["CC-BY-SA-4.0"]
    assert names("All rights reserved. No part of this book may be reproduced.") == ["Proprietary"]
