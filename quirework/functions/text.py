"""Text functions as Column expressions: JVM-side, no Python per row.

White space is Unicode's, with the four separators U+001C to U+001F, digits are of any script, and
multi-line anchors only know ``\\n``, as the rules need it; Java's defaults differ in all of
these, and its own Unicode mode in the second and is far slower.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirework.functions import rules

#: White space, as the inside of a character class and as characters. The far ones lie behind one
#: comparison, as most characters are near.
_FAR = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE = r"\t-\r\x1c-\x20\x85\xa0" + _FAR
OTHER_SPACE = r"\t-\r\x1c-\x1f\x85\xa0" + _FAR  # all but the blank
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WORD = r"[\p{L}\p{N}_]+"


def java(pattern: str, flags: str = "") -> str:
    """A rule's pattern in Java's syntax, with the meaning of \\s, \\S, \\d, \\w and \\b as above."""
    out, at, inside = [], 0, False
    classes = {"s": f"[{SPACE}]", "S": f"[^{SPACE}]", "d": r"\p{Nd}", "w": r"[\p{L}\p{N}_]", "b": r"(?:(?<=[\p{L}\p{N}_])(?![\p{L}\p{N}_])|(?<![\p{L}\p{N}_])(?=[\p{L}\p{N}_]))"}
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            name = pattern[at + 1]
            found = classes.get(name, pattern[at : at + 2])
            out.append(found[1:-1] if inside and name in "sw" else found)
            at += 2
            continue
        inside = c == "[" or (inside and c != "]")
        out.append(c)
        at += 1
    return (f"(?{flags})" if flags else "") + "".join(out)


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, stripped. Single blanks, most of all there is, match nothing."""
    return F.btrim(F.regexp_replace(c, f"[{OTHER_SPACE}][{SPACE}]*+| [{SPACE}]++", " "))


def match_form(c: Column) -> Column:
    """Tolerant form for comparing titles and lines."""
    return F.lower(squeeze(c))


def match_key(c: Column, longest: int = 120) -> Column:
    """What is equal where the match forms are: the form itself, of a longer one a digest behind a
    blank, which no form begins with. So long lines needn't be carried along to be compared."""
    form = match_form(c)
    return F.when(F.length(form) <= longest, form).otherwise(F.concat(F.lit(" "), F.sha2(form.cast("binary"), 256)))


def count_words(c: Column) -> Column:
    """Runs of word characters."""
    return F.size(F.regexp_extract_all(c, F.lit(WORD), F.lit(0))).cast("long")


def count_tokens(c: Column) -> Column:
    """Runs of non-white-space."""
    return F.size(F.regexp_extract_all(c, F.lit(java(r"\S+")), F.lit(0))).cast("long")


def title_form(c: Column) -> Column:
    """Title for comparison: no chapter number, no punctuation, lower case."""
    t = F.lower(F.coalesce(c, F.lit("")))
    t = F.regexp_replace(t, java(r"^chapter\s+\d+:?\s+"), "")
    t = F.regexp_replace(t, java(r"^\d+\.\s+"), "")
    return squeeze(F.regexp_replace(t, r"[^\p{L}\p{N}_]", " "))


def title_of_id(c: Column) -> Column:
    """A likely section title from an id: without platform prefix and type suffix."""
    prefix = "|".join(rules.PLATFORM_PREFIXES)
    suffix = "|".join(rules.TYPE_SUFFIXES)
    bare = F.regexp_replace(F.regexp_replace(c, f"(?i)^(?:{prefix})", ""), rf"(?i)(?:{suffix})\z", "")
    return F.coalesce(F.btrim(F.translate(bare, "-", " ")), F.lit(""))


def slug(c: Column) -> Column:
    """Lower case, other than a-z and 0-9 as single dashes; 'untitled' when nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("untitled"))


def page_range(start: Column, end: Column) -> Column:
    return F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))


def preview(c: Column, n: int = 80) -> Column:
    """The first characters of the stripped text, cut before line breaks become blanks."""
    return F.replace(F.substring(strip(c), 1, n), F.lit("\n"), F.lit(" "))


def notes_block(notes: Column) -> Column:
    """A heading and a bullet per note; empty without notes."""
    bullets = F.array_join(F.transform(notes, lambda n: F.concat(F.lit("- "), n)), "\n")
    return F.when(F.size(notes) > 0, F.concat(F.lit("## Notes found in this section\n\n"), bullets)).otherwise("")


def strip_fence(c: Column) -> Column:
    """A response without the code fence around it."""
    s = strip(c)
    inner = F.regexp_replace(F.regexp_replace(s, java(rules.FENCE_START), ""), java(rules.FENCE_END), "")
    return F.when(s.startswith("```"), inner).otherwise(s)


def override_platform(c: Column, platform: str | None) -> Column:
    """Sets ``platform:`` in the first front matter block; anything else stays as it is."""
    if not platform:
        return c
    parts = F.split(c, "\n---\n", 2)
    head = F.get(parts, 0)
    quoted = platform.replace("\\", "\\\\").replace("$", "\\$")
    line = r"(?smd)\A(.*?)^platform:[ \t]*[^\n]*$"
    replaced = F.regexp_replace(head, line, f"$1platform: {quoted}")
    first_break = F.instr(head, "\n")
    inserted = F.when(first_break > 0, F.concat(F.substring_index(head, "\n", 1), F.lit(f"\nplatform: {platform}\n"), head.substr(first_break + 1, F.length(head)))).otherwise(F.concat(head, F.lit(f"\nplatform: {platform}")))
    new_head = F.when(head.rlike(r"(?md)^platform:"), replaced).otherwise(inserted)
    has_block = c.startswith("---") & (F.size(parts) == 2)
    return F.when(has_block, F.concat(new_head, F.lit("\n---\n"), F.get(parts, 1))).otherwise(c)


def duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("%dh %02dm %02ds", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
