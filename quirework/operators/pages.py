"""Pages: boilerplate classification with reasons, cleaning, header hints, counts.

A page table has doc_id, page_number and text. Every step is a projection: no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions.text import java, match_form, squeeze, strip

#: Letters that differ from an ASCII letter in case alone, though not by a simple rule.
ODD_CASES = ("\u017f\u0131\u0130\u212a", "siik")


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with columns added or replaced, each computed once a row.

    They pass through a generator, which the optimizer neither merges with what uses them nor moves
    a filter across: as plain columns they would be copied into every use, and within an
    array's lambda be computed again for each element.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*kept, F.inline(F.array(F.struct(*(x.alias(c) for c, x in cols.items())))))


def needed_words(pattern: str) -> str:
    """The longest literal part of a page pattern, lower case: without it nothing matches."""
    return max(re.split(r"\\s[*+]|[\^$]", pattern), key=len).lower()


def boilerplate_reason(text: Column, page_number: Column, low: Column, size: Column, lines: Column) -> Column:
    """Why a page is no content, by the first rule that fits; null: it is content.

    ``low``: the text in lower case; ``size``: its length with white space collapsed; ``lines``:
    how many of its lines aren't blank. A pattern is only tried on a page that has its literal
    part: a substring search is far cheaper than fifteen regular expressions over every page.
    """
    reason = F.when(page_number <= rules.FIRST_PAGES, F.lit(rules.FIRST_PAGES_REASON))
    for pattern, name in rules.PAGE_PATTERNS:
        reason = reason.when(low.contains(needed_words(pattern)) & text.rlike(java(pattern, "imdu")), F.lit(name))
    reason = reason.when(size < rules.SPARSE_CHARS, F.concat(F.lit("Sparse content ("), size.cast("string"), F.lit(" chars)")))
    return reason.when(lines <= rules.FEW_LINES, F.concat(F.lit("Too few lines ("), lines.cast("string"), F.lit(")")))


def is_clean_line(line: Column, title_form: Column) -> Column:
    """A line that is neither the document's title, nor a page number, nor blank."""
    s = strip(line)
    # most lines differ from the title in length or first letter
    other = (F.length(s) < F.length(title_form)) | ~F.lower(F.substring(s, 1, 1)).startswith(F.substring(title_form, 1, 1)) | (match_form(s) != title_form)
    return (s != "") & other & ~s.rlike(java(r"^(?:[ivxlcdmIVXLCDM\u0130\u0131]+|\d+|IN-\d+)\z"))


def header_hints(lines: Column) -> Column:
    """The lines, an array, that look like headers, stripped and in order.

    A line is seen beside the two that follow it, as shifted copies of the array: linear in
    the lines.
    """
    plain = F.transform(lines, strip)
    behind = lambda a, n: F.slice(a, n + 1, F.size(a))
    rows = F.arrays_zip(plain.alias("s"), behind(lines, 1).alias("one"), behind(plain, 1).alias("s1"), behind(lines, 2).alias("two"), behind(plain, 2).alias("s2"))

    def header(x: Column) -> Column:
        raw, after = (F.when(x["s1"] != "", x[a]).when(x["s2"] != "", x[b]) for a, b in (("one", "two"), ("s1", "s2")))
        follows = raw.rlike(r"^\p{Ll}")
        for o in rules.HINT_OPENERS:
            follows = follows | after.startswith(o)
        s = x["s"]
        return s.isNotNull() & F.length(s).between(5, 80) & s.rlike(r"^\p{Lu}") & ~s.endswith(".") & F.coalesce(follows, F.lit(False))

    return F.transform(F.filter(rows, header), lambda x: x["s"])


def clean_pages(pages: DataFrame, title: Column | None = None) -> DataFrame:
    """Pages with is_boilerplate and boilerplate_reason. Boilerplate keeps its raw text, content
    pages get the clean lines, unchanged, joined again. A null text counts as empty, a null
    title too; all other columns stay."""
    name = "page_facts"
    while name in pages.columns:
        name += "_"
    text = F.coalesce("text", F.lit(""))
    facts = F.struct(
        text.alias("text"),
        F.split(text, "\n").alias("lines"),
        F.lower(F.when(text.rlike(f"[{ODD_CASES[0]}]"), F.translate(text, *ODD_CASES)).otherwise(text)).alias("low"),
        F.length(squeeze(text)).alias("size"),
        match_form(F.coalesce(F.lit("") if title is None else title, F.lit(""))).alias("title"),
    )
    p = once(pages, **{name: facts})
    f = F.col(name)
    full = F.size(F.filter(f["lines"], lambda x: strip(x) != ""))
    p = once(p, boilerplate_reason=boilerplate_reason(f["text"], F.col("page_number"), f["low"], f["size"], full))
    bad = F.col("boilerplate_reason").isNotNull()
    clean = F.array_join(F.filter(f["lines"], lambda x: is_clean_line(x, f["title"])), "\n")
    p = p.withColumn("is_boilerplate", bad)
    return once(p, text=F.when(bad, f["text"]).otherwise(clean)).drop(name)


def classify_pages(pages: DataFrame, title: Column | None = None) -> DataFrame:
    """Clean pages with has_chapter_header, has_section_header and detected_headers."""
    p = clean_pages(pages, title)
    none = F.array().cast("array<string>")
    p = once(p, detected_headers=F.when(F.col("is_boilerplate"), none).otherwise(header_hints(F.split("text", "\n"))))
    hint = java(rules.CHAPTER_HINT, "md")
    p = p.withColumn("has_chapter_header", ~F.col("is_boilerplate") & F.col("text").contains("CHAPTER") & F.col("text").rlike(hint))
    return p.withColumn("has_section_header", F.size("detected_headers") > 0)


def content_pages(pages: DataFrame) -> DataFrame:
    return pages.where(~F.col("is_boilerplate"))


def boilerplate_pages(pages: DataFrame) -> DataFrame:
    return pages.where("is_boilerplate")


def page_counts(pages: DataFrame) -> DataFrame:
    """Totals of classified pages, one row."""
    return pages.agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.count_if(~F.col("is_boilerplate")).alias("content_pages"),
        F.count_if("is_boilerplate").alias("boilerplate_pages"),
        F.count_if(F.size("detected_headers") > 0).alias("pages_with_headers"),
        F.coalesce(F.sum(F.size("detected_headers")), F.lit(0)).cast("long").alias("total_headers"),
    )


def reason_histogram(df: DataFrame, reason: str, order: str) -> DataFrame:
    """(reason, n) by falling count; ties in order of first appearance."""
    hist = df.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
    return hist.orderBy(F.desc("n"), "first_seen")


def resolve_title(metadata_title: Column, file_stem: Column) -> Column:
    """The stripped metadata title; the file's stem where that is missing, empty or 'untitled'."""
    t = strip(F.coalesce(metadata_title, F.lit("")))
    return F.when((t == "") | (F.lower(t) == "untitled"), file_stem).otherwise(t)
