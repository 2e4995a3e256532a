"""Generation units: granularity, suggested type, prompts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions.text import notes_block, page_range, strip

CHAPTER = ["doc_id", "chapter_idx"]
CHILD = ("pos", "section_title", "content", "notes", "page_start", "page_end", "word_count")


def suggest_type(title: Column, content: Column) -> Column:
    """troubleshooting, config or theory by words of the title, then of the text's start."""
    t, c = F.lower(title), F.substring(F.lower(content), 1, 500)
    any_of = lambda col, words: F.greatest(*(col.contains(w) for w in words), F.lit(False))
    kind = F.when(any_of(t, rules.TROUBLE_TITLES), "troubleshooting").when(any_of(t, rules.CONFIG_TITLES), "config")
    return kind.when(any_of(c, rules.CONFIG_TEXTS), "config").otherwise("theory")


def with_children(sections: DataFrame) -> DataFrame:
    """Sections of level 2 with the array of their subsections, in order. Sections of one
    title each get all of them."""
    h3 = sections.where("section_level = 3 AND parent_section <> ''")
    kids = h3.groupBy(*CHAPTER, F.col("parent_section").alias("section_title")).agg(F.array_sort(F.collect_list(F.struct(*CHILD))).alias("children"))
    h2 = sections.where("section_level = 2").join(kids, [*CHAPTER, "section_title"], "left")
    kind = kids.schema["children"].dataType
    return h2.withColumn("children", F.coalesce("children", F.array().cast(kind)))


def split_units(sections: DataFrame, combine_words: int = 400, combine_children: int = 2, own_words: int = 100) -> DataFrame:
    """One row per unit, in order (chapter_idx, pos, sub): a small section with its few
    subsections as one, else the section if it is long enough, and each subsection."""
    h2 = with_children(sections)
    small = (F.col("word_count") < combine_words) & (F.size("children") <= combine_children)
    kind = h2.schema["children"].dataType
    none = F.array().cast(kind)
    own = ["chapter_number", "chapter_title", "chapter_summary"]
    cols = [*CHAPTER, "pos", "sub", *own, "section_title", "section_level", "parent_section", "page_start", "page_end", "content", "notes", "word_count", "children"]
    whole = h2.where(small | (F.col("word_count") >= own_words)).withColumn("children", F.when(small, F.col("children")).otherwise(none))
    whole = whole.withColumn("sub", F.lit(0)).withColumn("parent_section", F.lit(None).cast("string")).select(cols)
    each = h2.where(~small).select(*CHAPTER, "pos", *own, F.col("section_title").alias("parent_section"), F.posexplode("children").alias("i", "c"))
    each = each.select(*CHAPTER, "pos", (F.col("i") + 1).alias("sub"), *own, "c.section_title", F.lit(3).alias("section_level"), "parent_section", "c.page_start", "c.page_end", "c.content", "c.notes", "c.word_count", none.alias("children"))
    units = whole.unionByName(each)
    return units.withColumn("suggested_type", suggest_type(F.col("section_title"), F.col("content")))


def describe(units: DataFrame) -> DataFrame:
    """Adds what a prompt needs: full_content, all_notes, page_range and total_words (which
    counts children twice where the section's count holds them already)."""
    body = F.concat(F.array(F.col("content")), F.transform("children", lambda c: F.concat(F.lit("\n\n### "), c["section_title"], F.lit("\n\n"), c["content"])))
    fold = lambda f, c, start: F.aggregate("children", start, lambda a, x: f(a, x[c]))
    u = units.withColumn("full_content", strip(F.array_join(body, "\n")))
    u = u.withColumn("all_notes", F.concat("notes", F.flatten(F.transform("children", lambda c: c["notes"]))))
    u = u.withColumn("first_page", fold(F.least, "page_start", F.col("page_start"))).withColumn("last_page", fold(F.greatest, "page_end", F.col("page_end")))
    u = u.withColumn("page_range", page_range(F.col("first_page"), F.col("last_page")))
    return u.withColumn("total_words", fold(lambda a, x: a + x, "word_count", F.col("word_count")))


PROMPT = """# Source section

Document: $document_title
Chapter $chapter_number: $chapter_title
About the chapter: $chapter_summary
Section: $section_title (level $section_level)
Parent section: $parent_section
Pages: $page_range
Words: $word_count
Likely type: $kb_type

# Text

$section_content

$notes_block
"""


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """The template with $name and ${name} replaced; unknown names stay, $$ is a dollar sign.
    The values aren't looked into, so a $name in a text survives."""
    import re

    parts, at = [], 0
    for m in re.finditer(r"\$(?:(\$)|\{([A-Za-z_]\w*)\}|([A-Za-z_]\w*))", template):
        name = m[2] or m[3]
        if not m[1] and name not in values:
            continue
        parts += [F.lit(template[at : m.start()]), F.lit("$") if m[1] else F.coalesce(values[name].cast("string"), F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def with_prompts(units: DataFrame, document_title: Column, template: str = PROMPT) -> DataFrame:
    u = describe(units)
    top = F.lit("None (a top-level section)")
    values = {
        "document_title": document_title, "chapter_number": F.col("chapter_number"), "chapter_title": F.col("chapter_title"),
        "chapter_summary": F.col("chapter_summary"), "section_title": F.col("section_title"), "section_level": F.col("section_level"),
        "parent_section": F.coalesce("parent_section", top), "page_range": F.col("page_range"), "word_count": F.col("total_words"),
        "section_content": F.col("full_content"), "notes_block": notes_block(F.col("all_notes")), "kb_type": F.col("suggested_type"),
    }
    return u.withColumn("user_prompt", fill(template, values))


def first_units(units: DataFrame, n: int, order: tuple[str, ...] = ("chapter_idx", "pos", "sub")) -> DataFrame:
    """The first n units of each document; all where n is 0. Taken before prompts are built."""
    if not n:
        return units
    w = Window.partitionBy("doc_id").orderBy(*order)
    return units.withColumn("_row", F.row_number().over(w)).where(F.col("_row") <= n).drop("_row")


def skip_advice(units: DataFrame) -> DataFrame:
    """An extension, not parity: adds skip_advice, why a unit may be of no use, or null. The
    checkable ones of the rules that a generator is given."""
    title, text = F.lower(F.col("section_title")), F.col("content")
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")
    points = F.size(F.filter(lines, lambda x: x.rlike(r"(?i)^\s*(?:see|refer to|for more information)\b")))
    mibs = F.size(F.filter(lines, lambda x: x.rlike(r"(?i)\bmibs?\b|-MIB\b")))
    why = (
        F.when(title.contains("additional references"), "additional references")
        .when((F.size(lines) > 0) & (points == F.size(lines)), "cross-reference only")
        .when((F.size(lines) > 0) & (2 * mibs > F.size(lines)), "MIB list")
        .when(F.col("word_count") < rules.USEFUL_WORDS, "fewer than 50 words")
    )
    return units.withColumn("skip_advice", why)
