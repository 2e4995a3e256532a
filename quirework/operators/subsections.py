"""Subsections: ordered merging of split ones, and accept/reject with reasons.

A section table comes from ``sections.section_table``; (doc_id, chapter_idx, pos) is its order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions.text import count_tokens, java, lstrip, preview, rstrip, strip

CHAPTER = ["doc_id", "chapter_idx"]


def merge_split(sections: DataFrame) -> DataFrame:
    """Subsections of one title below one parent become one, at the place of the first.

    Contents are joined with an empty line in between (blank ones are passed over), notes in order,
    the last page is the furthest; the word count is taken anew where something merged.
    Adds n_merged, the number of rows that went into others.
    """
    h2, h3 = sections.where("section_level = 2"), sections.where("section_level = 3")
    part = F.struct("pos", "page_start", "content", "notes", "word_count")
    g = h3.groupBy(*CHAPTER, F.coalesce("parent_section", F.lit("")).alias("_parent"), "section_title").agg(
        F.array_sort(F.collect_list(part)).alias("p"),
        F.max("page_end").alias("page_end"),
        *(F.first(c).alias(c) for c in ("chapter_number", "chapter_title", "parent_section", "section_level", "h3_count", "chapter_summary")),
    )
    first = F.get("p", F.lit(0))
    rest = F.filter(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), lambda x: strip(x["content"]) != "")
    joined = F.aggregate(rest, first["content"], lambda acc, x: F.concat(rstrip(acc), F.lit("\n\n"), lstrip(x["content"])))
    g = g.withColumn("content", joined).withColumn("n_merged", (F.size("p") - 1).cast("long"))
    merged = g.select(
        *CHAPTER,
        first["pos"].alias("pos"),
        "chapter_number",
        "chapter_title",
        "section_title",
        "section_level",
        "parent_section",
        first["page_start"].alias("page_start"),
        "page_end",
        "content",
        F.flatten(F.transform("p", lambda x: x["notes"])).alias("notes"),
        F.when(F.col("n_merged") > 0, count_tokens(F.col("content"))).otherwise(first["word_count"]).alias("word_count"),
        "h3_count",
        "chapter_summary",
        "n_merged",
    )
    return h2.withColumn("n_merged", F.lit(0).cast("long")).unionByName(merged)


def _words(n: Column) -> Column:
    return n.cast("string")


def judge(title: Column, word_count: Column) -> tuple[Column, Column]:
    """(accepted, reason) of a subsection, by the first rule that fits."""
    t = strip(title)
    low = F.lower(t)
    head = F.lower(F.coalesce(F.get(F.split(t, java(r"\s+"), 2), F.lit(0)), F.lit("")))
    root = F.substring_index(head, "-", 1)
    prose = F.concat(F.lit("Title starts with sentence-starter '"), head, F.lit("' (looks like prose, not header)"))
    no = F.lit(False)
    chain = [
        (F.length(t) < 4, no, F.lit("Title too short (<4 chars)")),
        (head.contains("-") & root.isin(*rules.SENTENCE_STARTERS), no, prose),
        (head.isin(*rules.SENTENCE_STARTERS), no, prose),
        (word_count == 0, no, F.lit("Zero word content (empty section)")),
        (t.rlike(java(rules.PRODUCT_TITLE, "iud")), no, F.lit("Cisco product/serial number pattern")),
        (t.rlike(java(rules.LOG_TITLE, "iud")), no, F.lit("Cisco syslog/CLI output line")),
        (low.isin(*rules.STATUS_VALUES), no, F.lit("Pure status value")),
        (low.isin(*rules.SYSTEM_STRINGS), no, F.lit("System/terminal output string")),
        *((low.startswith(s), no, F.lit(f"Starts with system string: '{s}'")) for s in rules.SYSTEM_STRINGS),
        (low.isin(*rules.TABLE_HEADERS), no, F.lit("Table header repetition")),
        (t.rlike(java(rules.DIGITS_SYMBOLS)), no, F.lit("Mostly digits/symbols")),
        (word_count >= rules.ENOUGH_WORDS, F.lit(True), F.concat(F.lit("Sufficient content ("), _words(word_count), F.lit(" words)"))),
        (
            t.rlike(java(rf"\b({'|'.join(rules.TITLE_KEYWORDS)})\b", "iu")) | t.rlike(java(rf"\b({'|'.join(rules.TITLE_END_KEYWORDS)})\s*\z", "iu")),
            F.lit(True),
            F.concat(F.lit("Keyword pattern (only "), _words(word_count), F.lit(" words content)")),
        ),
    ]
    accepted, reason = F.when(chain[0][0], chain[0][1]), F.when(chain[0][0], chain[0][2])
    for test, verdict, why in chain[1:]:
        accepted, reason = accepted.when(test, verdict), reason.when(test, why)
    return accepted.otherwise(False), reason.otherwise(F.concat(F.lit("Insufficient content ("), _words(word_count), F.lit(" words) and no keyword pattern")))


def decisions(sections: DataFrame) -> DataFrame:
    """One row per subsection: accepted, reason, word count and a preview."""
    accepted, reason = judge(F.col("section_title"), F.col("word_count"))
    parent = F.coalesce(F.nullif("parent_section", F.lit("")), F.lit("?"))
    return sections.where("section_level = 3").select(
        *CHAPTER, "pos", "chapter_number", parent.alias("parent_section"), "section_title", accepted.alias("accepted"), reason.alias("reason"), "word_count", preview(F.col("content")).alias("content_preview")
    )


def keep_accepted(sections: DataFrame, decided: DataFrame) -> DataFrame:
    """Sections, and the subsections of which the chapter accepted a title; h3_count is
    counted anew. Titles decide, so a rejected twin of an accepted one stays."""
    key = F.struct("chapter_idx", "section_title")
    titles = decided.where("accepted AND chapter_idx IS NOT NULL AND section_title IS NOT NULL").groupBy("doc_id").agg(F.collect_set(key).alias("_titles"))
    h3 = sections.where("section_level = 3").join(titles, "doc_id").where(F.array_contains("_titles", key)).select(sections.columns)
    count = h3.where("parent_section IS NOT NULL").groupBy(*CHAPTER, F.col("parent_section").alias("section_title")).agg(F.count(F.lit(1)).alias("n"))
    count = count.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), "n"))).alias("_counts"))
    n = F.when(F.col("section_title").isNotNull(), F.try_element_at("_counts", key))
    h2 = sections.where("section_level = 2").join(count, "doc_id", "left").withColumn("h3_count", F.coalesce(n, F.lit(0)).cast("long"))
    return h2.select(sections.columns).unionByName(h3)


def acceptance(decided: DataFrame) -> DataFrame:
    """One row: total, accepted, rejected, and the rate, 0 on empty input."""
    n, ok = F.count(F.lit(1)), F.count_if("accepted")
    return decided.agg(n.alias("total"), ok.alias("accepted"), (n - ok).alias("rejected"), F.when(n == 0, 0.0).otherwise(ok / n).alias("acceptance_rate"))


def filter_sections(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sections after merging and filtering, decisions)."""
    merged = merge_split(sections).drop("n_merged")
    decided = decisions(merged)
    return keep_accepted(merged, decided), decided
