"""Lines to chapters, sections and subsections, by ordered windows within a document.

A line table has doc_id, line_no, page_number and text; line_no is the order. All windows
are partitioned by document or finer, so a job over many manuals spreads over the
cluster, and consecutive windows share one exchange. Texts are moved once, by document: what is
joined to lines or sections comes as one row per document, by doc_id alone, so that a table dealt
out or bucketed by it stays where it is. Python is used for one thing alone: chapters with a
contents entry that no line equals are matched again with difflib.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions.text import count_words, java, match_key, strip

DOC, CHAPTER = ["doc_id"], ["doc_id", "chapter_idx"]
SECTION, BLOCK = [*CHAPTER, "sec_idx"], [*CHAPTER, "sec_idx", "h3_idx"]


def explode_lines(pages: DataFrame) -> DataFrame:
    """(doc_id, line_no, page_number, text) of the content pages, in page order."""
    w = Window.partitionBy("doc_id").orderBy("page_number", "pos")
    rows = pages.where(~F.col("is_boilerplate")).select("doc_id", "page_number", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return rows.withColumn("line_no", (F.row_number().over(w) - 1).cast("long")).select("doc_id", "line_no", "page_number", "text")


def mark_chapters(lines: DataFrame) -> DataFrame:
    """Lines with their match key (norm), the chapter they lie in (0: before the first),
    the marks of the chapter's start, title line, first contents entry and end of contents."""
    w = Window.partitionBy(*DOC).orderBy("line_no")
    x = lines.select("doc_id", "line_no", "page_number", "text").withColumn("norm", match_key(F.col("text")))
    x = x.withColumn("s", strip(F.col("text")))
    x = x.withColumn("marker", F.nullif(F.regexp_extract("s", java(rules.CHAPTER_MARKER, "d"), 1), F.lit("")).cast("long"))
    ahead = F.first(F.nullif("s", F.lit("")), ignorenulls=True).over(w.rowsBetween(1, 3))
    x = x.withColumn("ahead", F.when(F.col("marker").isNotNull(), F.coalesce(ahead, F.lit(""))))
    x = x.withColumn("chapter_idx", F.count("marker").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    c = Window.partitionBy(*CHAPTER)
    x = x.withColumn("chapter_number", F.max("marker").over(c)).withColumn("chapter_title", F.max("ahead").over(c))
    x = x.withColumn("ch_start", F.min("line_no").over(c)).withColumn("ch_end", F.max("line_no").over(c) + 1)
    x = x.withColumn("bullet", F.nullif(F.regexp_extract("s", java(rules.TOC_BULLET, "d"), 1), F.lit("")))
    x = x.withColumn("title_line", F.min(F.when((F.col("line_no") > F.col("ch_start")) & (F.col("s") != ""), F.col("line_no"))).over(c))
    x = x.withColumn("first_bullet", F.min(F.when((F.col("line_no") > F.col("title_line")) & F.col("bullet").isNotNull(), F.col("line_no"))).over(c))
    ends = (F.col("line_no") > F.col("first_bullet")) & F.col("bullet").isNull() & (F.col("s") != "")
    return x.withColumn("toc_end", F.coalesce(F.min(F.when(ends, F.col("line_no"))).over(c), F.col("ch_end"))).drop("s", "marker", "ahead")


def _ordered(value: str, order: str = "line_no") -> Column:
    """An aggregate: the values of a group in order, without nulls."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(order, value)))), lambda x: x[value])


def chapters(marked: DataFrame) -> DataFrame:
    """One row per chapter: number, title, summary, expected section titles, page range."""
    intro = (F.col("line_no") > F.col("title_line")) & (F.col("line_no") < F.coalesce("first_bullet", "ch_end"))
    entry = F.col("bullet").isNotNull() & (F.col("line_no") >= F.col("first_bullet")) & (F.col("line_no") < F.col("toc_end"))
    x = marked.where("chapter_idx > 0").withColumn("intro", F.when(intro, F.nullif(strip(F.col("text")), F.lit("")))).withColumn("entry", F.when(entry, strip(F.col("bullet"))))
    return x.groupBy(*CHAPTER).agg(
        F.first("chapter_number").alias("chapter_number"),
        F.first("chapter_title").alias("chapter_title"),
        F.array_join(_ordered("intro"), " ").alias("chapter_summary"),
        _ordered("entry").alias("expected_sections"),
        F.first("ch_start").alias("ch_start"),
        F.first("ch_end").alias("ch_end"),
        F.first("toc_end").alias("toc_end"),
        F.min("page_number").alias("page_start"),
        F.max("page_number").alias("page_end"),
    )


def _exact_fold(expected: Column, lines: Column, start: Column) -> Column:
    """Each expected title with the first equal line at or after a cursor; the cursor moves
    behind a hit and stays on a miss. ``lines``: array of (line_no, norm) in order."""
    kind = "array<struct<title:string,line_no:bigint,fuzzy:boolean>>"
    zero = F.struct(start.cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, entry: Column) -> Column:
        hit = F.get(F.filter(lines, lambda x: (x["line_no"] >= acc["at"]) & (x["norm"] == entry["norm"])), F.lit(0))["line_no"]
        row = F.struct(entry["title"].alias("title"), hit.alias("line_no"), F.lit(False).alias("fuzzy"))
        return F.struct(F.coalesce(hit + 1, acc["at"]).alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    entries = F.transform(expected, lambda t: F.struct(t.alias("title"), match_key(t).alias("norm")))
    return F.aggregate(entries, zero, step)["out"]


def fuzzy_anchors(titles: list[str], lines: list[tuple[int, str]], start: int, ratio: float = 0.88, longest: int = 120, band: int = 15) -> Iterator[tuple[str, int | None, bool]]:
    """As the fold, but a title no line equals goes to the most similar line further on, if
    that is similar enough; of equally similar ones to the first. Longer lines come as match keys."""
    at = start
    for title in titles:
        want = " ".join(title.split()).lower()
        key = want if len(want) <= longest else f" {hashlib.sha256(want.encode()).hexdigest()}"
        hit = next((n for n, s in lines if n >= at and s in (want, key)), None)
        fuzzy = False
        if hit is None:
            best = 0.0
            for n, s in lines:
                if n < at or not s or s[0] == " " or len(s) > longest or abs(len(s) - len(want)) > band:
                    continue
                m = SequenceMatcher(None, want, s)
                if m.real_quick_ratio() > best and m.quick_ratio() > best and (r := m.ratio()) > best:
                    best, hit = r, n
            fuzzy = best >= ratio
            hit = hit if fuzzy else None
        yield title, hit, fuzzy
        at = at if hit is None else hit + 1


def section_anchors(marked: DataFrame, chapter_rows: DataFrame, fuzzy: bool = True) -> DataFrame:
    """(doc_id, chapter_idx, toc_idx, title, line_no, fuzzy): where each contents entry
    starts; line_no is null where it was not found."""
    ch = chapter_rows.select(*CHAPTER, "expected_sections", "toc_end")
    # a line can only be an anchor if it equals some entry: few lines reach the fold
    own = marked.where("chapter_idx > 0").select(*CHAPTER, "line_no", "norm")
    wanted = ch.select(*CHAPTER, F.explode(F.array_distinct(F.transform("expected_sections", lambda t: match_key(t)))).alias("norm"))
    near = marked.where("chapter_idx > 0 AND line_no >= toc_end").select(*CHAPTER, "line_no", "norm").join(wanted, [*CHAPTER, "norm"], "left_semi")
    near = near.groupBy(*CHAPTER).agg(F.array_sort(F.collect_list(F.struct("line_no", "norm"))).alias("near"))
    folded = ch.join(near, CHAPTER, "left").withColumn("near", F.coalesce("near", F.array().cast("array<struct<line_no:bigint,norm:string>>")))
    folded = folded.withColumn("anchors", _exact_fold(F.col("expected_sections"), F.col("near"), F.col("toc_end")))
    missed = F.exists("anchors", lambda a: a["line_no"].isNull())
    done = folded if not fuzzy else folded.where(~missed)
    out = done.select(*CHAPTER, F.posexplode("anchors").alias("toc_idx", "a")).select(*CHAPTER, "toc_idx", "a.title", "a.line_no", "a.fuzzy")
    if not fuzzy:
        return out

    def again(lines: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        if lines.empty or entries.empty:
            return pd.DataFrame({c: pd.Series(dtype="object") for c in ("doc_id", "chapter_idx", "toc_idx", "title", "line_no", "fuzzy")})
        e = entries.iloc[0]
        rows = sorted(zip(lines["line_no"], lines["norm"], strict=True))
        got = list(fuzzy_anchors(list(e["expected_sections"]), rows, int(e["toc_end"])))
        frame = pd.DataFrame(got, columns=["title", "line_no", "fuzzy"])
        frame["line_no"] = frame["line_no"].astype("Int64")
        return frame.assign(doc_id=e["d"], chapter_idx=e["c"], toc_idx=range(len(got)))

    kind = dict(out.dtypes)
    schema = ", ".join(f"{c} {kind[c]}" for c in out.columns)
    missing = folded.where(missed).select(F.col("doc_id").alias("d"), F.col("chapter_idx").alias("c"), "expected_sections", "toc_end")
    theirs = own.join(missing, (F.col("doc_id") == F.col("d")) & (F.col("chapter_idx") == F.col("c")), "left_semi")
    rest = theirs.groupBy(*CHAPTER).cogroup(missing.groupBy("d", "c")).applyInPandas(again, schema)
    return out.unionByName(rest.select(out.columns))


def looks_like_header(s: Column) -> Column:
    """The shape of a subsection header; ``s`` is a stripped line."""
    low = F.lower(s)
    bad = s.rlike(r"[.,:;!?]$") | s.rlike(rules.CLI_PROMPT) | s.rlike(java(r"^[\d.\s]+\z")) | s.rlike("^[•-]")
    for p in rules.NON_HEADER_PREFIXES:
        bad = bad | low.startswith(p)
    return F.length(s).between(5, 60) & s.rlike(r"^\p{Lu}") & ~bad & ~(~s.contains(" ") & (low == s))


def looks_like_content(s: Column) -> Column:
    """A line that may follow a header."""
    opener = s.rlike(r"^\p{Ll}") | ((F.length(s) > 60) & s.rlike(r"[.,:;!?]$"))
    for o in rules.CONTENT_OPENERS:
        opener = opener | s.startswith(o)
    return opener


def mark_sections(marked: DataFrame, anchors: DataFrame) -> DataFrame:
    """Lines of sections, with sec_idx, section_title, and h3_idx (0: the section's own body).

    Only what a line's text says of it goes through the windows beside the text itself.
    """
    found = anchors.where("line_no IS NOT NULL")
    w = Window.partitionBy(*CHAPTER).orderBy("line_no")
    numbered = found.select(*CHAPTER, "line_no", F.struct(F.row_number().over(w).alias("n"), "title").alias("start"), match_key(F.col("title")).alias("norm"))
    per_doc = numbered.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("line_no", "start"))).alias("_starts"), F.collect_set(F.struct("chapter_idx", "norm")).alias("_siblings"))
    x = marked.where("chapter_idx > 0").select(*CHAPTER, "line_no", "page_number", "text", "norm", "chapter_number", "chapter_title", strip(F.col("text")).alias("_s")).join(per_doc, "doc_id")
    s = F.col("_s")
    sibling = F.array_contains("_siblings", F.struct("chapter_idx", "norm"))
    head = looks_like_header(s) & (F.col("norm") != match_key(F.col("chapter_title"))) & ~sibling
    cols = [*CHAPTER, "line_no", "page_number", "text", "norm", "chapter_number", "chapter_title"]
    x = x.select(*cols, F.try_element_at("_starts", F.col("line_no")).alias("_start"), F.when(head, s).alias("_head"), F.when(s != "", looks_like_content(s)).alias("_opens"))
    x = x.select(*cols, F.col("_start.n").alias("sec_start"), F.col("_start.title").alias("sec_title"), "_head", "_opens")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("sec_idx", F.count("sec_start").over(so_far)).withColumn("section_title", F.last("sec_title", ignorenulls=True).over(so_far)).where("sec_idx > 0")
    sw = Window.partitionBy(*SECTION).orderBy("line_no")
    x = x.withColumn("_opens", F.first("_opens", ignorenulls=True).over(sw.rowsBetween(1, 3)))
    h3 = F.col("sec_start").isNull() & F.col("_head").isNotNull() & F.coalesce("_opens", F.lit(False))
    x = x.withColumn("is_h3", h3 & F.when(h3, F.col("norm") != match_key(F.col("section_title"))).otherwise(False))
    behind = sw.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("h3_idx", F.count_if("is_h3").over(behind)).withColumn("h3_title", F.last(F.when(F.col("is_h3"), F.col("_head")), ignorenulls=True).over(behind))
    return x.withColumn("s", strip(F.col("text"))).drop("sec_title", "_head", "_opens")


def with_notes(blocks: DataFrame) -> DataFrame:
    """Adds note, at a line "Note": up to three lines before it, else after it; else null.

    A short line without end punctuation, likely a header, ends the note on either side.
    """
    body = F.col("sec_start").isNull() & ~F.col("is_h3") & (strip(F.col("text")) != "")
    w = Window.partitionBy(*BLOCK, "_body").orderBy("line_no")
    usable = lambda c: F.coalesce((F.length(c) >= 30) | c.rlike(r"[.,:;!?]$"), F.lit(False))
    x = blocks.withColumn("_body", body)
    x = x.withColumn("_mark", F.col("_body") & (strip(F.col("text")) == rules.NOTE_WORD))
    near = [f(F.col("text"), i).over(w).alias(f"_{side}{i}") for side, f in (("b", F.lag), ("a", F.lead)) for i in (1, 2, 3)]
    x = x.select("*", *near)

    def run(side: str) -> list[Column]:
        ok, out = F.lit(True), []
        for i in (1, 2, 3):
            c = strip(F.col(f"_{side}{i}"))
            ok = ok & usable(c)
            out.append(F.when(ok, c))
        return out

    before, after = F.concat_ws(" ", *reversed(run("b"))), F.concat_ws(" ", *run("a"))
    note = F.when(F.col("_mark"), F.coalesce(F.nullif(before, F.lit("")), F.nullif(after, F.lit(""))))
    return x.select(*(F.col(c) for c in blocks.columns), note.alias("note"))


def section_notes(blocks: DataFrame) -> DataFrame:
    """(block keys, line_no, note): the notes of :func:`with_notes`."""
    return with_notes(blocks).where("note IS NOT NULL").select(*BLOCK, "line_no", "note")


def section_table(blocks: DataFrame, chapter_rows: DataFrame) -> DataFrame:
    """The sections in order (chapter_idx, pos): a section, then its subsections."""
    title = F.coalesce("h3_title", "section_title")
    own = F.col("norm") == match_key(F.col("chapter_title"))
    x = with_notes(blocks.drop("s")).withColumn("footer", own | (F.col("norm") == match_key(title))).withColumn("h2_footer", own | (F.col("norm") == match_key(F.col("section_title"))))
    inside = F.col("sec_start").isNull() & ~F.col("is_h3") & ~F.col("footer")
    x = x.withColumn("body", F.when(inside, F.col("text"))).withColumn("words", count_words(F.col("text")))
    x = x.withColumn("h3_words", F.when(inside, F.col("words")).otherwise(0))
    x = x.withColumn("h2_words", F.when(F.col("sec_start").isNull() & ~F.col("h2_footer"), F.col("words")).otherwise(0))
    b = x.groupBy(*BLOCK).agg(
        F.first("chapter_number").alias("chapter_number"),
        F.first("chapter_title").alias("chapter_title"),
        F.first("section_title").alias("h2_title"),
        F.first("h3_title").alias("h3_title"),
        strip(F.array_join(_ordered("body"), "\n")).alias("content"),
        _ordered("note").alias("notes"),
        F.sum("h3_words").alias("own_words"),
        F.sum("h2_words").alias("all_words"),
        F.min("page_number").alias("first_page"),
        F.max("page_number").alias("last_page"),
    )
    sec, h2 = Window.partitionBy(*SECTION), F.col("h3_idx") == 0
    order = Window.partitionBy(*CHAPTER).orderBy("sec_idx", "h3_idx")
    b = b.select(
        *CHAPTER,
        (F.row_number().over(order) - 1).cast("long").alias("pos"),
        "chapter_number",
        "chapter_title",
        F.coalesce("h3_title", "h2_title").alias("section_title"),
        F.when(h2, 2).otherwise(3).alias("section_level"),
        F.when(~h2, F.col("h2_title")).alias("parent_section"),
        F.when(h2, F.min("first_page").over(sec)).otherwise(F.col("first_page")).alias("page_start"),
        F.when(h2, F.max("last_page").over(sec)).otherwise(F.col("last_page")).alias("page_end"),
        "content",
        "notes",
        F.when(h2, F.sum("all_words").over(sec)).otherwise(F.col("own_words")).cast("long").alias("word_count"),
        F.when(h2, F.max("h3_idx").over(sec)).otherwise(0).cast("long").alias("h3_count"),
    )
    summaries = chapter_rows.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("chapter_idx", "chapter_summary"))).alias("_summaries"))
    b = b.join(summaries, "doc_id").where(F.map_contains_key("_summaries", F.col("chapter_idx")))
    return b.withColumn("chapter_summary", F.try_element_at("_summaries", F.col("chapter_idx"))).drop("_summaries")


def detection_warnings(chapter_rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, chapter_idx, toc_idx, message) for chapters without contents, and entries
    that weren't found or only by similarity."""
    empty = chapter_rows.where(F.size("expected_sections") == 0).select(*CHAPTER, F.lit(-1).alias("toc_idx"), F.format_string("Chapter %d (%s): no contents entries", "chapter_number", "chapter_title").alias("message"))
    odd = anchors.where("line_no IS NULL OR fuzzy").join(chapter_rows.select(*CHAPTER, "chapter_number"), CHAPTER)
    text = F.when(F.col("line_no").isNull(), F.format_string("Chapter %d: section '%s' not found", "chapter_number", "title"))
    text = text.otherwise(F.format_string("Chapter %d: section '%s' matched by similarity at line %d", "chapter_number", "title", "line_no"))
    return empty.unionByName(odd.select(*CHAPTER, "toc_idx", text.alias("message")))


def detect_sections(lines: DataFrame, fuzzy: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chapters, sections, warnings) of a line table."""
    marked = mark_chapters(lines)
    ch = chapters(marked)
    anchors = section_anchors(marked, ch, fuzzy)
    return ch, section_table(mark_sections(marked, anchors), ch), detection_warnings(ch, anchors)
