"""Verification: drafts to their source sections, results, routing, reports."""

from __future__ import annotations

import re

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions.text import squeeze, strip, title_form, title_of_id
from quirework.operators.responses import parse_verified
from quirework.sources.scratch import materialize

FRONT = "ok boolean, error string, body string, id string, chapter string, pages array<bigint>, front string"


def load_yaml(text: str) -> object:
    """What yaml.safe_load gives, by libyaml where that is present and the text is plain: it takes a tenth of
    the time. What it refuses is left to the other loader, whose messages are the ones shown."""
    if (fast := getattr(yaml, "CSafeLoader", None)) is not None and re.fullmatch(r"[ -~\n]*", text):
        try:
            return yaml.load(text, fast)
        except yaml.YAMLError:
            pass
    return yaml.safe_load(text)


def read_front(text: str | None) -> dict:
    """Front matter and body of a draft; an error instead of an exception for any bad shape."""
    if text is None or not text.startswith("---"):
        return {"ok": False, "error": "no front matter"}
    m = re.match(r"---\n(.*?)\n---\n(.*)\Z", text, re.DOTALL)
    if not m:
        return {"ok": False, "error": "malformed front matter"}
    try:
        data = load_yaml(m[1])
    except yaml.YAMLError as e:
        return {"ok": False, "error": f"YAML error: {str(e).splitlines()[0]}"}
    if not isinstance(data, dict):
        return {"ok": False, "error": "front matter is not a mapping"}
    source = data.get("source") or {}
    if not isinstance(source, dict):
        return {"ok": False, "error": "source is not a mapping"}
    pages = source.get("pages") or []
    if not isinstance(pages, list) or not all(isinstance(p, int) and not isinstance(p, bool) for p in pages):
        return {"ok": False, "error": "pages is not a list of numbers"}
    text_of = lambda x: "" if x is None else str(x)
    return {"ok": True, "error": None, "body": m[2], "id": text_of(data.get("id")), "chapter": text_of(source.get("chapter")), "pages": pages, "front": m[1]}


def parse_front(text: Column) -> Column:
    names = re.findall(r"(?:^|, )(\w+) ", FRONT)

    @F.pandas_udf(FRONT)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = [read_front(t) for t in texts]
        return pd.DataFrame({n: [r.get(n) for r in rows] for n in names}, dtype="object")

    return parse(text)


def match_chapters(drafts: DataFrame, chapters: DataFrame) -> DataFrame:
    """Drafts (doc_id, kb, kb_id, chapter, pages) with the chapter they name: by its first
    number, else by title, equal or one within the other; null where there is none.

    The title join runs within a document and only for what the number left over.
    """
    d = drafts.withColumn("_n", F.nullif(F.regexp_extract("chapter", r"(\d+)", 1), F.lit("")).cast("long"))
    own = chapters.groupBy("doc_id", F.col("chapter_number").alias("_n")).agg(F.min("chapter_idx").alias("by_number"))
    d = d.join(own, ["doc_id", "_n"], "left")
    rest = d.where("by_number IS NULL AND chapter <> ''").select("doc_id", "kb", title_form(F.col("chapter")).alias("want"))
    t = chapters.select("doc_id", "chapter_idx", title_form(F.col("chapter_title")).alias("have")).where("have <> ''")
    hit = rest.join(t, "doc_id").where(F.col("want").contains(F.col("have")) | F.col("have").contains(F.col("want")))
    by_title = hit.groupBy("doc_id", "kb").agg(F.min("chapter_idx").alias("by_title"))
    return d.join(by_title, ["doc_id", "kb"], "left").withColumn("chapter_idx", F.coalesce("by_number", "by_title")).drop("_n", "by_number", "by_title")


def match_sections(drafts: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, kb, chapter_idx, pos, how) of each draft with a chapter: the first section with the
    id's title; else the first with one title within the other, both of 5 characters at least; else the
    one with the largest page overlap, then the higher level, then the first; without pages the first.

    An equi-join on the title first; only what it leaves over meets the sections of its
    chapter, titles and pages alone, as one array a chapter: no row for each pair, and nothing to sort.
    """
    key = ["doc_id", "kb", "chapter_idx"]
    d = drafts.where("chapter_idx IS NOT NULL").select(*key, "pages", title_form(title_of_id(F.col("kb_id"))).alias("want"))
    s = sections.select("doc_id", "chapter_idx", "pos", "section_level", "page_start", "page_end", title_form(F.col("section_title")).alias("have"))
    titles = s.where("have <> ''").groupBy("doc_id", "chapter_idx", "have").agg(F.min("pos").alias("pos"))
    d = d.join(titles.withColumnRenamed("have", "want"), ["doc_id", "chapter_idx", "want"], "left")
    equal = d.where("pos IS NOT NULL").select(*key, "pos", F.lit("title").alias("how"))
    # few titles are long enough to lie within another, and each counts for its first section
    first = titles.where(F.length("have") >= 5).groupBy("doc_id", "chapter_idx").agg(F.collect_list(F.struct("have", "pos")).alias("titles"))
    places = s.groupBy("doc_id", "chapter_idx").agg(F.collect_list(F.struct("pos", "section_level", "page_start", "page_end")).alias("places"), F.min("pos").alias("first_pos"))
    chapters = places.join(first, ["doc_id", "chapter_idx"], "left")
    left = d.where("pos IS NULL").drop("pos").join(chapters, ["doc_id", "chapter_idx"])
    want, n = F.col("want"), F.size("pages")
    near = F.filter("titles", lambda x: want.contains(x["have"]) | x["have"].contains(want))
    within = F.when(F.length(want) >= 5, F.array_min(F.transform(near, lambda x: x["pos"])))
    left = left.select(*key, "pages", "places", "first_pos", within.alias("within"))
    start, end = F.get("pages", F.lit(0)), F.get("pages", n - 1)

    def order(x: Column) -> Column:
        overlap = F.greatest(F.lit(0), F.least(end, x["page_end"]) - F.greatest(start, x["page_start"]) + 1)
        return F.struct((-overlap).alias("o"), x["section_level"].alias("l"), x["pos"].alias("p"))

    by_pages = F.when(F.col("within").isNull() & (n > 0), F.array_min(F.transform("places", order)))
    rank = F.struct(F.when(F.col("within").isNotNull(), 1).otherwise(2).alias("kind"), by_pages.alias("b"), F.coalesce("within", "first_pos").alias("p"))
    best = left.select(*key, rank.alias("r")).groupBy(*key).agg(F.min("r").alias("r"))  # a row for each draft
    how = F.when(F.col("r.kind") == 1, "title within").otherwise("pages")
    return equal.unionByName(best.select(*key, F.coalesce("r.b.p", "r.p").alias("pos"), how.alias("how")))


def source_text(sections: DataFrame) -> DataFrame:
    """(doc_id, chapter_idx, pos, section_title, source_text): what a draft is held against, a
    section of level 2 with its subsections."""
    child = F.struct("pos", "section_title", "content", "notes")
    kids = sections.where("section_level = 3").groupBy("doc_id", "chapter_idx", F.col("parent_section").alias("section_title")).agg(F.array_sort(F.collect_list(child)).alias("kids"))
    kids = kids.withColumn("section_level", F.lit(2))
    x = sections.join(kids, ["doc_id", "chapter_idx", "section_title", "section_level"], "left")
    x = x.withColumn("kids", F.coalesce("kids", F.array().cast(kids.schema["kids"].dataType)))
    bullets = lambda n, head: F.when(F.size(n) > 0, F.concat(F.lit(head), F.array_join(F.transform(n, lambda t: F.concat(F.lit("\n- "), t)), ""))).otherwise("")
    part = lambda k: F.concat(F.lit("\n\n### Subsection: "), k["section_title"], F.lit("\n\n"), k["content"], bullets(k["notes"], "\nSubsection notes:"))
    text = F.concat(F.lit("Chapter context: "), F.coalesce("chapter_summary", F.lit("")), F.lit("\n\nSection: "), F.col("section_title"), F.lit("\n\nContent:\n"), F.col("content"), F.array_join(F.transform("kids", part), ""), bullets(F.col("notes"), "\nNotes:"))
    return x.select("doc_id", "chapter_idx", "pos", "section_title", text.alias("source_text"))


def verifier_prompt(draft: Column, source: Column) -> Column:
    ask = "\n\n# Task\n\nCheck that the source text supports each claim of the draft: numbers, commands, product names and strong words above all. Answer with one JSON object.\n"
    return F.concat(F.lit("# Draft\n\n```markdown\n"), draft, F.lit("\n```\n\n# Source text\n\n"), source, F.lit(ask))


def with_front(drafts: DataFrame) -> DataFrame:
    """Drafts with the fields of their front matter, each parsed once where the result is written."""
    d = drafts.withColumn("f", parse_front("text"))
    return d.select("doc_id", "kb", "text", "f.ok", "f.error", F.coalesce("f.id", F.lit("")).alias("kb_id"), F.coalesce("f.chapter", F.lit("")).alias("chapter"), "f.pages")


def prepare(drafts: DataFrame, chapters: DataFrame, sections: DataFrame) -> DataFrame:
    """Drafts (doc_id, kb, text) with user_prompt, or with error_message and a null prompt, so
    that they bypass the model; no row is lost."""
    return prepare_parsed(materialize(with_front(drafts), "drafts"), chapters, sections)


def prepare_parsed(d: DataFrame, chapters: DataFrame, sections: DataFrame) -> DataFrame:
    """As :func:`prepare`, for the stored result of :func:`with_front`, which is read more than once."""
    short = d.where("ok").select("doc_id", "kb", "kb_id", "chapter", "pages")
    matched = match_sections(match_chapters(short, chapters), sections)
    d = d.join(matched.select("doc_id", "kb", "chapter_idx", "pos"), ["doc_id", "kb"], "left").join(source_text(sections), ["doc_id", "chapter_idx", "pos"], "left")
    where = F.concat(F.lit("Could not find source section for chapter="), F.col("chapter"), F.lit(", pages="), F.coalesce(F.to_json("pages"), F.lit("[]")))
    d = d.withColumn("error_message", F.when(~F.col("ok"), F.concat(F.lit("Frontmatter parse error: "), F.col("error"))).when(F.col("source_text").isNull(), where))
    prompt = F.when(F.col("error_message").isNull(), verifier_prompt(F.col("text"), F.col("source_text")))
    return d.select("doc_id", "kb", "text", "section_title", "source_text", "error_message", prompt.alias("user_prompt"))


def verification_results(responses: DataFrame) -> DataFrame:
    """Decision PASS, FLAG or ERROR with problems, for prepared drafts with response fields."""
    r = responses.withColumn("p", parse_verified(F.when(F.col("success"), F.col("raw_text"))))
    error = F.coalesce("error_message", F.when(~F.coalesce("success", F.lit(False)), F.coalesce("error", F.lit("no response"))), F.when(~F.col("p.ok"), F.concat(F.lit("Parse error: "), F.col("p.error"))))
    r = r.withColumn("error_message", error)
    r = r.withColumn("decision", F.when(F.col("error_message").isNotNull(), "ERROR").otherwise(F.col("p.decision")))
    none = F.array().cast("array<struct<category:string,claim:string,issue:string,severity:string>>")
    return r.withColumn("problems", F.when(F.col("decision") == "ERROR", none).otherwise(F.col("p.problems"))).drop("p", "error")


def target(decision: Column) -> Column:
    return F.when(decision == "PASS", "auto-approved").when(decision == "FLAG", "needs-review").otherwise("verification-errors")


def routing(results: DataFrame) -> DataFrame:
    """(target, n), one row per target that occurs."""
    return results.groupBy(target(F.col("decision")).alias("target")).agg(F.count(F.lit(1)).alias("n"))


def severity_counts(results: DataFrame) -> DataFrame:
    """(severity, n) over the problems; severities outside of the three are in none."""
    p = results.select(F.explode("problems").alias("p"))
    return p.where(F.col("p.severity").isin(*rules.SEVERITIES)).groupBy(F.col("p.severity").alias("severity")).agg(F.count(F.lit(1)).alias("n"))


def report(results: DataFrame) -> DataFrame:
    """(doc_id, kb, report): the text beside a draft; problems by falling severity."""
    rank = lambda p: F.when(p["severity"] == "critical", 0).when(p["severity"] == "major", 1).when(p["severity"] == "minor", 2)
    known = F.filter("problems", lambda p: rank(p).isNotNull())
    listed = F.array_sort(F.transform(known, lambda p, i: F.struct(rank(p).alias("r"), i.alias("i"), p.alias("p"))))
    line = lambda x: F.concat(F.lit("- ["), x["p"]["severity"], F.lit("] "), x["p"]["category"], F.lit(": "), x["p"]["claim"], F.lit(" - "), x["p"]["issue"])
    body = F.when(F.col("decision") == "ERROR", F.concat(F.lit("Error: "), F.col("error_message"))).otherwise(F.array_join(F.transform(listed, line), "\n"))
    return results.select("doc_id", "kb", F.concat_ws("\n", F.concat(F.lit("Decision: "), F.col("decision")), F.nullif(body, F.lit(""))).alias("report"))


def unsupported_tokens(drafts: DataFrame) -> DataFrame:
    """An extension, not parity: what of a draft's text its source text lacks, of the kinds a verifier must
    look at: numbers, commands (lines of fenced blocks), models and strong words, each a sorted array."""
    found = lambda c, p, g=0: F.array_distinct(F.regexp_extract_all(c, F.lit(p), F.lit(g)))
    text, source = F.col("text"), F.coalesce("source_text", F.lit(""))
    less = lambda p: F.array_sort(F.array_except(found(text, p), found(source, p)))
    blocks = F.array_join(F.regexp_extract_all(text, F.lit(r"(?s)```[^\n]*\n(.*?)```"), F.lit(1)), "\n")
    commands = F.array_distinct(F.filter(F.transform(F.split(blocks, "\n"), squeeze), lambda x: x != ""))
    plain = squeeze(source)
    strong = rf"\b(?:{'|'.join(rules.STRONG_WORDS)})\b"
    low = lambda c: found(F.lower(c), strong)
    out = drafts.withColumn("unsupported_numbers", less(r"\b\d+(?:\.\d+)*\b")).withColumn("unsupported_models", less(r"\b[A-Z]+\d*[A-Z]*-[A-Z0-9]+(?:-[A-Z0-9]+)*\b"))
    out = out.withColumn("unsupported_commands", F.array_sort(F.filter(commands, lambda x: ~plain.contains(x))))
    return out.withColumn("unsupported_words", F.array_sort(F.array_except(low(text), low(source))))


def missing_headings(drafts: DataFrame) -> DataFrame:
    """An extension, not parity: adds missing_headings, those that drafts (text, kb_type) of their class must have and lack."""
    wanted = F.lit(None).cast("array<string>")
    for kind, heads in rules.REQUIRED_HEADINGS.items():
        wanted = F.when(F.col("kb_type") == kind, F.array(*map(F.lit, heads))).otherwise(wanted)
    has = F.transform(F.regexp_extract_all("text", F.lit(r"(?md)^##[ \t]+(.+)$"), F.lit(1)), strip)
    return drafts.withColumn("missing_headings", F.array_except(wanted, has))


def first_drafts(drafts: DataFrame, n: int) -> DataFrame:
    """The first n drafts of each document by name; all where n is 0."""
    if not n:
        return drafts
    w = Window.partitionBy("doc_id").orderBy("kb")
    return drafts.withColumn("_row", F.row_number().over(w)).where(F.col("_row") <= n).drop("_row")


def group_heads(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds is_head: the row differs from the one before it in ``group``, as for headings."""
    w = Window.partitionBy("doc_id").orderBy(*order)
    changed = F.lit(False)
    for g in group:
        changed = changed | ~F.lag(g).over(w).eqNullSafe(F.col(g))
    return df.withColumn("is_head", changed | (F.row_number().over(w) == 1))
