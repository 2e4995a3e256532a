"""Queries over the driver's tables; ``oracles`` has the SQL for those that SQL can express.

``documents`` has no manuals in it, so structure is tested on books made from it: a book holds a
hundred consecutive documents, a chapter one language, and every document is a section with its
whole text. Titles repeat, some entries of the contents are missing from the text, some
chapters have no contents, headings reach the rules of acceptance, and notes stand on
either side of their mark. All tables are used whole.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.functions import text as T
from quirework.operators import model, pages, responses, sections, stats, subsections, units, verify
from quirework.plans import oracles
from quirework.sources import readers, writers
from quirework.sources.scratch import StageTables, bucket_count, fingerprint, materialize, scratch_dir, spread
from quirework.streaming.arrivals import classify_stream, page_stream
from quirework.streaming.arrivals import event_windows as windows_of

#: Stage tables, shared by the queries of a session as the stages of a run share them.
STAGES = StageTables()

TOPICS = ("Alpha", "Beta", "Gamma", "Delta", "Omega")
HEADINGS = ("Module Details", "N9K-X9432PQ", "GNU GRUB", "Booting From Primary ROM Now", "Related Topic", "If The Link Fails", "Module 3 powered up now")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), f"{sf_dir}/{name}.parquet")


def _pick(choices: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, choices)), at.cast("int"))


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# --- the book -------------------------------------------------------------------------------------


def _book_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, ch, n, k, j, page_number, text): one scan, each document exploded to its lines."""
    n, cat = F.col("n"), F.concat
    num = n.cast("string")
    d = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias("n"), F.floor(F.col("doc_id") / 100).cast("long").alias("doc_id"),
        F.coalesce(F.array_position(F.array(*map(F.lit, ("en", "de", "fr", "es"))), F.col("lang")), F.lit(0)).cast("int").alias("ch"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")).alias("text"),
    ).withColumn("ch", F.when(F.col("ch") == 0, 5).otherwise(F.col("ch")))
    kind = n % 24
    numbered = F.when(kind == 0, "Configuring Unit ").when(kind == 4, "Verifying Unit ").when(kind == 8, "Overview of Unit ").when(kind == 12, "Failure Recovery Unit ").otherwise("Installing Unit ")
    title = F.when(kind.isin(16, 20), "Unit Redundancy").otherwise(cat(numbered, num))
    bare = ~((F.col("ch") == 3) & (F.col("doc_id") % 2 == 1))  # this chapter has contents
    topic = _pick(TOPICS, F.col("ch") - 1)
    five = n % 5 == 0
    page = (n + 3).cast("string")
    entry = F.when(n % 6 == 1, cat(F.lit("•"), title, F.lit(" ,  on  page "), page)).otherwise(cat(F.lit("  • "), title, F.lit(", on page "), page))
    body = [
        F.when(n % 10 == 7, cat(F.lit("Unlisted Part "), num)).when(kind == 8, cat(F.lit("OVERVIEW  of Unit "), num)).otherwise(title),
        F.lit("the section opens here with a plain sentence."),
        F.when(n % 8 == 0, "Note").otherwise("more of it follows below."),
        _pick(HEADINGS, n % 7),
        cat(F.lit("the "), F.col("text")),
        F.when(n % 12 == 0, "Module Details").otherwise("Other Details"),
        F.when(five, "short bit").otherwise("the continuation of the same part."),
        F.when(five, " Note ").otherwise("Standby"),
        F.when(five, "the note follows its mark here, in one line.").otherwise("the short tail."),
        F.when(five, "and it goes on in a second line of it."),
        F.when(five, "stop here"),
        F.when(five, "the rest of it is plain and long enough."),
        F.when(n % 9 == 0, cat(F.lit("Topic  "), F.upper(topic))),
    ]
    line = lambda k, t, at=n, j=0: F.struct(at.alias("n"), F.lit(k).alias("k"), F.lit(j).cast("long").alias("j") if isinstance(j, int) else j.alias("j"), t.alias("text"))
    lines = F.array(*(line(k, t) for k, t in enumerate(body)), line(5, F.when(bare, entry), F.lit(-1).cast("long"), n))
    own = d.select("doc_id", "ch", F.inline(lines))
    head = [(0, cat(F.lit("C H A P T E R "), F.col("ch").cast("string"))), (1, F.when(F.col("ch") % 2 == 0, "")), (2, cat(F.lit("Topic "), topic)), (3, cat(F.lit("intro for topic "), topic, F.lit("."))), (4, F.when(F.col("ch") == 2, " and a second line of it. ")), (6, F.when(bare, ""))]
    heads = d.select("doc_id", "ch").distinct().select("doc_id", "ch", F.inline(F.array(*(line(k, t, F.lit(-1).cast("long")) for k, t in head))))
    both = own.unionByName(heads).where("text IS NOT NULL")
    return both.withColumn("page_number", F.when(n < 0, F.col("doc_id") * 100 + 3).otherwise(n + 3))


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table of all books, dealt out by book: the one exchange of the texts."""
    path = f"{sf_dir}/documents.parquet"
    w = Window.partitionBy("doc_id").orderBy("ch", "n", "k", "j")
    x = _book_lines(spark.read.parquet(path)).repartition(bucket_count(spark, path), "doc_id")
    return x.select("doc_id", (F.row_number().over(w) - 1).cast("long").alias("line_no"), "page_number", "text")


def _stage(spark, sf_dir, name, build, by="") -> DataFrame:
    return STAGES.get(spark, f"{sf_dir}/documents.parquet", name, build, by)


def _marked(spark, sf_dir):
    return _stage(spark, sf_dir, "marked", lambda: sections.mark_chapters(book(spark, sf_dir)), "doc_id")


def _chapters(spark, sf_dir):
    return _stage(spark, sf_dir, "chapters", lambda: sections.chapters(_marked(spark, sf_dir)))


def _anchors(spark, sf_dir):
    return _stage(spark, sf_dir, "anchors", lambda: sections.section_anchors(_marked(spark, sf_dir), _chapters(spark, sf_dir), fuzzy=False))


def _blocks(spark, sf_dir):
    """No table: its columns come from the marked lines and the anchors without an exchange of texts."""
    return sections.mark_sections(_marked(spark, sf_dir), _anchors(spark, sf_dir))


def _sections(spark, sf_dir):
    return _stage(spark, sf_dir, "sections", lambda: sections.section_table(_blocks(spark, sf_dir), _chapters(spark, sf_dir)), "doc_id")


def _merged(spark, sf_dir):
    return _stage(spark, sf_dir, "merged", lambda: subsections.merge_split(_sections(spark, sf_dir)), "doc_id")


def _decided(spark, sf_dir):
    return _stage(spark, sf_dir, "decisions", lambda: subsections.decisions(_merged(spark, sf_dir).drop("n_merged")))


def _kept(spark, sf_dir):
    return _stage(spark, sf_dir, "kept", lambda: subsections.keep_accepted(_merged(spark, sf_dir).drop("n_merged"), _decided(spark, sf_dir)))


def _units(spark, sf_dir):
    return _stage(spark, sf_dir, "units", lambda: units.split_units(_kept(spark, sf_dir)))


def _prompts(spark, sf_dir):
    """Units with their prompts; the texts that went into these are left behind."""
    title = F.concat(F.lit("Book "), F.col("doc_id").cast("string"))
    texts = ("content", "notes", "children", "full_content", "all_notes", "chapter_summary")
    return _stage(spark, sf_dir, "prompts", lambda: units.with_prompts(_units(spark, sf_dir), title).drop(*texts))


def _generated(spark, sf_dir):
    """Results with the length of their prompts, which no later stage reads."""

    def build():
        answered = model.call_model(_prompts(spark, sf_dir), model.StubBackend())
        answered = answered.withColumn("prompt_chars", F.length("user_prompt")).drop("user_prompt")
        return responses.generation_results(materialize(answered, "responses"), "ios-xe")

    return _stage(spark, sf_dir, "generated", build)


def _named(spark, sf_dir):
    """Generation results with the file names of drafts."""
    key = ["doc_id", "chapter_idx", "pos", "sub"]

    def build():
        made = _generated(spark, sf_dir)
        seq = F.format_string("%08d-%08d-%08d", "chapter_idx", "pos", "sub")
        names = responses.unique_names(made.where("decision = 'generate'").select(*key, seq.alias("seq"), "kb_filename"))
        return made.join(names.select(*key, "file_name"), key, "left")

    return _stage(spark, sf_dir, "named", build)


def build_stages(spark: SparkSession, sf_dir: str) -> None:
    """Build all stage tables."""
    for stage in (_named, _book_drafts, _verified):
        stage(spark, sf_dir)


# --- pages ------------------------------------------------------------------------------------------


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page, a hundred to a document; some begin with lines that reach a rule."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    text = F.expr(oracles.PAGE_TEXT.replace("chr(10)", "char(10)"))
    return d.select(F.floor(F.col("doc_id") / 100).cast("long").alias("doc_id"), (F.col("doc_id") + 1).alias("page_number"), text.alias("text"))


def _classified(spark, sf_dir):
    return pages.classify_pages(page_table(spark, sf_dir), F.lit("My Guide"))


def page_boilerplate_reasons(spark, sf_dir):
    hist = pages.reason_histogram(pages.clean_pages(page_table(spark, sf_dir), F.lit("My Guide")), "boilerplate_reason", "page_number")
    return hist.select(F.col("boilerplate_reason").alias("reason"), "n", F.col("first_seen").cast("long").alias("first_seen"))


def page_counts(spark, sf_dir):
    return pages.page_counts(_classified(spark, sf_dir))


def page_clean_lines(spark, sf_dir):
    p = pages.content_pages(pages.clean_pages(page_table(spark, sf_dir), F.lit("My Guide")))
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    return p.select("page_number", F.size(lines).cast("long").alias("n_lines"), T.count_words(F.col("text")).alias("n_words"))


def page_flags(spark, sf_dir):
    p = _classified(spark, sf_dir)
    return p.select("page_number", "is_boilerplate", F.col("boilerplate_reason").alias("reason"), F.col("has_chapter_header").alias("has_chapter"), F.col("has_section_header").alias("has_section"), _md5(F.col("text")).alias("text_md5"))


def header_hints(spark, sf_dir):
    p = _classified(spark, sf_dir).where("has_section_header")
    return p.select("page_number", F.size("detected_headers").cast("long").alias("n_headers"), F.array_join("detected_headers", "|").alias("headers"))


def line_explosion(spark, sf_dir):
    x = sections.explode_lines(pages.clean_pages(page_table(spark, sf_dir), F.lit("My Guide")))
    return x.select("doc_id", "line_no", "page_number", _md5(F.col("text")).alias("text_md5"))


def page_scan(spark, sf_dir):
    """Documents written as files of a hundred pages, found by pattern and decoded again."""
    path = f"{sf_dir}/documents.parquet"
    d = spark.read.parquet(path).where("doc_id IS NOT NULL")
    page = F.struct("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit("\f"), F.lit(" ")).alias("t"))
    name = F.concat(F.lit("book-"), F.floor(F.col("doc_id") / 100).cast("string"))
    # a task's books go to Python together: so many tasks that none holds much
    books = d.select("doc_id", "text", name.alias("name")).repartition(bucket_count(spark, path), "name").groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(page)), lambda p: p["t"]), "\f").alias("content"))
    root = scratch_dir(spark, "files")
    writers.write_files(books.select(F.concat("name", F.lit(".txt")).alias("path"), "content"), root)
    writers.write_files(books.select(F.concat("name", F.lit(".other")).alias("path"), F.lit("not one of them").alias("content")), root)
    found = readers.read_documents(spark, root, readers.decode_form_feeds, "*.txt")
    return found.select("document_title", "page_number", _md5(F.col("text")).alias("text_md5"))


def page_stream_table(spark, sf_dir):
    """The pages as files that arrive one after the other, classified as a stream."""
    source, out, state = (scratch_dir(spark, x) for x in ("arrivals", "classified", "state"))
    page_table(spark, sf_dir).withColumn("page_number", F.col("page_number").cast("int")).write.parquet(source)
    # three batches of many files: a batch of one file would leave all cores but a few idle
    files = sum(path.endswith(".parquet") for path, _, _ in fingerprint(spark, source))
    classify_stream(page_stream(spark, source, files_per_trigger=max(1, -(-files // 3))), out, state, title="My Guide").awaitTermination()
    p = spark.read.parquet(out)
    return p.select(F.col("page_number").cast("long").alias("page_number"), F.col("boilerplate_reason").alias("reason"), _md5(F.col("text")).alias("text_md5"))


def title_resolution(spark, sf_dir):
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    start = F.substring(F.coalesce("text", F.lit("")), 1, 30)
    given = F.when(F.col("doc_id") % 4 == 0, " Untitled ").when(F.col("doc_id") % 4 != 1, start)
    title = pages.resolve_title(given, F.concat(F.lit("file-"), F.col("doc_id").cast("string")))
    return d.where(F.lower(F.trim(start)) != "untitled").select("doc_id", title.alias("title"))


def extraction_reports(spark, sf_dir):
    return writers.extraction_reports(_classified(spark, sf_dir)).select("path", _md5(F.col("content")).alias("content_md5"))


# --- chapters, sections, subsections ------------------------------------------------------------------


def chapter_starts(spark, sf_dir):
    c = _chapters(spark, sf_dir)
    return c.select("doc_id", "chapter_idx", "chapter_number", "chapter_title", "ch_start", "ch_end", "page_start", "page_end")


def chapter_toc(spark, sf_dir):
    c = _chapters(spark, sf_dir)
    return c.select("doc_id", "chapter_number", _md5(F.col("chapter_summary")).alias("summary_md5"), F.size("expected_sections").cast("long").alias("n_expected"), _md5(F.array_join("expected_sections", "|")).alias("titles_md5"))


def section_anchors(spark, sf_dir):
    return _anchors(spark, sf_dir).select("doc_id", "chapter_idx", F.col("toc_idx").cast("long").alias("toc_idx"), "title", "line_no")


def detection_warnings(spark, sf_dir):
    w = sections.detection_warnings(_chapters(spark, sf_dir), _anchors(spark, sf_dir))
    return w.withColumn("toc_idx", F.col("toc_idx").cast("long"))


def fuzzy_sections(spark, sf_dir):
    """Anchors when every title in the text has an extra letter: found by similarity alone."""
    lines = book(spark, sf_dir).withColumn("text", F.regexp_replace("text", "^(Configuring|Verifying|Installing) Unit ", "$1 Units "))
    marked = materialize(sections.mark_chapters(lines), "marked", "doc_id", bucket_count(spark, f"{sf_dir}/documents.parquet"))
    return sections.section_anchors(marked, materialize(sections.chapters(marked), "chapters"), fuzzy=True)


def h3_candidates(spark, sf_dir):
    return _blocks(spark, sf_dir).where("is_h3").select("doc_id", "line_no", "section_title", F.col("s").alias("title"))


SHAPES = ("Plain Header", "lower header", "Ends With Stop.", "Really?", "switch# show", "Switch(config)", "12.4 5", "step one", "Step One", "Example Of", "Procedure", "Table 4", "Tables", "• Point", "- Dash", "Xyz", "Four5", "ALLCAPS", "Word", "Über Den Wolken", "Figure 1 of it", "On page 3 of it", "This section", "This Sections", "Command or Action taken", "A router > prompt")


def h3_shape(spark, sf_dir):
    """The shape of subsection headers, on lines that reach its rules and on the documents' first words."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    own = F.trim(F.substring(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")), 1, 40))
    line = F.array(F.struct((F.col("doc_id") % 26).cast("int").alias("i"), _pick(SHAPES, F.col("doc_id") % 26).alias("s")), F.struct(F.lit(-1).alias("i"), own.alias("s")))
    return d.select("doc_id", F.inline(line)).select("doc_id", "i", sections.looks_like_header(F.col("s")).alias("is_header"))


def section_notes(spark, sf_dir):
    return sections.section_notes(_blocks(spark, sf_dir)).select("doc_id", "line_no", "note")


def section_stats(spark, sf_dir):
    s = _sections(spark, sf_dir)
    return s.select("doc_id", "chapter_idx", "pos", "section_title", F.col("section_level").cast("long").alias("section_level"), "parent_section", "page_start", "page_end", _md5(F.col("content")).alias("content_md5"), "word_count", "h3_count", F.size("notes").cast("long").alias("n_notes"))


def section_counts(spark, sf_dir):
    ch = _chapters(spark, sf_dir)
    return stats.section_counts(ch, _sections(spark, sf_dir), sections.detection_warnings(ch, _anchors(spark, sf_dir)))


def sections_json_round_trip(spark, sf_dir):
    """The nested documents written to files and loaded again."""
    ch = _chapters(spark, sf_dir)
    titles = ch.select("doc_id").distinct().select("doc_id", F.concat(F.lit("Book "), F.col("doc_id").cast("string")).alias("document_title"), F.lit("x.pdf").alias("source"))
    nested = writers.sections_json(ch, _sections(spark, sf_dir), sections.detection_warnings(ch, _anchors(spark, sf_dir)), titles)
    root = scratch_dir(spark, "json")
    writers.write_files(nested.select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), F.col("json").alias("content")), root)
    _, s = readers.read_sections_json(spark, root)
    return s.select("document_title", "chapter_idx", "pos", "section_title", "section_level", "parent_section", "page_start", "page_end", _md5(F.col("content")).alias("content_md5"), _md5(F.array_join("notes", "|")).alias("notes_md5"), "word_count", "h3_count", _md5(F.col("chapter_summary")).alias("summary_md5"))


def h3_merge(spark, sf_dir):
    m = _merged(spark, sf_dir).where("section_level = 3")
    return m.select("doc_id", "chapter_idx", "pos", "parent_section", "section_title", "page_start", "page_end", "word_count", "n_merged", F.size("notes").cast("long").alias("n_notes"), _md5(F.col("content")).alias("content_md5"))


def h3_filter(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "chapter_idx", "pos", "section_title", "accepted", "reason", "word_count")


JUDGED = ("Abc", "To-Do List Of It", "Use of it", "N9K-X9432PQ", "SAL1234AB", "sup-a+", "Manual power-on of Module", 'Service "x y" (PID 12) gone', "2024 Jan 3 10:11:12 switch", "Standby (failed)", "Loader Version", "Loader Version 9", "Related Topic", "12.4 - 5", "Plain Words Here", "Graceful Restartability", "Redundant Line Cards", "Modules", " Verifying It ", "Modular")


def h3_judgements(spark, sf_dir):
    """Every rule of acceptance, on titles that reach it, with no words, one, or the document's."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    third = F.col("doc_id") % 3
    words = F.when(third == 0, T.count_words(F.coalesce("text", F.lit("")))).otherwise(third - 1)
    x = d.select("doc_id", _pick(JUDGED, F.col("doc_id") % 20).alias("section_title"), words.alias("word_count"))
    accepted, reason = subsections.judge(F.col("section_title"), F.col("word_count"))
    return x.select("doc_id", "section_title", accepted.alias("accepted"), reason.alias("reason"))


def h3_reason_histogram(spark, sf_dir):
    """Reasons by falling frequency, ties by first appearance."""
    d = _decided(spark, sf_dir).withColumn("seq", F.struct("doc_id", "chapter_idx", "pos"))
    hist = pages.reason_histogram(d, "reason", "seq")
    place = F.row_number().over(Window.orderBy(F.desc("n"), "first_seen"))  # a row per reason
    return hist.select("reason", "n", place.alias("place"))


def h3_acceptance(spark, sf_dir):
    return subsections.acceptance(_decided(spark, sf_dir))


def kept_sections(spark, sf_dir):
    s = _kept(spark, sf_dir)
    return s.select("doc_id", "chapter_idx", "pos", "section_title", F.col("section_level").cast("long").alias("section_level"), "h3_count", "word_count", _md5(F.col("content")).alias("content_md5"))


def decision_previews(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "chapter_idx", "pos", _md5(F.col("content_preview")).alias("preview_md5"))


def audit_file(spark, sf_dir):
    return writers.audit_file(_decided(spark, sf_dir)).select("path", _md5(F.col("content")).alias("content_md5"))


def section_files(spark, sf_dir):
    return writers.section_files(_sections(spark, sf_dir)).select("path", _md5(F.col("content")).alias("content_md5"))


# --- units, prompts, drafts ---------------------------------------------------------------------------


def generation_units(spark, sf_dir):
    u = units.describe(_units(spark, sf_dir))
    return u.select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "section_title", F.size("children").cast("long").alias("n_children"), "total_words")


def first_units(spark, sf_dir):
    """The limit on units: five of each document."""
    return units.first_units(_units(spark, sf_dir), 5).select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "section_title")


def unit_types(spark, sf_dir):
    return _units(spark, sf_dir).groupBy("suggested_type").agg(F.count(F.lit(1)).alias("n"))


def unit_prompts(spark, sf_dir):
    u = _prompts(spark, sf_dir)
    return u.select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "page_range", F.length("user_prompt").cast("long").alias("prompt_chars"), _md5(F.col("user_prompt")).alias("prompt_md5"))


def skip_advice(spark, sf_dir):
    return units.skip_advice(_units(spark, sf_dir)).select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "skip_advice")


def kb_parse(spark, sf_dir):
    g = _generated(spark, sf_dir)
    return g.select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "decision", "kb_type", "kb_filename", "skip_reason", _md5(F.col("kb_content")).alias("content_md5"), "error_message")


def kb_names(spark, sf_dir):
    return _named(spark, sf_dir).where("decision = 'generate'").select("doc_id", "chapter_idx", "pos", F.col("sub").cast("long").alias("sub"), "file_name")


def name_fold(spark, sf_dir):
    """Names that collide with each other's numbers, given out in order."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    name = _pick(("a", "A.md", "a-2", "a b", "é", "a 2 2"), F.col("doc_id") % 6)
    x = d.select(F.floor(F.col("doc_id") / 100).cast("long").alias("doc_id"), F.col("doc_id").alias("seq"), name.alias("kb_filename"))
    return responses.unique_names(x).select("doc_id", "seq", "file_name")


def draft_exports(spark, sf_dir):
    return writers.draft_files(_named(spark, sf_dir)).select("path", _md5(F.col("content")).alias("content_md5")).distinct()


def debug_exports(spark, sf_dir):
    f = writers.debug_files(_generated(spark, sf_dir))
    field = lambda k: F.get_json_object("content", f"$.{k}")
    return f.select("path", field("prompt_chars").cast("long").alias("prompt_chars"), field("decision").alias("decision"), field("retry_count").cast("int").alias("retry_count"))


def platform_override(spark, sf_dir):
    d = _table(spark, sf_dir, "documents")
    old = F.when(F.col("doc_id") % 2 == 0, "platform: old\n").otherwise("")
    draft = F.concat(F.lit("---\nid: nx-os-unit-"), F.col("doc_id").cast("string"), F.lit("-theory\n"), old, F.lit("---\n"), F.coalesce("text", F.lit("")))
    return d.select("doc_id", _md5(T.override_platform(draft, "ios-xe")).alias("draft_md5"))


def _json(**fields: Column | str) -> Column:
    return F.to_json(F.struct(*((F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items())))


def response_parse(spark, sf_dir):
    """Responses of every shape a generator gives, with the texts of conversations in them."""
    c = _table(spark, sf_dir, "conversations")
    k, t = (F.col("conv_id") + F.col("turn")) % 9, F.coalesce("text", F.lit(""))
    body = F.concat(F.lit("---\nid: x\n---\n"), t)
    good = _json(decision="generate", kb_type="config", kb_filename="f", kb_content=body)
    other = _json(decision="generate", kb_type="novel", kb_filename="f", kb_content=body)
    raw = F.when(k == 0, good).when(k == 1, F.concat(F.lit("```json\n"), other, F.lit("\n```"))).when(k == 2, F.concat(F.lit("Here: "), good, F.lit(" done")))
    raw = raw.when(k == 3, _json(decision="skip", skip_reason=t)).when(k == 4, "no object at all").when(k == 5, "[1, 2]").when(k == 6, '{"decision": "maybe"}')
    raw = raw.when(k == 7, '{"decision": "generate", "kb_filename": "f"}').otherwise(F.concat(F.lit("```\n"), other, F.lit("```  ")))
    x = c.select("conv_id", "turn", F.lit(True).alias("success"), raw.alias("raw_text"), F.lit(None).cast("string").alias("error"), F.lit("theory").alias("suggested_type"))
    r = responses.generation_results(x, "nx-os")
    return r.select("conv_id", "turn", "decision", "kb_type", _md5(F.col("kb_content")).alias("content_md5"), "error_message")


def verdict_parse(spark, sf_dir):
    """Responses of every shape a verifier gives; one call in seven failed."""
    c = _table(spark, sf_dir, "conversations")
    k, t = (F.col("conv_id") + F.col("turn")) % 7, F.coalesce("text", F.lit(""))
    raw = F.when(k == 0, '{"decision": "PASS"}').when(k == 1, F.concat(F.lit('{"decision": "FLAG", "problems": ['), _json(claim=t), F.lit("]}")))
    quoted = F.get_json_object(_json(a=F.to_json(F.array(t))), "$.a")
    raw = raw.when(k == 2, F.concat(F.lit('{"decision": "FLAG", "problems": ['), F.substring(quoted, 2, 2**30).substr(F.lit(1), F.length(quoted) - 2), F.lit(", 7]}")))
    raw = raw.when(k == 3, "{}").when(k == 4, '{"decision": "PASS", "problems": null}').when(k == 5, '{"decision": "PASS", "problems": "x"}')
    failed = k == 6
    none = F.lit(None).cast("string")
    x = c.select("conv_id", "turn", (~failed).alias("success"), raw.alias("raw_text"), F.when(failed, "no such model").alias("error"), none.alias("error_message"))
    r = verify.verification_results(x)
    line = lambda p: F.concat_ws("|", p["category"], p["claim"], p["issue"], p["severity"])
    return r.select("conv_id", "turn", "decision", _md5(F.array_join(F.transform("problems", line), ";")).alias("problems_md5"), "error_message")


class Moody:
    """Answers by the prompt's hash, or fails, always alike for one prompt."""

    def call(self, system: str, user: str) -> str:
        h = int(hashlib.md5(user.encode()).hexdigest()[:8], 16)
        if h % 7:
            return f"answer {h}"
        if h % 2:
            raise TimeoutError("too late")
        return "  "


def model_calls(spark, sf_dir):
    """Four requests at a time, with failures that are tried again; rows keep their keys."""
    c = _table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("user_prompt"))
    r = model.call_model(c, Moody(), "sys", concurrency=4, waits=(0.0, 0.0))
    return r.select("conv_id", "turn", "success", "retry_count", F.coalesce("error", F.lit("")).alias("error"), "raw_text")


def model_payloads(spark, sf_dir):
    """What either kind of server is sent."""
    chat = model.HttpBackend("h", "m", max_tokens=2048)
    plain = model.HttpBackend("h", "n", chat=False)

    @F.pandas_udf("string")
    def payload(turn: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([json.dumps((plain if t % 2 else chat).payload("sys", x)) for t, x in zip(turn, text, strict=True)])

    c = _table(spark, sf_dir, "conversations").select("conv_id", "turn", payload("turn", F.coalesce("text", F.lit(""))).alias("p"))
    field = lambda path: F.get_json_object("p", path)
    either = lambda a, b: F.coalesce(field(a), field(b))
    return c.select(
        "conv_id", "turn", field("$.model").alias("model"), _md5(either("$.prompt", "$.messages[1].content")).alias("prompt_md5"), either("$.max_tokens", "$.options.num_predict").cast("int").alias("budget"),
        field("$.response_format.type").alias("response_format"), either("$.temperature", "$.options.temperature").cast("double").alias("temperature"), either("$.top_p", "$.options.top_p").cast("double").alias("top_p"),
    )


def durations(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select("o_orderkey", T.duration(F.col("o_orderkey")).alias("took"))


# --- verification -----------------------------------------------------------------------------------------


def _book_drafts(spark, sf_dir):
    """A draft per section. Chapters are named by number, by title, within a longer one, or wrongly; ids
    hold the section's title, more than it, too little of it, or nothing."""
    s = _sections(spark, sf_dir)
    pos, slug = F.col("pos"), T.slug(F.col("section_title"))
    chapter = F.when(pos % 11 == 10, "Nowhere").when(pos % 5 == 1, F.col("chapter_title")).when(pos % 5 == 2, F.concat(F.lit("The "), "chapter_title", F.lit(" Guide"))).otherwise(F.concat(F.lit("Chapter "), F.col("chapter_number").cast("string")))
    kb_id = F.when(pos % 7 == 3, F.concat(F.lit("ios-xe-all-about-"), slug)).when(pos % 7 == 4, "unit").when(pos % 7 == 5, "").otherwise(F.concat(F.lit("nx-os-"), slug, F.lit("-theory")))
    span = F.when(pos % 3 == 2, F.array().cast("array<bigint>")).otherwise(F.array("page_end", F.col("page_end") + 1))
    kb = F.concat(F.col("chapter_idx").cast("string"), F.lit("-"), pos.cast("string"))
    return _stage(spark, sf_dir, "bookdrafts", lambda: s.select("doc_id", kb.alias("kb"), kb_id.alias("kb_id"), chapter.alias("chapter"), span.alias("pages")))


def kb_chapter_match(spark, sf_dir):
    return verify.match_chapters(_book_drafts(spark, sf_dir), _chapters(spark, sf_dir)).select("doc_id", "kb", "chapter_idx")


def kb_source_match(spark, sf_dir):
    d = verify.match_chapters(_book_drafts(spark, sf_dir), _chapters(spark, sf_dir))
    return verify.match_sections(d, _sections(spark, sf_dir)).select("doc_id", "kb", "chapter_idx", "pos", "how")


def _prepared(spark, sf_dir):
    def build():
        made = _generated(spark, sf_dir).where("decision = 'generate'")
        number = lambda c: F.col(c).cast("string")
        kind = (F.col("chapter_idx") + F.col("pos") + F.col("sub")) % 13
        chapter = F.when(kind == 7, "Nowhere").otherwise(F.concat(F.lit("Chapter "), number("chapter_number")))
        front = F.concat(F.lit("---\nid: nx-os-"), T.slug(F.col("section_title")), F.lit("\nsource:\n  chapter: "), chapter, F.lit("\n  pages: ["), number("page_start"), F.lit(", "), number("page_end"), F.lit("]\n---\nbody\n"))
        kb = F.concat_ws("-", number("chapter_idx"), number("pos"), F.concat(number("sub"), F.lit(".md")))
        drafts = made.select("doc_id", kb.alias("kb"), F.when(kind == 5, "no front matter here").otherwise(front).alias("text"))
        parsed = materialize(verify.with_front(drafts), "drafts")
        return verify.prepare_parsed(parsed, _chapters(spark, sf_dir), _kept(spark, sf_dir)).drop("source_text")

    return _stage(spark, sf_dir, "prepared", build)


def _verified(spark, sf_dir):
    return _stage(spark, sf_dir, "verified", lambda: verify.verification_results(model.call_model(_prepared(spark, sf_dir), model.StubBackend("verify"))).drop("user_prompt"))


def kb_prepare(spark, sf_dir):
    """Drafts with the prompts of the verifier, or the error that keeps one from it."""
    return _prepared(spark, sf_dir).select("doc_id", "kb", "section_title", "error_message", _md5(F.col("user_prompt")).alias("prompt_md5"))


def knowledge_base(spark, sf_dir):
    """End to end: units to drafts by the stub model, drafts verified by it."""
    v = _verified(spark, sf_dir)
    return v.select("doc_id", "kb", "decision", F.get("problems", F.lit(0))["severity"].alias("severity"), "error_message")


def routed_exports(spark, sf_dir):
    return writers.routed_files(_verified(spark, sf_dir)).select("path", _md5(F.col("content")).alias("content_md5"))


def _label_results(spark, sf_dir):
    """Labels as verdicts: toxic ones flagged with problems of mixed severity, low quality ones passed with a minor one."""
    x = _table(spark, sf_dir, "labels")
    problem = lambda claim, s: F.struct(F.lit("c").alias("category"), F.lit(claim).alias("claim"), F.lit("y").alias("issue"), F.lit(s).alias("severity"))
    kinds = "array<struct<category:string,claim:string,issue:string,severity:string>>"
    toxic = F.when(F.col("doc_id") % 2 == 0, F.array(problem("x1", "minor"), problem("x2", "critical"), problem("x3", "odd"), problem("x4", "major"), problem("x5", "minor")))
    toxic = toxic.otherwise(F.array(problem("x1", "minor"), problem("x2", "critical"), problem("x3", "odd"), problem("x5", "minor")))
    flagged = F.col("toxic") == 1
    decision = F.when(flagged, "FLAG").when(F.col("quality").isNull(), "ERROR").otherwise("PASS")
    problems = F.when(flagged, toxic).when(F.col("quality") == 0, F.array(problem("x", "minor"))).otherwise(F.array().cast(kinds))
    return x.select("doc_id", F.col("doc_id").cast("string").alias("kb"), decision.alias("decision"), problems.alias("problems"), F.when(decision == "ERROR", "no quality").alias("error_message"))


def verification_report(spark, sf_dir):
    return verify.report(_label_results(spark, sf_dir)).select("doc_id", "report")


def verification_routing(spark, sf_dir):
    return verify.routing(_label_results(spark, sf_dir))


def severity_counts(spark, sf_dir):
    return verify.severity_counts(_label_results(spark, sf_dir))


def per_document(spark, sf_dir):
    r = _label_results(spark, sf_dir)
    return stats.per_document(r.withColumn("doc_id", F.floor(F.col("doc_id") / 100).cast("long")))


def front_matter(spark, sf_dir):
    """Front matter, also of shapes that can't be read."""
    d = _table(spark, sf_dir, "documents")
    num, k, t = F.col("doc_id").cast("string"), F.col("doc_id") % 9, F.coalesce("text", F.lit(""))
    good = F.concat(F.lit("---\nid: nx-os-unit-"), num, F.lit('\nsource:\n  chapter: "Chapter '), (F.col("doc_id") % 7).cast("string"), F.lit('"\n  pages: ['), num, F.lit(", "), (F.col("doc_id") + 1).cast("string"), F.lit("]\n---\n"), t)
    draft = F.when(k == 5, F.concat(F.lit("# "), t)).when(k == 6, F.lit("---\nid: x\nno end of it")).when(k == 7, F.concat(F.lit("---\n- a\n- b\n---\n"), t)).when(k == 8, F.concat(F.lit("---\nsource: {pages: 3}\n---\n"), t)).otherwise(good)
    f = d.select("doc_id", verify.parse_front(draft).alias("f"))
    title = T.title_form(T.title_of_id(F.col("f.id")))
    return f.select("doc_id", "f.ok", F.col("f.error").alias("error"), F.coalesce(title, F.lit("")).alias("want"), "f.chapter", F.get("f.pages", F.lit(1)).alias("last_page"), _md5(F.col("f.body")).alias("body_md5"))


def draft_scan(spark, sf_dir):
    """Every fiftieth document as a draft's file, beside reports and other files, found again."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL AND doc_id % 50 = 0")
    num = F.col("doc_id").cast("string")
    text = F.concat(F.lit("---\nid: d"), num, F.lit("\n---\n"), F.coalesce("text", F.lit("")))
    root = scratch_dir(spark, "drafts")
    file = lambda end, content: d.select(F.concat(F.lit("draft-"), num, F.lit(end)).alias("path"), content.alias("content"))
    writers.write_files(file(".md", text).unionByName(file(".verification.md", F.lit("no draft"))).unionByName(file(".txt", F.lit("no draft"))), root)
    return readers.read_drafts(spark, root).select("kb", _md5(F.col("text")).alias("text_md5"))


def unsupported_claims(spark, sf_dir):
    """Drafts that state a number, a command, a model and a strong word more than their text."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    source = F.concat(F.lit("Use 12 of N9K-X9 and run\n show   version \n"), F.col("doc_id").cast("string"))
    text = F.concat(F.lit("It must take 12 of N9K-X9, 77.5 of SUP-A.\n```\nshow version\nshow inventory\n```\n"), F.col("doc_id").cast("string"))
    u = verify.unsupported_tokens(d.select("doc_id", text.alias("text"), source.alias("source_text")))
    return u.select("doc_id", *(F.array_join(f"unsupported_{k}", ",").alias(k) for k in ("numbers", "models", "commands", "words")))


def heading_checks(spark, sf_dir):
    """Required headings that drafts of each class lack."""
    d = _table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.lit("x\n## Syntax\ny\n### Notes")).when(k == 1, F.lit("## Overview \n##  Notes\n## Extra")).otherwise(F.coalesce("text", F.lit("")))
    m = verify.missing_headings(d.select("doc_id", _pick(("config", "theory", "troubleshooting"), k).alias("kb_type"), text.alias("text")))
    return m.select("doc_id", F.array_join("missing_headings", ",").alias("missing"))


# --- statistics ---------------------------------------------------------------------------------------------


def pipeline_stats(spark, sf_dir):
    """Conversation turns as generation results, labels as verifications."""
    turns = _table(spark, sf_dir, "conversations")
    kind = F.when(F.col("role") == "user", "generate").when(F.col("role") == "assistant", "skip").otherwise("error")
    return stats.run_stats(turns.select(kind.alias("decision")), _label_results(spark, sf_dir))


def latencies(spark, sf_dir):
    """Turns as calls that took an eighth of a second a character."""
    c = _table(spark, sf_dir, "conversations")
    return stats.latency(c.select((F.length(F.coalesce("text", F.lit(""))) / 8.0).alias("duration_seconds")), 16.0)


def throughput(spark, sf_dir):
    """Even turns as single calls, odd ones as a batch."""
    c = _table(spark, sf_dir, "conversations").select("turn", T.count_tokens(F.coalesce("text", F.lit(""))).alias("n_tokens"))
    return stats.throughput(c.where("turn % 2 = 0"), c.where("turn % 2 = 1"), 8.0, 4.0)


def event_windows(spark, sf_dir):
    w = windows_of(_table(spark, sf_dir, "events"))
    return w.select(F.col("window.start").cast("string").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


def title_forms(spark, sf_dir):
    """Scalar text functions over the whole texts of conversations."""
    t = F.coalesce("text", F.lit(""))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", _md5(T.slug(t)).alias("slug_md5"), _md5(T.match_form(t)).alias("form_md5"), T.count_words(t).alias("n_words"))


QUERIES = {f.__name__: f for f in (
    page_boilerplate_reasons, page_counts, page_clean_lines, page_flags, header_hints, line_explosion, page_scan, title_resolution, extraction_reports,
    chapter_starts, chapter_toc, section_anchors, detection_warnings, fuzzy_sections, h3_candidates, h3_shape, section_notes, section_stats, section_counts, sections_json_round_trip,
    h3_merge, h3_filter, h3_judgements, h3_reason_histogram, h3_acceptance, kept_sections, decision_previews, audit_file, section_files,
    generation_units, first_units, unit_types, unit_prompts, skip_advice, kb_parse, kb_names, name_fold, draft_exports, debug_exports, platform_override, response_parse, verdict_parse,
    model_calls, model_payloads, durations, kb_chapter_match, kb_source_match, kb_prepare, knowledge_base, routed_exports, verification_report, verification_routing,
    severity_counts, per_document, front_matter, draft_scan, unsupported_claims, heading_checks, pipeline_stats, latencies, throughput, event_windows, title_forms,
)} | {"page_stream": page_stream_table}

SQL = oracles.SQL
