"""Sinks: tables as Parquet, and named text files as an export of (path, content) rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.text import slug
from quirework.operators.verify import group_heads, report, target


def write_files(files: DataFrame, root: str) -> int:
    """Write (path, content) rows below ``root`` from the executors; returns how many.

    Any store pyarrow opens by URI. A file is written whole and again by a task that is run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath

        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(root)
        n = 0
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):  # one text at a time becomes a Python object
                full = f"{base}/{path.as_py()}"
                fs.create_dir(posixpath.dirname(full), recursive=True)
                with fs.open_output_stream(full) as out:
                    out.write((content.as_py() or "").encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return files.select("path", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def remove_tree(root: str) -> None:
    """Delete a folder of files, if it is there."""
    from pyarrow.fs import FileSystem, FileType

    fs, base = FileSystem.from_uri(root)
    if fs.get_file_info(base).type == FileType.Directory:
        fs.delete_dir(base)


def remove_files(folders: DataFrame, root: str) -> int:
    """Delete the folders (path) below ``root`` that are there, from the executors; returns how many."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem, FileType

        fs, base = FileSystem.from_uri(root)
        n = 0
        for f in frames:
            for path in f["path"]:
                if fs.get_file_info(f"{base}/{path}").type == FileType.Directory:
                    fs.delete_dir(f"{base}/{path}")
                    n += 1
        yield pd.DataFrame({"n": [n]})

    return folders.select("path").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def extraction_reports(pages: DataFrame) -> DataFrame:
    """Per document: the content with page banners, the pages left out with reasons, a summary."""
    banner = F.concat(F.lit("===== PAGE "), F.col("page_number").cast("string"), F.lit(" ====="))
    head = F.when(F.col("has_chapter_header"), F.lit(" [CHAPTER START]")).otherwise("")
    text = F.concat(banner, F.when(F.col("is_boilerplate"), F.concat(F.lit(" "), F.col("boilerplate_reason"))).otherwise(head), F.lit("\n"), F.col("text"), F.lit("\n"))
    part = F.struct("page_number", text.alias("t"))
    listed = lambda test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, part))), lambda x: x["t"]), "\n")
    n = lambda test: F.count_if(test).cast("string")
    b = F.col("is_boilerplate")
    summary = F.concat(F.lit("pages: "), F.count(F.lit(1)).cast("string"), F.lit("\ncontent: "), n(~b), F.lit("\nboilerplate: "), n(b), F.lit("\n"))
    d = pages.groupBy("doc_id").agg(summary.alias("extraction"), listed(~b).alias("content"), listed(b).alias("boilerplate"))
    names = F.explode(F.array(*(F.struct(F.lit(x).alias("name"), F.col(x).alias("content")) for x in ("extraction", "content", "boilerplate"))))
    return d.select("doc_id", names.alias("f")).select(F.concat(F.col("doc_id").cast("string"), F.lit("/"), F.col("f.name"), F.lit(".txt")).alias("path"), "f.content")


def sections_json(chapters: DataFrame, sections: DataFrame, warnings: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """(doc_id, json): the nested document; characters stay as they are. ``titles``: (doc_id,
    document_title, source) of the documents, source being the name of the file they come from."""
    fields = ("section_title", "section_level", "parent_section", "page_start", "page_end", "content", "notes", "word_count", "h3_count")
    # documents meet by doc_id alone, so that sections dealt out by it stay where they are
    s = sections.where("chapter_idx IS NOT NULL").groupBy("doc_id", "chapter_idx").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("s")))).alias("l"))
    s = s.select("doc_id", F.struct("chapter_idx", F.transform("l", lambda x: x["s"]).alias("s")).alias("e")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list("e")).alias("_sections"))
    row = F.struct("chapter_idx", F.col("chapter_number").alias("number"), F.col("chapter_title").alias("title"), F.col("chapter_summary").alias("summary"), "expected_sections", "page_start", "page_end")
    c = chapters.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chapter_idx", row.alias("c")))).alias("_chapters"))
    none = F.array().cast(s.schema["_sections"].dataType.valueType)
    names = ("number", "title", "summary", "expected_sections", "page_start", "page_end")
    full = lambda x: F.struct(*(x["c"][n].alias(n) for n in names), F.coalesce(F.try_element_at("_sections", x["c"]["chapter_idx"]), none).alias("sections"))
    d = c.join(s, "doc_id", "left").select("doc_id", F.transform("_chapters", full).alias("chapters"))
    w = warnings.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chapter_idx", "toc_idx", "message"))), lambda x: x["message"]).alias("warnings"))
    d = d.join(w, "doc_id", "left").withColumn("warnings", F.coalesce("warnings", F.array().cast("array<string>")))
    if titles is None:
        d = d.withColumn("document_title", F.lit("")).withColumn("source", F.lit(""))
    else:
        d = d.join(titles.select("doc_id", "document_title", "source"), "doc_id", "left")
    return d.select("doc_id", F.to_json(F.struct("document_title", F.col("source").alias("source_pdf"), "chapters", "warnings")).alias("json"))


def section_files(sections: DataFrame) -> DataFrame:
    """(path, content): a markdown file per section, numbered within its chapter."""
    n = F.row_number().over(Window.partitionBy("doc_id", "chapter_idx").orderBy("pos"))
    name = F.concat(F.lpad(n.cast("string"), F.greatest(F.length(n.cast("string")), F.lit(2)), F.lit("0")), F.lit("-"), F.when(F.col("section_level") == 3, "h3-").otherwise(""), slug(F.col("section_title")), F.lit(".md"))
    folder = F.concat(F.col("doc_id").cast("string"), F.lit("/sections/chapter-"), F.col("chapter_number").cast("string"), F.lit("-"), slug(F.col("chapter_title")), F.lit("/"))
    notes = F.when(F.size("notes") > 0, F.concat(F.lit("\n## Notes\n\n- "), F.array_join("notes", "\n- "), F.lit("\n"))).otherwise("")
    body = F.coalesce(F.nullif("content", F.lit("")), F.lit("(no content)"))
    intro = F.coalesce(F.nullif("chapter_summary", F.lit("")), F.lit("(no introduction)"))
    text = F.concat(F.lit("# "), F.col("section_title"), F.lit("\n\n> "), intro, F.lit("\n\n"), body, F.lit("\n"), notes)
    return sections.select(F.concat(folder, name).alias("path"), text.alias("content"))


def audit_file(decisions: DataFrame) -> DataFrame:
    """(path, content) per document: totals, the reasons of rejection by frequency, and the
    decisions by verdict, the rejected first, with a heading where the chapter or parent
    changes. Lines are built per row and joined in order."""
    d = group_heads(decisions, ["accepted", "chapter_number", "parent_section"], ["accepted", "chapter_number", "parent_section", "section_title", "pos"])
    head = F.when(F.col("is_head"), F.concat(F.when(F.col("accepted"), "\nACCEPTED ").otherwise("\nREJECTED "), F.lit("chapter "), F.col("chapter_number").cast("string"), F.lit(" / "), F.col("parent_section"), F.lit("\n"))).otherwise("")
    line = F.concat(head, F.lit("  - "), F.col("section_title"), F.lit(": "), F.col("reason"))
    order = F.struct("accepted", "chapter_number", "parent_section", "section_title", "pos", line.alias("t"))
    joined = lambda rows: F.array_join(F.transform(F.array_sort(F.collect_list(rows)), lambda x: x["t"]), "\n")
    g = d.groupBy("doc_id").agg(joined(order).alias("content"), F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("a"))
    why = decisions.where("NOT accepted").groupBy("doc_id", "reason").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("chapter_idx", "pos")).alias("first"))
    text = F.concat(F.lit("  "), F.col("n").cast("string"), F.lit("  "), F.col("reason"))
    why = why.groupBy("doc_id").agg(joined(F.struct((-F.col("n")).alias("o"), "first", text.alias("t"))).alias("reasons"))
    share = lambda n: n * 100.0 / F.col("n")
    no = F.col("n") - F.col("a")
    total = F.format_string("subsections: %d\naccepted: %d (%.1f%%)\nrejected: %d (%.1f%%)\n", "n", "a", share(F.col("a")), no, share(no))
    reasons = F.when(F.col("reasons").isNotNull(), F.concat(F.lit("\nReasons of rejection:\n"), F.col("reasons"), F.lit("\n"))).otherwise("")
    return g.join(why, "doc_id", "left").select(F.concat(F.col("doc_id").cast("string"), F.lit("/rejected-h3s.txt")).alias("path"), F.concat(total, reasons, F.col("content")).alias("content"))


def draft_files(results: DataFrame) -> DataFrame:
    """(path, content) of generation results with file_name: drafts, skips and errors. Skips
    of one section slug share a path."""
    base = F.concat(F.col("doc_id").cast("string"), F.lit("/kb-drafts/"))
    own = slug(F.col("section_title"))
    made, skip = F.col("decision") == "generate", F.col("decision") == "skip"
    path = F.when(made, F.concat(F.lit("unverified/"), F.col("file_name"), F.lit(".md"))).when(skip, F.concat(F.lit("skipped/"), own, F.lit(".md"))).otherwise(F.concat(F.lit("errors/"), own, F.lit(".md")))
    failed = F.concat(F.lit("# "), F.col("section_title"), F.lit("\n\n"), F.coalesce("error_message", F.lit("")), F.lit("\n\n"), F.coalesce(F.substring("raw_text", 1, 2000), F.lit("")))
    text = F.when(made, F.col("kb_content")).when(skip, F.concat(F.lit("# "), F.col("section_title"), F.lit("\n\n"), F.coalesce("skip_reason", F.lit("")))).otherwise(failed)
    return results.select(F.concat(base, path).alias("path"), text.alias("content"))


def debug_files(results: DataFrame) -> DataFrame:
    """(path, content): lengths and a preview of each call, as JSON. prompt_chars, if there is such a column,
    stands for the prompts."""
    chars = F.col("prompt_chars") if "prompt_chars" in results.columns else F.length("user_prompt")
    row = F.struct("section_title", "decision", chars.alias("prompt_chars"), F.length("raw_text").alias("response_chars"), F.substring("raw_text", 1, 500).alias("preview"), "duration_seconds", "retry_count")
    name = F.concat(F.col("doc_id").cast("string"), F.lit("/debug/llm-calls/"), F.format_string("%d-%d-%d", "chapter_idx", "pos", "sub"), F.lit(".json"))
    return results.select(name.alias("path"), F.to_json(row).alias("content"))


def routed_files(results: DataFrame) -> DataFrame:
    """(path, content): each draft below its target, with its report beside it."""
    base = F.concat(F.col("doc_id").cast("string"), F.lit("/kb-drafts/"), target(F.col("decision")), F.lit("/"))
    drafts = results.select(F.concat(base, F.col("kb")).alias("path"), F.col("text").alias("content"))
    beside = results.select("doc_id", "kb", base.alias("base")).join(report(results), ["doc_id", "kb"])
    side = F.concat("base", F.regexp_replace("kb", r"\.md$", ""), F.lit(".verification.md"))
    return drafts.unionByName(beside.select(side.alias("path"), F.col("report").alias("content")))


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """A stage's table, replaced as a whole."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)
