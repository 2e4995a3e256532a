"""Sources: page text from files through a decoder plug-in, drafts, and stored sections."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators.pages import resolve_title

#: bytes of a file to (metadata title, text of each page)
Decoder = Callable[[bytes], tuple[str | None, list[str]]]


def decode_pdf(data: bytes) -> tuple[str | None, list[str]]:
    """By pymupdf, where that is installed."""
    import fitz

    with fitz.open(stream=data, filetype="pdf") as doc:
        return (doc.metadata or {}).get("title"), [p.get_text() for p in doc]


def decode_form_feeds(data: bytes) -> tuple[str | None, list[str]]:
    """Plain text whose pages end in form feeds."""
    return None, data.decode("utf-8", "replace").split("\f")


def read_documents(spark: SparkSession, path: str, decoder: Decoder = decode_pdf, glob: str = "*.pdf") -> DataFrame:
    """(doc_id, path, document_title, page_number, text, error) of the files of a folder.

    A file that can't be decoded gives one row with its error, not a failed job.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")

    schema = pa.schema([("path", pa.string()), ("title", pa.string()), ("page_number", pa.int32()), ("text", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b["path"], b["content"], strict=True):  # one file at a time becomes a Python object
                name = path.as_py()
                try:
                    title, pages = decoder(data.as_py())
                    n = len(pages)
                    out = pa.RecordBatch.from_pydict({"path": [name] * n, "title": [title] * n, "page_number": list(range(1, n + 1)), "text": list(pages), "error": [None] * n}, schema=schema)
                except Exception as e:  # any decoder failure belongs to its file
                    out = pa.RecordBatch.from_pydict({"path": [name], "title": [None], "page_number": [0], "text": [None], "error": [f"{type(e).__name__}: {e}"]}, schema=schema)
                yield out

    rows = files.mapInArrow(run, "path string, title string, page_number int, text string, error string")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    return rows.select(F.xxhash64("path").alias("doc_id"), "path", resolve_title(F.col("title"), stem).alias("document_title"), "page_number", "text", "error")


def read_drafts(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """(path, kb, text) of markdown files; order by path for the order of names."""
    df = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return df.select("path", F.element_at(F.split("path", "/"), -1).alias("kb"), "text").where(~F.col("kb").endswith(".verification.md"))


SECTION_JSON = (
    "section_title string, section_level int, parent_section string, page_start bigint, page_end bigint, content string, "
    "notes array<string>, word_count bigint, h3_count bigint"
)
DOCUMENT_JSON = (
    "document_title string, source_pdf string, warnings array<string>, chapters array<struct<number:bigint,title:string,summary:string,"
    "expected_sections:array<string>,page_start:bigint,page_end:bigint,sections:array<struct<"
    + ",".join(":".join(f.split(" ", 1)) for f in SECTION_JSON.split(", "))
    + ">>>>"
)


def read_sections_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(chapters, sections) of stored documents; missing optional fields get their defaults."""
    d = spark.read.schema(DOCUMENT_JSON).json(path, multiLine=True).select(F.xxhash64(F.col("_metadata.file_path")).alias("doc_id"), "document_title", F.posexplode("chapters").alias("i", "c"))
    strings = F.array().cast("array<string>")
    ch = d.select("doc_id", "document_title", (F.col("i") + 1).cast("long").alias("chapter_idx"), F.col("c.number").alias("chapter_number"), F.col("c.title").alias("chapter_title"), F.coalesce("c.summary", F.lit("")).alias("chapter_summary"), F.coalesce("c.expected_sections", strings).alias("expected_sections"), "c.page_start", "c.page_end", F.col("c.sections").alias("_s"))
    s = ch.select("doc_id", "document_title", "chapter_idx", "chapter_number", "chapter_title", "chapter_summary", F.posexplode("_s").alias("pos", "s"))
    s = s.select("doc_id", "document_title", "chapter_idx", F.col("pos").cast("long"), "chapter_number", "chapter_title", "s.section_title", "s.section_level", "s.parent_section", "s.page_start", "s.page_end", F.coalesce("s.content", F.lit("")).alias("content"), F.coalesce("s.notes", strings).alias("notes"), F.coalesce("s.word_count", F.lit(0)).cast("long").alias("word_count"), F.coalesce("s.h3_count", F.lit(0)).cast("long").alias("h3_count"), "chapter_summary")
    return ch.drop("_s"), s
