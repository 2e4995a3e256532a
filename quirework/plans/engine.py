"""The stages as jobs over all documents at once, and a command line.

Each stage reads the tables of the one before it and writes its own, so a run can go on from
any of them: extract, detect-sections, generate-kbs, verify-kbs. The command line also writes
what a reader wants as files, below ``files`` of the root: reports, nested documents, sections,
the filter's audit, drafts, records of calls, and routed drafts with their reports.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions.prompts import system_prompt
from quirework.operators import model, pages, responses, sections, stats, subsections, units, verify
from quirework.sources import readers, writers
from quirework.sources.scratch import drop_scratch

KEY = ["doc_id", "chapter_idx", "pos", "sub"]


class Engine:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = f"{self.root}/files"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        writers.write_table(df, f"{self.root}/{name}", by)
        return self.table(name)

    def extract(self, source: DataFrame) -> DataFrame:
        """``source``: doc_id, page_number, text, and document_title, path and error where they are known.

        Documents that couldn't be decoded are kept as failures and left out of the stages.
        """
        for name in ("document_title", "path", "error"):
            if name not in source.columns:
                source = source.withColumn(name, F.lit(None).cast("string"))
        source = self.keep(source, "source")
        self.keep(source.where("error IS NOT NULL").select("doc_id", "path", "error"), "failures")
        good = source.where("error IS NULL")
        titles = good.groupBy("doc_id").agg(F.coalesce(F.first("document_title", ignorenulls=True), F.lit("")).alias("document_title"), F.first("path", ignorenulls=True).alias("path"))
        self.keep(titles.withColumn("source", F.element_at(F.split("path", "/"), -1)), "documents")
        return self.keep(pages.classify_pages(good.drop("error", "path"), F.col("document_title")), "pages")

    def detect(self, skip_filter: bool = False, fuzzy: bool = True) -> DataFrame:
        lines = self.keep(sections.explode_lines(self.table("pages")), "lines")
        marked = self.keep(sections.mark_chapters(lines), "marked")
        ch = self.keep(sections.chapters(marked), "chapters")
        anchors = self.keep(sections.section_anchors(marked, ch, fuzzy), "anchors")
        found = sections.section_table(sections.mark_sections(marked, anchors), ch)
        self.keep(sections.detection_warnings(ch, anchors), "warnings")
        if skip_filter:
            return self.keep(found, "sections")
        raw = self.keep(found, "sections_raw")
        merged = self.keep(subsections.merge_split(raw), "sections_merged").drop("n_merged")
        decided = self.keep(subsections.decisions(merged), "decisions")
        return self.keep(subsections.keep_accepted(merged, decided), "sections")

    def generate(self, backend=None, limit: int = 0, platform: str | None = None, concurrency: int = 1, system: str | None = None, partitions: int | None = None) -> DataFrame:
        """``limit``: the units taken of each document, 0 for all. ``system``: the system prompt, if not the own one."""
        u = units.first_units(units.split_units(self.table("sections")), limit)
        u = u.join(self.table("documents").select("doc_id", "document_title"), "doc_id", "left")
        title = F.coalesce("document_title", F.lit(""))
        asked = self.keep(units.skip_advice(units.with_prompts(u, title)), "units")
        answers = model.call_model(asked, backend or model.StubBackend(), system_prompt("generate") if system is None else system, concurrency=concurrency, partitions=partitions)
        made = responses.generation_results(self.keep(answers, "responses"), platform)
        order = F.format_string("%08d-%08d-%08d", "chapter_idx", "pos", "sub")
        named = responses.unique_names(made.where("decision = 'generate'").select(*KEY, "kb_filename", order.alias("seq")))
        out = made.join(named.select(*KEY, "file_name"), KEY, "left")
        checked = verify.missing_headings(out.withColumn("text", F.coalesce("kb_content", F.lit("")))).drop("text")
        return self.keep(checked, "generated")

    def verify(self, backend=None, limit: int = 0, concurrency: int = 1, system: str | None = None, partitions: int | None = None) -> DataFrame:
        made = self.table("generated").where("decision = 'generate'")
        drafts = verify.first_drafts(made.select("doc_id", F.concat("file_name", F.lit(".md")).alias("kb"), F.col("kb_content").alias("text")), limit)
        ready = self.keep(verify.prepare(drafts, self.table("chapters"), self.table("sections")), "prepared")
        answered = model.call_model(ready, backend or model.StubBackend("verify"), system_prompt("verify") if system is None else system, concurrency=concurrency, partitions=partitions)
        done = verify.unsupported_tokens(verify.verification_results(answered)).drop("source_text")
        return self.keep(done, "verified")

    def summary(self) -> DataFrame:
        return stats.run_stats(self.table("generated"), self.table("verified"))

    # --- files ---------------------------------------------------------------------------------------

    def export_extraction(self) -> int:
        return writers.write_files(writers.extraction_reports(self.table("pages")), self.files)

    def export_sections(self, filtered: bool = True) -> int:
        """The nested documents, a file per section, and the filter's audit; earlier section files go."""
        ch, sec = self.table("chapters"), self.table("sections")
        ids = ch.select(F.concat(F.col("doc_id").cast("string"), F.lit("/sections")).alias("path")).distinct()
        writers.remove_files(ids, self.files)
        nested = writers.sections_json(ch, sec, self.table("warnings"), self.table("documents"))
        out = nested.select(F.concat(F.col("doc_id").cast("string"), F.lit("/sections.json")).alias("path"), F.col("json").alias("content"))
        out = out.unionByName(writers.section_files(sec))
        if filtered:
            out = out.unionByName(writers.audit_file(self.table("decisions")))
        return writers.write_files(out, self.files)

    def export_generation(self) -> int:
        made = self.table("generated")
        return writers.write_files(writers.draft_files(made).unionByName(writers.debug_files(made)), self.files)

    def export_verification(self) -> int:
        return writers.write_files(writers.routed_files(self.table("verified")), self.files)


def _backend(role: str, name: str):
    """The backend of the settings; a server that doesn't answer or serve the model ends the run."""
    found = model.backend_from_env(role, name)
    if isinstance(found, model.HttpBackend):
        ok, why = found.available()
        if not ok:
            raise SystemExit(f"model not available: {why}")
    return found


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quirework")
    p.add_argument("--root", required=True, help="folder of the stage tables and files")
    sub = p.add_subparsers(dest="command", required=True)
    x = sub.add_parser("extract")
    x.add_argument("source")
    x.add_argument("--glob", default="*.pdf")
    x = sub.add_parser("detect-sections")
    x.add_argument("--skip-filter", action="store_true", help="neither merge nor filter subsections")
    for name in ("generate-kbs", "verify-kbs", "run-all"):
        x = sub.add_parser(name)
        x.add_argument("--model", default="")
        x.add_argument("--limit", type=int, default=0, help="units or drafts of each document; 0: all")
        x.add_argument("--partitions", type=int, help="how many partitions ask the server at once")
        x.add_argument("--system-prompt", help="a file in place of the own system prompt")
        if name != "verify-kbs":
            x.add_argument("--platform-override", default=os.environ.get("PLATFORM_OVERRIDE"))
        if name == "run-all":
            x.add_argument("source")
            x.add_argument("--glob", default="*.pdf")
            x.add_argument("--stage", default=os.environ.get("STAGE", "ABC"), help="which of A (extract, detect), B (generate), C (verify)")
            x.add_argument("--skip-clean", action="store_true", default=os.environ.get("SKIP_CLEAN", "0") == "1", help="keep the files of an earlier run of all stages")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("quirework").getOrCreate()
    e, began = Engine(spark, a.root), time.monotonic()
    stage = getattr(a, "stage", "")
    runs = lambda command, letter: a.command == command or letter in stage
    generator = _backend("generate", a.model) if runs("generate-kbs", "B") else None
    verifier = _backend("verify", a.model) if runs("verify-kbs", "C") else None
    asks = {"limit": a.limit, "concurrency": model.concurrency_from_env(), "partitions": a.partitions} if generator or verifier else {}
    prompt = lambda role: system_prompt(role, a.system_prompt if a.command != "run-all" else None)
    if a.command == "run-all" and set("ABC") <= set(stage) and not a.skip_clean:
        writers.remove_tree(e.files)
    if runs("extract", "A"):
        decoder = readers.decode_pdf if a.glob.endswith("pdf") else readers.decode_form_feeds
        found = e.extract(readers.read_documents(spark, a.source, decoder, a.glob))
        e.export_extraction()
        pages.page_counts(found).show()
        failed = e.table("failures")
        print(f"documents that could not be read: {failed.count()}")
        failed.select("path", "error").show(100, truncate=False)
    if runs("detect-sections", "A"):
        skip = getattr(a, "skip_filter", False)
        e.detect(skip)
        e.export_sections(filtered=not skip)
        stats.section_counts(e.table("chapters"), e.table("sections"), e.table("warnings")).show()
        if not skip:
            subsections.acceptance(e.table("decisions")).show()
    if generator is not None:
        start = time.monotonic()
        made = e.generate(generator, platform=a.platform_override, system=prompt("generate"), **asks)
        e.export_generation()
        stats.decision_counts(made).show()
        stats.latency(made, time.monotonic() - start).show()
    if verifier is not None:
        start = time.monotonic()
        done = e.verify(verifier, system=prompt("verify"), **asks)
        e.export_verification()
        verify.routing(done).show()
        verify.severity_counts(done).show()
        stats.latency(done, time.monotonic() - start).show()
    if verifier is not None:
        e.summary().show()
        stats.per_document(e.table("verified")).show()
    spent = spark.range(1).select(F.lit(int(time.monotonic() - began)).alias("s"))
    print("took", spent.select(stats.took(F.col("s"))).first()[0])
    drop_scratch(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
