import json
import os

import pytest
from pyspark.sql import functions as F

from quirework.functions import prompts, rules
from quirework.operators import model, pages, stats
from quirework.plans.engine import Engine, main
from quirework.sources import readers, scratch, writers
from quirework.streaming.arrivals import classify_stream, event_windows, page_stream

PAD = "\n".join(f"this is line {i} of a page with enough of plain text to be content." for i in range(6))


def manual():
    toc = "• Configuring Alpha, on page 4\n• Overview of Beta, on page 5"
    chapter = f"C H A P T E R 1\nThe Topic\nintro of the chapter goes here.\n{toc}\nConfiguring Alpha\nthe alpha text.\nModule Details\nthe details follow here.\n{PAD}"
    return ["cover", "legal", chapter, f"Overview of Beta\nthe beta text.\n{PAD}", "CONTENTS\n" + PAD]


def test_run_from_files_to_routed_drafts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "guide.txt").write_text("\f".join(manual()))
    (src / "broken.bin").write_bytes(b"\xff")
    root = f"file://{tmp_path}/out"
    assert main(["--root", root, "run-all", f"file://{src}", "--glob", "*.txt", "--platform-override", "ios-xe"]) == 0
    e = Engine(spark, root)
    assert e.table("pages").where("is_boilerplate").count() == 3
    assert [r.section_title for r in e.table("sections").orderBy("pos").collect()] == ["Configuring Alpha", "Module Details", "Overview of Beta"]
    made = e.table("generated")
    assert made.count() == 2 and set(made.columns) >= {"kb_type", "file_name", "kb_content", "error_message"}
    assert e.table("verified").count() == made.where("decision = 'generate'").count()
    row = e.summary().first()
    assert row.n_generate + row.n_skip + row.n_error == 2
    assert writers.write_files(writers.debug_files(made), f"{tmp_path}/files") == 2
    assert json.loads(next((tmp_path / "files").rglob("*.json")).read_text())["retry_count"] == 0
    files = sorted(str(f.relative_to(tmp_path / "out" / "files")).split("/", 1)[1] for f in (tmp_path / "out" / "files").rglob("*") if f.is_file() and not f.name.endswith(".crc"))
    assert {"content.txt", "boilerplate.txt", "extraction.txt", "sections.json", "rejected-h3s.txt", "sections/chapter-1-the-topic/01-configuring-alpha.md", "debug/llm-calls/1-0-0.json"} <= set(files)
    assert sum(f.startswith("kb-drafts/") for f in files) >= 2
    nested = json.loads(next((tmp_path / "out" / "files").rglob("sections.json")).read_text())
    assert (nested["document_title"], nested["source_pdf"], nested["chapters"][0]["number"]) == ("guide", "guide.txt", 1)
    assert "Document: guide\n" in e.table("units").first().user_prompt and {"skip_advice", "missing_headings"} <= set(made.columns)
    assert set(e.table("verified").columns) >= {"unsupported_numbers", "unsupported_commands"}


def test_unreadable_files_are_kept_as_failures(spark, tmp_path, capsys):
    src = tmp_path / "in"
    src.mkdir()
    (src / "bad.pdf").write_bytes(b"not a pdf")
    root = f"file://{tmp_path}/out"
    stale = tmp_path / "out" / "files" / "x"
    stale.mkdir(parents=True)
    assert main(["--root", root, "run-all", f"file://{src}", "--stage", "A", "--skip-clean"]) == 0 and stale.exists()
    assert "could not be read: 1" in capsys.readouterr().out
    assert Engine(spark, root).table("failures").first().path.endswith("bad.pdf")
    assert main(["--root", root, "run-all", f"file://{src}"]) == 0 and not stale.exists()


class Recorder:
    """Keeps nothing, answers with what it was asked as a system."""

    def call(self, system, user):
        return json.dumps({"decision": "skip", "skip_reason": system[:40]})


def test_system_prompts_and_limits(spark, tmp_path, monkeypatch):
    e = Engine(spark, f"{tmp_path}/t")
    rows = [(d, i + 1, t, f"Guide {d}") for d in (1, 2) for i, t in enumerate(manual())]
    e.extract(spark.createDataFrame(rows, "doc_id long, page_number int, text string, document_title string"))
    e.detect()
    made = e.generate(Recorder(), limit=1, partitions=2)
    assert sorted(r.doc_id for r in made.collect()) == [1, 2] and made.first().skip_reason == prompts.GENERATOR[:40]
    own = tmp_path / "own.md"
    own.write_text("my own words")
    monkeypatch.setenv("QUIREWORK_GENERATOR_PROMPT", str(own))
    assert e.generate(Recorder()).first().skip_reason == "my own words"
    for word in (*rules.KB_TYPES, *(h for hs in rules.REQUIRED_HEADINGS.values() for h in hs), "skip_reason", "kb_filename", "kb_content", *rules.SKIP_RULES):
        assert word in prompts.GENERATOR
    for word in (*rules.PROBLEM_CATEGORIES, *rules.SEVERITIES, "PASS", "FLAG", "claim", "issue"):
        assert word in prompts.VERIFIER


def test_a_missing_server_ends_the_run(tmp_path, monkeypatch):
    monkeypatch.setenv("LLM_BACKEND", "vllm")
    monkeypatch.setenv("VLLM_HOST", "http://127.0.0.1:9")
    with pytest.raises(SystemExit, match="model not available"):
        main(["--root", f"file://{tmp_path}/out", "generate-kbs", "--model", "m"])


def test_chat_and_plain_servers(monkeypatch):
    """Both endpoints and their probes, against a server of the test's own."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def answer(self, data):
            body = json.dumps(data).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            self.answer({"data": [{"id": "m"}]} if self.path == "/v1/models" else {"models": [{"name": "n"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if self.path == "/v1/chat/completions":
                self.answer({"choices": [{"message": {"content": asked["messages"][0]["content"] + "/" + asked["messages"][1]["content"]}}]})
            else:
                self.answer({"response": asked["prompt"][-30:]})

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    host = f"http://127.0.0.1:{server.server_port}"
    chat, plain = model.HttpBackend(host, "m"), model.HttpBackend(host, "n", chat=False)
    assert chat.call("s", "u") == "s/u" and plain.call("s", "u").endswith("<|im_start|>assistant\n")
    assert chat.available() == (True, "ok") and plain.available()[0] and not model.HttpBackend(host, "other").available()[0]
    server.shutdown()


def test_requests_run_side_by_side(spark):
    import time

    class Slow:
        def call(self, system, user):
            time.sleep(0.05)
            return user

    seen = []
    df = spark.range(80).selectExpr("id", "concat('p', id) AS user_prompt").coalesce(1)
    began = time.monotonic()
    rows = model.call_model(df, Slow(), concurrency=40).collect()
    assert [r.raw_text for r in rows] == [f"p{i}" for i in range(80)] and time.monotonic() - began < 3.0 and not seen


def test_stage_tables_follow_their_source(spark, tmp_path):
    tables, path = scratch.StageTables(), f"{tmp_path}/t"
    count = lambda: tables.get(spark, path, "n", lambda: spark.read.parquet(path).groupBy().count()).first()[0]
    spark.range(3).write.parquet(path)
    assert (count(), count()) == (3, 3) and len(tables.known) == 1
    spark.range(5).write.mode("overwrite").parquet(path)
    assert count() == 5


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, tmp_path):
    class Cluster:
        conf = {}  # noqa: RUF012

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "a"

    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch.scratch_dir(Cluster(), "x")
    t = scratch.materialize(spark.range(3), "x")
    assert t.count() == 3
    scratch.discard(t)
    assert not os.path.exists(t.scratch_path.removeprefix("file://"))


def test_decoder_errors_are_rows(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"not a pdf")
    (tmp_path / "b.txt").write_text("one\ftwo")

    def fail(data):
        raise OSError("bad file")

    assert readers.read_documents(spark, str(tmp_path), fail).first().error == "OSError: bad file"
    got = readers.read_documents(spark, str(tmp_path), readers.decode_form_feeds, "*.txt").orderBy("page_number").collect()
    assert [(r.page_number, r.text, r.document_title) for r in got] == [(1, "one", "b"), (2, "two", "b")]


def test_sections_json_round_trip(spark, tmp_path):
    e = Engine(spark, f"{tmp_path}/t")
    e.extract(spark.createDataFrame([(7, i + 1, t) for i, t in enumerate(manual())], "doc_id long, page_number int, text string"))
    e.detect(skip_filter=True)
    ch, sec, warn = (e.table(n) for n in ("chapters", "sections", "warnings"))
    writers.write_files(writers.sections_json(ch, sec, warn).select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), F.col("json").alias("content")), f"{tmp_path}/json")
    c2, s2 = readers.read_sections_json(spark, f"{tmp_path}/json/*.json")
    cols = ["pos", "section_title", "section_level", "parent_section", "page_start", "page_end", "content", "notes", "word_count", "h3_count", "chapter_summary"]
    assert s2.select(cols).orderBy("pos").collect() == sec.select(cols).orderBy("pos").collect()
    assert c2.first().expected_sections == ch.first().expected_sections
    (tmp_path / "bare.json").write_text('{"chapters": [{"number": 2, "title": "T", "sections": [{"section_title": "S", "section_level": 2}]}]}')
    assert readers.read_sections_json(spark, f"{tmp_path}/bare.json")[1].first().notes == []
    files = {r.path: r.content for r in writers.section_files(sec).collect()}
    assert "7/sections/chapter-1-the-topic/02-h3-module-details.md" in files
    reports = {r.path: r.content for r in writers.extraction_reports(e.table("pages")).collect()}
    assert reports["7/extraction.txt"] == "pages: 5\ncontent: 2\nboilerplate: 3\n" and "Table of contents header" in reports["7/boilerplate.txt"]
    from quirework.operators import subsections

    audit = writers.audit_file(subsections.decisions(sec)).first().content
    assert "subsections: 1\naccepted: 1 (100.0%)\nrejected: 0 (0.0%)" in audit and "ACCEPTED chapter 1 / Configuring Alpha" in audit


def test_drafts_are_read_in_order(spark, tmp_path):
    for n in ("b.md", "a.md", "a.verification.md", "c.txt"):
        (tmp_path / n).write_text(f"---\nid: {n}\n---\nx")
    assert [r.kb for r in readers.read_drafts(spark, str(tmp_path)).orderBy("path").collect()] == ["a.md", "b.md"]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, i + 1, t) for i, t in enumerate(manual())], "doc_id long, page_number int, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    q = classify_stream(page_stream(spark, f"{tmp_path}/in", files_per_trigger=1), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("page_number")
    assert got.collect() == pages.classify_pages(df).select(got.columns).orderBy("page_number").collect()
    assert event_windows(df.selectExpr("timestamp'2024-01-01' AS ts", "'k' AS event_type", "1.0 AS value")).first().n == 5


def test_run_statistics(spark):
    g = spark.createDataFrame([("generate",), ("skip",), ("generate",), ("error",)], "decision string")
    v = spark.createDataFrame([(1, "PASS"), (1, "FLAG"), (2, "PASS")], "doc_id long, decision string")
    r = stats.run_stats(g, v).first()
    assert (r.n_generate, r.n_skip, r.n_error, r.n_pass, r.n_flag, r.n_verify_error, r.generation_rate, r.pass_rate) == (2, 1, 1, 2, 1, 0, 0.5, 2 / 3)
    assert {(x.doc_id, x.PASS, x.FLAG, x.ERROR) for x in stats.per_document(v).collect()} == {(1, 1, 1, 0), (2, 1, 0, 0)}
    assert stats.run_stats(g.where("false"), v.where("false")).first().pass_rate == 0.0
    t = spark.createDataFrame([(100,), (300,)], "n_tokens long")
    assert tuple(stats.throughput(t, t, 4.0, 2.0).first()) == (100.0, 200.0, 2.0)
    assert tuple(stats.latency(spark.createDataFrame([(1.0,), (3.0,)], "duration_seconds double"), 2.0).first()) == (4.0, 2.0, 2.0)
