import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from quirework.operators import model, responses, units, verify
from tests.test_sections import SECTION, h3


def test_granularity(spark):
    rows = [
        h3(0, "Small", "s", level=2, parent=None, words=399), h3(1, "s1", "a", parent="Small", words=10, pages=(0, 7)), h3(2, "s2", "b", ["n"], parent="Small", words=5),
        h3(3, "Many", "m", level=2, parent=None, words=99), h3(4, "m1", "c", parent="Many"), h3(5, "m2", "c", parent="Many"), h3(6, "m3", "c", parent="Many"),
        h3(7, "Large", "l", ["q"], level=2, parent=None, words=400), h3(8, "Restart of it", "d", parent="Large"),
    ]
    u = units.describe(units.split_units(spark.createDataFrame(rows, SECTION))).orderBy("pos", "sub").collect()
    assert [(r.section_title, len(r.children), r.parent_section) for r in u] == [("Small", 2, None), ("m1", 0, "Many"), ("m2", 0, "Many"), ("m3", 0, "Many"), ("Large", 0, None), ("Restart of it", 0, "Large")]
    assert (u[0].full_content, u[0].all_notes, u[0].page_range, u[0].total_words) == ("s\n\n\n### s1\n\na\n\n\n### s2\n\nb", ["n"], "0-7", 414)
    assert u[-1].suggested_type == "troubleshooting" and u[4].page_range == "1"
    assert units.first_units(units.split_units(spark.createDataFrame(rows, SECTION)), 2).count() == 2


@pytest.mark.parametrize(("title", "content", "want"), [("Verifying Config", "", "troubleshooting"), ("Reconfiguration", "", "config"), ("X", "do Switch(config)# y", "config"), ("X", "y" * 500 + "configure terminal", "theory"), ("X", "", "theory")])
def test_types(spark, title, content, want):
    assert spark.createDataFrame([(title, content)], "t string, c string").select(units.suggest_type(F.col("t"), F.col("c"))).first()[0] == want


def test_template(spark):
    df = spark.createDataFrame([("has $b and ${a}",)], "a string")
    assert df.select(units.fill("x $a ${a} $$5 $other $", {"a": F.col("a"), "b": F.lit("!")})).first()[0] == "x has $b and ${a} has $b and ${a} $5 $other $"


GOOD = {"decision": "generate", "kb_filename": "f", "kb_content": "c"}


@pytest.mark.parametrize(("raw", "ok", "error"), [
    (json.dumps(GOOD), True, None), (f"```json\n{json.dumps(GOOD)}\n```", True, None), (f"Sure: {json.dumps(GOOD)} done", True, None), (json.dumps(GOOD) + " junk", True, None),
    ("[1]", False, "Response is not a JSON object"), ("nothing", False, "No JSON object found in response"), ("{}", False, "Missing 'decision' field"), ('{"decision": "x"}', False, "Invalid decision: x"),
    ('{"decision": "generate", "kb_filename": ""}', False, "Missing kb_filename for generate decision"), ('{"decision": "generate", "kb_filename": "f"}', False, "Missing kb_content for generate decision"),
    ('{"decision": "skip", "score": NaN}', True, None), ('{"decision": "x", "decision": "skip"}', True, None), (None, False, "no response"),
])
def test_generated_responses(spark, raw, ok, error):
    p = spark.createDataFrame([(raw,)], "r string").select(responses.parse_generated(F.col("r")).alias("p")).first().p
    assert (p.ok, p.error) == (ok, error)


@pytest.mark.parametrize(("raw", "decision", "n"), [
    ('{"decision": "PASS"}', "PASS", 0), ('{"decision": "FLAG", "problems": [{"claim": "c", "severity": "odd"}, "text", 7]}', "FLAG", 3), ('{"decision": "PASS", "problems": null}', "PASS", 0),
    ('{"decision": "PASS", "problems": [{"severity": "major"}]}', "PASS", 1), ('{"decision": "MAYBE"}', None, None), ('{"decision": "PASS", "problems": {}}', "PASS", 0), ('{"decision": "PASS", "problems": "x"}', None, None),
])
def test_verified_responses(spark, raw, decision, n):
    p = spark.createDataFrame([(raw,)], "r string").select(responses.parse_verified(F.col("r")).alias("p")).first().p
    assert (p.decision, None if p.problems is None else len(p.problems)) == (decision, n)


def test_problem_shapes():
    assert responses.read_problem("t") == {"category": "malformed_llm_output", "claim": "", "issue": "t", "severity": "minor"}
    assert responses.read_problem(3)["issue"] == "Unexpected problem entry type: int"
    assert responses.read_problem({"claim": "c"}) == {"category": "unknown", "claim": "c", "issue": "", "severity": "minor"}


def test_names(spark):
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(["a", "A.md", "a-2", "", "é"])] + [(2, 0, "a")], "doc_id long, seq long, kb_filename string")
    got = sorted((r.doc_id, r.seq, r.file_name) for r in responses.unique_names(df).collect())
    assert [x[2] for x in got] == ["a", "a-2", "a-2-2", "untitled", "untitled-2", "a"]


class Flaky:
    def __init__(self, answers):
        self.answers = list(answers)

    def call(self, system, user):
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a


def test_retry():
    run = lambda *a: model.call_with_retry(Flaky(a), "", "u", waits=(0.0, 0.0))
    assert (run(TimeoutError(), "", "x")["retry_count"], run("x")["success"]) == (2, True)
    failed = run(" ", urllib.error.URLError("refused"), KeyError("choices"))
    assert not failed["success"] and failed["error"].startswith("malformed") and failed["retry_count"] == 3
    assert model.describe_error(urllib.error.HTTPError("u", 503, "m", None, None)) == "HTTP 503"


def test_model_keeps_rows_and_keys(spark):
    df = spark.createDataFrame([(i, None if i == 3 else f"p{i}") for i in range(9)], "k long, user_prompt string").repartition(3)
    for n in (1, 4):
        rows = {r.k: r for r in model.call_model(df, model.StubBackend(), concurrency=n).collect()}
        assert len(rows) == 9 and rows[3].success is None
        assert all(rows[k].raw_text == model.StubBackend().call("", f"p{k}") for k in rows if k != 3)


def test_backend_settings(monkeypatch):
    monkeypatch.setenv("VLLM_CONCURRENCY", "0")
    assert model.concurrency_from_env() == 32
    monkeypatch.setenv("VLLM_CONCURRENCY", "7")
    assert model.concurrency_from_env() == 7
    monkeypatch.setenv("LLM_BACKEND", "vllm")
    b = model.backend_from_env("verify", "m")
    assert b.chat and b.max_tokens == 2048 and b.payload("s", "u")["response_format"] == {"type": "json_object"}
    monkeypatch.setenv("LLM_BACKEND", "ollama")
    assert "<|im_start|>user\nu<|im_end|>" in model.backend_from_env("generate", "m").payload("s", "u")["prompt"]
    monkeypatch.setenv("LLM_BACKEND", "none")
    with pytest.raises(ValueError):
        model.backend_from_env()
    assert model.HttpBackend("http://127.0.0.1:9", "m").available(0.2)[0] is False


@pytest.mark.parametrize(("text", "error"), [
    ("---\nid: a\nsource:\n  chapter: 5\n  pages: [1, 2]\n---\nb", None), ("x", "no front matter"), ("---\nid: x", "malformed front matter"), ("---\na: [\n---\nb", "YAML error"), ("---\n- a\n---\nb", "front matter is not a mapping"),
    ("---\nsource: x\n---\nb", "source is not a mapping"), ("---\nsource: {pages: 3}\n---\nb", "pages is not a list of numbers"), ("---\nid: a\n---\nb", None), (None, "no front matter"),
])
def test_front_matter(text, error):
    got = verify.read_front(text)
    assert got["ok"] is (error is None) and (error is None or got["error"].startswith(error))


def test_source_matching(spark):
    rows = [h3(0, "Service Restarts", "c", level=2, parent=None, pages=(1, 4)), h3(1, "Restart Types", "c", parent="Service Restarts", pages=(2, 2)), h3(2, "HA", "c", level=2, parent=None, pages=(5, 8)), h3(3, "HA Deep Dive", "c", parent="HA", pages=(5, 8))]
    sec = spark.createDataFrame(rows, SECTION)
    ch = spark.createDataFrame([(1, 1, 1, "Ch"), (1, 2, 5, "Network Level"), (1, 3, 5, "Again")], "doc_id long, chapter_idx long, chapter_number long, chapter_title string")
    cases = [("a", "nx-os-service-restarts-config", "1", [1]), ("b", "nx-os-restart", "1", [9]), ("c", "ha", "Chapter 1", [1]), ("d", "x", "ch", [6, 7]), ("e", "x", "1", []), ("f", "x", "1", [50]), ("g", "x", "802.1X", [1]), ("h", "", "Network", []), ("i", "x", "1", [2])]
    d = spark.createDataFrame([(1, *c) for c in cases], "doc_id long, kb string, kb_id string, chapter string, pages array<long>")
    m = verify.match_chapters(d, ch)
    assert {r.kb: r.chapter_idx for r in m.collect()} == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1, "f": 1, "g": None, "h": 2, "i": 1}
    got = {r.kb: (r.pos, r.how) for r in verify.match_sections(m, sec).collect()}
    assert got == {"a": (0, "title"), "b": (0, "title within"), "c": (2, "title"), "d": (2, "pages"), "e": (0, "pages"), "f": (0, "pages"), "i": (0, "pages")}


def test_verification_flow(spark):
    rows = [h3(0, "Some Section", "the content", ["n1"], level=2, parent=None), h3(1, "Child", "kid text", ["n2"], parent="Some Section")]
    sec = spark.createDataFrame(rows, SECTION)
    ch = spark.createDataFrame([(1, 1, 1, "Ch")], "doc_id long, chapter_idx long, chapter_number long, chapter_title string")
    good = "---\nid: some-section\nsource: {chapter: Ch, pages: [1]}\n---\nbody"
    d = spark.createDataFrame([(1, "good.md", good), (1, "bad.md", "x"), (1, "lost.md", "---\nid: x\nsource: {chapter: Nowhere, pages: [3]}\n---\nb")], "doc_id long, kb string, text string")
    ready = verify.prepare(d, ch, sec)
    by = {r.kb: r for r in ready.collect()}
    assert by["bad.md"].user_prompt is None and by["bad.md"].error_message == "Frontmatter parse error: no front matter"
    assert by["lost.md"].error_message == "Could not find source section for chapter=Nowhere, pages=[3]"
    assert all(x in by["good.md"].user_prompt for x in (good, "the content", "### Subsection: Child", "- n2", "Notes:\n- n1"))
    done = verify.verification_results(model.call_model(ready, model.StubBackend("verify")))
    assert {r.kb: r.decision for r in done.where("decision = 'ERROR'").collect()} == {"bad.md": "ERROR", "lost.md": "ERROR"}
    assert {r.target: r.n for r in verify.routing(done).collect()}["verification-errors"] == 2
    assert verify.report(done).where("kb = 'bad.md'").first().report.startswith("Decision: ERROR\nError: Frontmatter")


def test_report_order(spark):
    p = [("c1", "x", "i", "minor"), ("c2", "y", "i", "odd"), ("c3", "z", "i", "critical"), ("c4", "w", "i", "major")]
    df = spark.createDataFrame([(1, "k", "FLAG", p, None)], "doc_id long, kb string, decision string, problems array<struct<category:string,claim:string,issue:string,severity:string>>, error_message string")
    assert verify.report(df).first().report == "Decision: FLAG\n- [critical] c3: z - i\n- [major] c4: w - i\n- [minor] c1: x - i"
    assert {r.severity: r.n for r in verify.severity_counts(df).collect()} == {"critical": 1, "major": 1, "minor": 1}
