"""What moves, and what is held at once: the plans of steps that carry the texts."""

import os
import re

import pytest
import yaml
from pyspark.sql import functions as F

from quirework.operators import sections as S
from quirework.operators import subsections as B
from quirework.operators import verify as V
from quirework.plans import queries as own
from quirework.sources import writers

DATA = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def moved(df):
    """The columns that exchanges move where no table is small enough to be broadcast."""
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]$", plan, re.MULTILINE)
    return {re.sub(r"#\d+L?$", "", c.strip()) for f in found for c in f.split(", ")}


@here
def test_texts_of_lines_stay_where_they_are(spark):
    """F3."""
    assert not {"text", "s", "_s", "note", "content", "body"} & moved(own.section_notes(spark, DATA))
    ch = own._chapters(spark, DATA)
    assert not {"text", "content", "body", "notes"} & moved(S.section_table(own._blocks(spark, DATA), ch))


@here
def test_contents_stay_where_they_are(spark):
    """F5, F8: merging and filtering; F4: nesting."""
    merged = own._merged(spark, DATA)
    for df in (B.merge_split(own._sections(spark, DATA)), B.keep_accepted(merged.drop("n_merged"), own._decided(spark, DATA))):
        assert not {"content", "p", "notes"} & moved(df)
    ch = own._chapters(spark, DATA)
    nested = writers.sections_json(ch, own._sections(spark, DATA), S.detection_warnings(ch, own._anchors(spark, DATA)))
    assert not {"content", "l", "sections", "_sections"} & moved(nested)


@here
def test_stage_tables_drop_what_no_later_stage_reads(spark):
    """drafts; F1: prepared drafts; F7: verified ones."""
    assert not {"content", "full_content", "children"} & set(own._prompts(spark, DATA).columns)
    assert "user_prompt" not in own._named(spark, DATA).columns
    assert "source_text" not in own._prepared(spark, DATA).columns
    assert "user_prompt" not in own._verified(spark, DATA).columns


@here
def test_front_matter_is_parsed_once(spark):
    """what is joined several times is the stored result."""
    drafts = spark.createDataFrame([(1, "a", "---\nid: x\n---\nb")], "doc_id long, kb string, text string")
    plan = V.prepare(drafts, own._chapters(spark, DATA), own._kept(spark, DATA))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize("text", ["id: x\nsource:\n  chapter: Chapter 7\n  pages: [1, 2]", "a: b: c", "- a\n- b", "a: [1", "x: 2001-01-01", "a:\tb", "é: ü", "", "a: yes\nb: 1_0\nc: 0o7"])
def test_fast_yaml_is_the_same(text):
    def read(f):
        try:
            return f(text)
        except yaml.YAMLError as e:
            return str(e)

    assert read(V.load_yaml) == read(yaml.safe_load)


@here
def test_drafts_meet_a_chapter_as_one_row(spark):
    """a row for each pair of a draft and a section was sorted before."""
    d = V.match_chapters(own._book_drafts(spark, DATA), own._chapters(spark, DATA))
    plan = V.match_sections(d, own._sections(spark, DATA))._jdf.queryExecution().optimizedPlan().toString()
    ranked = next(x for x in plan.splitlines() if "min(" in x and "kb#" in x and "by_title" not in x)
    assert "section_level" not in ranked and "min(r#" in ranked and "collect_list(" in plan


@here
def test_arrivals_are_many_files(spark, monkeypatch):
    """three files, one a batch, left all cores but one idle."""
    seen = {}
    real = own.page_stream

    def spy(spark, path, files_per_trigger):
        seen["files"] = len([x for x in os.listdir(path.removeprefix("file://")) if x.endswith(".parquet")])
        seen["batch"] = files_per_trigger
        return real(spark, path, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(own, "page_stream", spy)
    assert own.page_stream_table(spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id IS NOT NULL").count()
    assert seen["files"] >= spark.sparkContext.defaultParallelism and 1 < seen["batch"] < seen["files"]


@here
def test_books_of_a_task_are_bounded(spark, monkeypatch):
    """the books are dealt to as many tasks as their size asks for."""
    seen = []
    real = writers.write_files
    monkeypatch.setattr(own, "bucket_count", lambda spark, path: 17)
    monkeypatch.setattr(own.writers, "write_files", lambda files, root: seen.append(files.rdd.getNumPartitions()) or real(files, root))
    assert own.page_scan(spark, DATA).count() > 0 and seen[0] == 17


def test_long_lines_are_compared_by_digest(spark):
    """Lines beyond the longest form are equal exactly where their forms are."""
    from quirework.functions.text import match_key

    x, y, z = "Ab  c" * 60, "aB c" * 60, "ab d" * 60
    a, b, c, d = spark.createDataFrame([(x, y, z, " Ab  C ")], "x string, y string, z string, d string").select(*(match_key(F.col(n)) for n in "xyzd")).first()
    assert a == b != c and len(a) == 65 and d == "ab c"
    lines = [(1, c), (2, a)]
    assert [n for _, n, _ in S.fuzzy_anchors([y], lines, 0)] == [2]
