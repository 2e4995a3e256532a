"""The driver's contract, and each query of the library against its SQL on the small tables."""

import os
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quirework.plans import queries as own

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
here = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(x):
    if isinstance(x, float):
        return round(x, 9)
    return int(x) if hasattr(x, "as_integer_ratio") and not isinstance(x, bool) and x == int(x) else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_names():
    known = __spark_entry__.queries()
    assert set(own.QUERIES) <= set(known) and set(__spark_entry__.oracle_sql()) <= set(known)
    assert set(own.SQL) <= set(own.QUERIES)


@here
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@here
@pytest.mark.parametrize("name", sorted(own.SQL))
def test_query_equals_sql(spark, duck, name):
    df = own.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rel = duck.sql(own.SQL[name])
    assert sorted(rel.columns) == cols
    ours = sorted(repr([plain(v) for v in r]) for r in df.select(cols).collect())
    theirs = sorted(repr([plain(v) for v in r]) for r in rel.select(*(f'"{c}"' for c in cols)).fetchall())
    assert ours == theirs


@here
@pytest.mark.parametrize("name", sorted(set(own.QUERIES) - set(own.SQL)))
def test_other_queries_have_rows(spark, name):
    assert own.QUERIES[name](spark, DATA).count() > 0


@here
def test_similar_titles_are_found(spark):
    """The query without SQL, against the definition over each chapter's lines."""
    from quirework.operators import sections

    lines = own.book(spark, DATA).withColumn("text", F.regexp_replace("text", "^(Configuring|Verifying|Installing) Unit ", "$1 Units "))
    marked = sections.mark_chapters(lines)
    ch = sections.chapters(marked).collect()
    by = {}
    for r in marked.where("chapter_idx > 0").select("doc_id", "chapter_idx", "line_no", "norm").orderBy("line_no").collect():
        by.setdefault((r.doc_id, r.chapter_idx), []).append((r.line_no, r.norm))
    want = {}
    for c in ch:
        for i, (title, line, fuzzy) in enumerate(plain_anchors(c.expected_sections, by[c.doc_id, c.chapter_idx], c.toc_end)):
            want[c.doc_id, c.chapter_idx, i] = (title, line, fuzzy)
    got = {(r.doc_id, r.chapter_idx, r.toc_idx): (r.title, r.line_no, r.fuzzy) for r in own.fuzzy_sections(spark, DATA).collect()}
    assert got == want and any(f for _, _, f in got.values())


def plain_anchors(titles, lines, cursor):
    """Each title's line by equality, else by the best ratio of all lines further on."""
    for title in titles:
        t = " ".join(title.split()).lower()
        equal = [n for n, s in lines if n >= cursor and s == t]
        hit, fuzzy = (equal[0], False) if equal else (None, False)
        if hit is None:
            ratios = [(SequenceMatcher(None, t, s).ratio(), -n) for n, s in lines if n >= cursor and s and len(s) <= 120 and abs(len(s) - len(t)) <= 15]
            if ratios and max(ratios)[0] >= 0.88:
                hit, fuzzy = -max(ratios)[1], True
        yield title, hit, fuzzy
        cursor = cursor if hit is None else hit + 1


@here
def test_plans(spark):
    """Classification is one native scan that reads and moves no more than it needs."""
    from quirework.operators import pages

    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumnRenamed("doc_id", "page_number")
    lines = pages.content_pages(pages.clean_pages(docs)).select("page_number", F.length("text"))
    plan = lines._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    scan = next(x for x in plan.splitlines() if "ReadSchema" in x)
    assert "lang" not in scan.partition("ReadSchema")[2]
    assert own.page_clean_lines(spark, DATA)._jdf.queryExecution().toString().count("Python") == 0
