import pytest
from pyspark.sql import functions as F

from quirework.operators import sections as S
from quirework.operators import subsections as B

BOOK = """before any chapter
C H A P T E R 1

High Availability
this intro tells what the
chapter is about.
• Overview , on page 2
• Switch Over, on page 3

• Never There, on page 9
• Configuring Thinngs, on page 9
High Availability
Overview
the overview begins with a sentence of good length here.
it has a second line that is long enough as well.
Short title
a third line of the text that also ends properly.
Note
after the note come more words.
Switch over
High Availability
Standby Module
the module stands by.
Note
this line after the note is long enough to be taken.
Details
When it fails, words follow.
Switch Over
Configuring Things
Enter the command.
C H A P T E R 12
Empty Chapter
nothing but text here."""


@pytest.fixture(scope="module")
def found(spark):
    rows = [(5, i, 1 + i // 10, t) for i, t in enumerate(BOOK.split("\n"))]
    lines = spark.createDataFrame(rows, "doc_id long, line_no long, page_number int, text string")
    ch, sec, warn = S.detect_sections(lines)
    return ch.orderBy("chapter_idx").collect(), sec.orderBy("chapter_idx", "pos").collect(), warn.orderBy("chapter_idx", "toc_idx").collect()


def test_chapters(found):
    a, b = found[0]
    assert (a.chapter_number, a.chapter_title, a.ch_start, a.ch_end) == (1, "High Availability", 1, 30)
    assert a.chapter_summary == "this intro tells what the chapter is about."
    assert a.expected_sections == ["Overview", "Switch Over", "Never There", "Configuring Thinngs"]
    assert (b.chapter_number, b.chapter_summary, b.expected_sections) == (12, "nothing but text here.", [])
    assert (a.page_start, a.page_end) == (1, 3)


def test_sections(found):
    got = [(s.section_level, s.section_title, s.parent_section) for s in found[1]]
    assert got == [
        (2, "Overview", None), (3, "Short title", "Overview"), (2, "Switch Over", None), (3, "Standby Module", "Switch Over"), (3, "Details", "Switch Over"), (2, "Configuring Thinngs", None),
    ]
    over = found[1][0]
    assert over.content == "the overview begins with a sentence of good length here.\nit has a second line that is long enough as well."
    assert over.h3_count == 1 and over.word_count == 10 + 11 + 2 + 10 + 1 + 6


def test_notes(found):
    notes = {s.section_title: s.notes for s in found[1]}
    assert notes["Short title"] == ["a third line of the text that also ends properly."]
    assert notes["Standby Module"] == ["the module stands by."]
    assert notes["Overview"] == []


def test_warnings(found):
    got = [w.message for w in found[2]]
    assert got == [
        "Chapter 1: section 'Never There' not found",
        "Chapter 1: section 'Configuring Thinngs' matched by similarity at line 28",
        "Chapter 12 (Empty Chapter): no contents entries",
    ]


def test_no_chapters(spark):
    lines = spark.createDataFrame([(1, 0, 1, "x")], "doc_id long, line_no long, page_number int, text string")
    assert [df.count() for df in S.detect_sections(lines)] == [0, 0, 0]


def test_repeated_titles_move_on():
    lines = [(1, "a"), (2, "b"), (3, "a"), (4, "b")]
    assert list(S.fuzzy_anchors(["A", "a", "b", "a"], lines, 0)) == [("A", 1, False), ("a", 3, False), ("b", 4, False), ("a", None, False)]


@pytest.mark.parametrize(("line", "want"), [
    ("Abcd", False), ("Abcde", True), ("A" * 60, True), ("A" * 61, False), ("Ends here.", False), ("Really?", False), ("switch# show it", False), ("Router (config)", True), ("Use router #1", False),
    ("12.5 7", False), ("Step One of it", False), ("Examples", False), ("Table 3 of it", False), ("- Bullet", False), ("lower case", False), ("Élan vital", True),
])
def test_header_shape(spark, line, want):
    assert spark.createDataFrame([(line,)], "s string").select(S.looks_like_header(F.col("s"))).first()[0] is want


@pytest.mark.parametrize(("title", "words", "ok", "reason"), [
    ("abc", 50, False, "Title too short (<4 chars)"), ("Auto-save files", 50, True, "Sufficient content (50 words)"), ("This-one goes", 50, False, "Title starts with sentence-starter 'this-one' (looks like prose, not header)"),
    ("Auto-copy it", 50, False, "Title starts with sentence-starter 'auto-copy' (looks like prose, not header)"), ("Enables Things", 50, False, "Title starts with sentence-starter 'enables' (looks like prose, not header)"),
    ("Some Title", 0, False, "Zero word content (empty section)"), ("N7K-C7010", 50, False, "Cisco product/serial number pattern"), ("Module 3 powered up", 50, False, "Cisco syslog/CLI output line"),
    ('Service "x y" (PID 12)', 50, False, "Cisco syslog/CLI output line"), ("HA Standby (failed)", 50, False, "Pure status value"), ("GNU GRUB", 50, False, "System/terminal output string"),
    ("Status 9F of x", 50, False, "Starts with system string: 'status 9f'"), ("MIBs Link", 50, False, "Table header repetition"), ("12.3 - 4", 50, False, "Mostly digits/symbols"),
    ("Some Title", 20, True, "Sufficient content (20 words)"), ("Some Title", 19, False, "Insufficient content (19 words) and no keyword pattern"),
    ("Verifying it", 5, True, "Keyword pattern (only 5 words content)"), ("Line Cards ", 5, True, "Keyword pattern (only 5 words content)"), ("Line Cards here", 5, False, "Insufficient content (5 words) and no keyword pattern"),
])
def test_subsection_rules(spark, title, words, ok, reason):
    a, r = B.judge(F.col("t"), F.col("w"))
    assert tuple(spark.createDataFrame([(title, words)], "t string, w long").select(a, r).first()) == (ok, reason)


def h3(pos, title, content, notes=(), parent="P", level=3, words=99, pages=(1, 1)):
    return (1, 1, pos, 1, "Ch", title, level, parent, pages[0], pages[1], content, list(notes), words, 0, "sum")


SECTION = "doc_id long, chapter_idx long, pos long, chapter_number long, chapter_title string, section_title string, section_level int, parent_section string, page_start long, page_end long, content string, notes array<string>, word_count long, h3_count long, chapter_summary string"


def test_merging(spark):
    rows = [h3(0, "P", "p", level=2, parent=None), h3(1, "A", "one \n", ["n1"], pages=(3, 4)), h3(2, "B", ""), h3(3, "A", " two", ["n2"], pages=(5, 9)), h3(4, "A", "  ", ["n3"]), h3(5, "B", "x"), h3(6, "A", "other", parent="Q")]
    got = {(r.section_title, r.parent_section): r for r in B.merge_split(spark.createDataFrame(rows, SECTION)).collect()}
    a = got["A", "P"]
    assert (a.content, a.notes, a.page_start, a.page_end, a.word_count, a.pos, a.n_merged) == ("one\n\ntwo", ["n1", "n2", "n3"], 3, 9, 2, 1, 2)
    assert (got["B", "P"].content, got["B", "P"].word_count) == ("\n\nx", 1)
    assert (got["A", "Q"].content, got["A", "Q"].word_count, got["A", "Q"].n_merged) == ("other", 99, 0)
    assert got["P", None].content == "p"


def test_titles_decide(spark):
    rows = [h3(0, "P", "p", level=2, parent=None), h3(1, "Twin", "x", words=50), h3(2, "Twin", "y", words=3, parent="Q"), h3(3, "Other", "z", words=3)]
    kept, decided = B.filter_sections(spark.createDataFrame(rows, SECTION))
    assert [(r.section_title, r.h3_count) for r in kept.orderBy("pos").collect()] == [("P", 1), ("Twin", 0), ("Twin", 0)]
    assert tuple(B.acceptance(decided).first()) == (3, 1, 2, 1 / 3)
    assert B.acceptance(decided.where("false")).first().acceptance_rate == 0.0
