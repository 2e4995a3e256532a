import random
import re

import pytest
from pyspark.sql import functions as F

from quirework.functions import rules
from quirework.functions import text as T
from quirework.operators import pages as P

FILL = "\n".join(["the body of a page that is long enough to count as content, line by line."] * 5)


def one(spark, expr, **values):
    kinds = {int: "bigint", str: "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return df.select(expr).first()[0]


@pytest.mark.parametrize(("text", "page", "want"), [
    (FILL, 1, rules.FIRST_PAGES_REASON), (FILL, 2, rules.FIRST_PAGES_REASON), (FILL, 3, None),
    ("the specifications AND information regarding the products\n" + FILL, 3, "Legal notice"),
    (FILL + "\nContents  ", 3, "Table of contents header"), (FILL + "\nContents of it", 3, None),
    (FILL + "\nINDEX", 3, "Index header"), (FILL + "\nI N D E X", 3, "Index header (spaced)"),
    ("Audience\nCONTENTS\n" + FILL, 9, "Table of contents header"),
    ("x" * 199 + "\n\n", 3, "Sparse content (199 chars)"), ("x" * 200, 3, "Too few lines (1)"),
    (FILL + "\nCONTENTS\u00a0", 3, "Table of contents header"), (FILL + "\n\u2003INDEX", 3, None), (FILL + "\nI\u00a0N D E X", 3, "Index header (spaced)"),
    (FILL + "\nINDE\u2028X", 3, "Index header (spaced)"), (FILL + "\nAud\u0131ence", 3, "Audience section"), (FILL + "\nContent\u017f", 3, "Table of contents header"),
    ("\n".join(["y" * 80] * 3), 3, "Too few lines (3)"), ("\n".join(["y" * 80] * 4), 3, None), ("", 3, "Sparse content (0 chars)"),
])
def test_reasons(spark, text, page, want):
    df = spark.createDataFrame([(page, text)], "page_number bigint, text string")
    assert P.clean_pages(df).first().boilerplate_reason == want


def test_every_pattern_has_its_reason(spark):
    samples = ["THE SPECIFICATIONS AND INFORMATION REGARDING THE PRODUCTS", "Cisco and the Cisco logo are trademarks", "CONTENTS", "PREFACE Preface x", "This preface includes the following sections",
               "Reference Preface Map here", "Audience", "This publication is for network administrators", "Document Conventions", "Documentation Feedback", "Related Documentation for Cisco Nexus",
               "Communications, services, and additional information", "Cisco Bug Search Tool", "INDEX", "I N D E X"]
    df = spark.createDataFrame([(i, 3, s + "\n" + FILL) for i, s in enumerate(samples)], "i int, page_number int, text string")
    got = [r.boilerplate_reason for r in P.clean_pages(df).orderBy("i").collect()]
    assert got == [reason for _, reason in rules.PAGE_PATTERNS]


@pytest.mark.parametrize(("line", "keep"), [("My  GUIDE", False), ("iv", False), ("MIX", False), ("12", False), ("IN-3", False), ("IN-x", True), ("  ", False), ("  kept as it is ", True), ("civil war", True)])
def test_clean_lines(spark, line, keep):
    df = spark.createDataFrame([(3, f"{FILL}\na line\n{line}\nb line", "My Guide")], "page_number bigint, text string, title string")
    got = P.clean_pages(df, F.col("title")).first().text.removeprefix(FILL + "\n")
    assert got == ("a line\n" + line + "\nb line" if keep else "a line\nb line")


def test_header_hints(spark):
    text = "Overview of it\nthe text goes on\nNot one.\nthe text\nAnother Header\nThe text\nLast Header\n Indented text"
    assert one(spark, P.header_hints(F.split("t", "\n")), t=text) == ["Overview of it", "Another Header"]
    for t, want in (("One Header", []), ("", []), ("One Header\n\nthe text", ["One Header"]), ("One Header\n\n\nthe text", []), ("One Header\n  The text", ["One Header"])):
        assert one(spark, P.header_hints(F.split("t", "\n")), t=t) == want


def plain_page(text, number, title):
    """The rules over one page in plain Python: (reason, text, headers)."""
    norm = lambda x: re.sub(r"\s+", " ", x).strip().lower()
    reason = rules.FIRST_PAGES_REASON if number <= rules.FIRST_PAGES else None
    reason = reason or next((why for p, why in rules.PAGE_PATTERNS if re.search(p, text, re.M | re.I)), None)
    size, lines = len(re.sub(r"\s+", " ", text).strip()), text.split("\n")
    full = sum(bool(x.strip()) for x in lines)
    reason = reason or (f"Sparse content ({size} chars)" if size < rules.SPARSE_CHARS else f"Too few lines ({full})" if full <= rules.FEW_LINES else None)
    if reason:
        return reason, text, []
    kept = [x for x in lines if x.strip() and norm(x) != norm(title) and not re.match(r"^([ivxlcdm]+)$", x.strip(), re.I) and not re.match(r"^(\d+|IN-\d+)$", x.strip())]
    heads = []
    for i, x in enumerate(kept):
        s = x.strip()
        after = next((y for y in kept[i + 1 : i + 3] if y.strip()), None)
        if 5 <= len(s) <= 80 and s[0].isupper() and not s.endswith(".") and after is not None and (after[0].islower() or after.strip().startswith(rules.HINT_OPENERS)):
            heads.append(s)
    return None, "\n".join(kept), heads


def test_pages_equal_plain_python(spark):
    rng = random.Random(3)
    words = [re.sub(r"\\s[*+]|[\^$]", " ", p).strip() for p, _ in rules.PAGE_PATTERNS]
    odd = ["iv", "MIX", "12", "IN-9", "\u0661\u0662", "", " ", "\u00a0", "\x1c", "My Guide", " my\u2003GUIDE ", "A Header Line", "Short", "The text", "This text.", "  indented text", "\u00c9tat du nord", "\u00e9tat", "CHAPTER 7"]
    space = [" ", "  ", "\t", "\u00a0", "\u2028", "\x1d", ""]
    rows = []
    for i in range(600):
        lines = [rng.choice(odd) if rng.random() < 0.6 else rng.choice(words) + rng.choice(["", " more"]) if rng.random() < 0.08 else "some words of a line that go on. " * rng.randrange(1, 3) for _ in range(rng.randrange(0, 14))]
        rows.append((i, rng.choice([2, 3, 9]), "\n".join(rng.choice(space) + x + rng.choice(space) for x in lines), rng.choice(["My Guide", "", "Other"])))
    df = spark.createDataFrame(rows, "i int, page_number int, text string, title string")
    got = {r.i: (r.boilerplate_reason, r.text, r.detected_headers) for r in P.classify_pages(df, F.col("title")).collect()}
    for i, number, text, title in rows:
        assert got[i] == plain_page(text, number, title)


def test_null_titles_and_texts_and_clashing_names(spark):
    schema = "page_number bigint, text string, title string, _low string, page_facts int, boilerplate_reason string, `a.b` int"
    df = spark.createDataFrame([(3, FILL, None, "mine", 7, "old", 1), (4, None, "t", "mine", 7, None, 1)], schema)
    rows = P.classify_pages(df, F.col("title")).orderBy("page_number").collect()
    assert rows[0].text == FILL and rows[0].boilerplate_reason is None and rows[0]._low == "mine" and rows[0].page_facts == 7 and rows[0]["a.b"] == 1
    assert rows[1].text == "" and rows[1].boilerplate_reason == "Sparse content (0 chars)"


def test_long_pages_cost_no_more_than_their_lines(spark):
    import time

    def seconds(n):
        text = "\n".join(f"Header Of Part {i}\nthe text of the part goes on" for i in range(n // 2))
        df = spark.createDataFrame([(i, 3, text) for i in range(8)], "i int, page_number int, text string").coalesce(1)
        began = time.perf_counter()
        assert P.classify_pages(df).agg(F.sum(F.size("detected_headers"))).first()[0] == 8 * (n // 2)
        return time.perf_counter() - began

    seconds(400)
    few, many = (min(seconds(n) for _ in range(2)) for n in (4_000, 16_000))
    assert many < 3 * 4 * max(few, 0.2)


def test_classify_and_counts(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, FILL + "\nCHAPTER 4\nSome Header\nthe text\n12"), (1, 4, "")], "doc_id long, page_number int, text string")
    c = P.classify_pages(df)
    row = c.where("page_number = 3").first()
    assert row.has_chapter_header and row.has_section_header and row.detected_headers[-1] == "Some Header" and not row.text.endswith("12")
    assert tuple(P.page_counts(c).first()) == (3, 1, 2, 1, len(row.detected_headers))
    assert P.content_pages(c).count() == 1 and P.boilerplate_pages(c).count() == 2
    assert [r.n for r in P.reason_histogram(c, "boilerplate_reason", "page_number").collect()] == [1, 1]


@pytest.mark.parametrize(("fn", "given", "want"), [
    (T.slug, "  Hello, World--x ", "hello-world-x"), (T.slug, "É", "untitled"), (T.slug, "", "untitled"),
    (T.title_form, "Chapter 5: High-Availability (HA)", "high availability ha"), (T.title_form, "5. X.Y", "x y"), (T.title_form, "", ""),
    (T.title_of_id, "nx-os-troubleshooting-service-restarts", "troubleshooting service restarts"), (T.title_of_id, "NX-OS-hsrp-Theory", "hsrp"), (T.title_of_id, "ios-xe-configuring-vlan", "configuring vlan"),
    (T.count_words, "naïve don't x_1 — 7", 5), (T.count_tokens, "naïve don't — 7 x", 5), (T.match_form, "  A\t b\n", "a b"),
    (T.preview, "  a\nb" + "c" * 100, "a b" + "c" * 77), (T.strip_fence, "```json\n{}\n```", "{}"), (T.strip_fence, " {} ", "{}"),
    (T.duration, "3725", "1h 02m 05s"),
])
def test_text_functions(spark, fn, given, want):
    assert one(spark, fn(F.col("t")), t=given) == want


@pytest.mark.parametrize(("given", "want"), [
    ("---\nid: x\nplatform: old # c\nplatform: two\n---\nbody\n---\nplatform: z", "---\nid: x\nplatform: $1\\n\nplatform: two\n---\nbody\n---\nplatform: z"),
    ("---\nid: x\n---\nb", "---\nplatform: $1\\n\nid: x\n---\nb"), ("no front\n---\nx", "no front\n---\nx"), ("---\nid: x", "---\nid: x"), ("", ""),
])
def test_override(spark, given, want):
    once = one(spark, T.override_platform(F.col("t"), "$1\\n"), t=given)
    assert once == want
    assert one(spark, T.override_platform(F.col("t"), "$1\\n"), t=once) == want


def test_title_resolution(spark):
    df = spark.createDataFrame([(" T ", "f"), ("Untitled", "f"), (None, "f"), ("", "f")], "m string, s string")
    assert [r[0] for r in df.select(P.resolve_title(F.col("m"), F.col("s"))).collect()] == ["T", "f", "f", "f"]
