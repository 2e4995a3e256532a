import re
from collections import Counter

from quirework.llm.hostrules import beta_prior, filter_documents, host_verdicts, judge_documents

SPACE = "[\x20\x09-\x0d]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    lines = [x for x in text.split("\n") if re.sub(SPACE, "", x)]
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] >= 2:
            covered |= set(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def stats(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_statistics_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    texts = [None, "", " \n\x0b\x0c\r\t", "\xa0 a\u2003b", "a " * 200, "# % é\n\n#\n#", "x\n x\nx\n"]
    for _ in range(150):
        n = rng.choice((3, 9, 30, 200))
        texts.append("".join(rng.choice(("a", "b", "cc", "#é", "é")) + rng.choice((" ", "\n", "  ", "\t")) for _ in range(n)))
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = judge_documents(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert stats(r) == brute(texts[r.id])


def host_docs(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good + f" {i}", "good") for i in range(40)] + [(100 + i, "short", "bad") for i in range(60)] + [(200, good, "bad"), (300, "short", "small"), (301, good, "small"), (302, good, None), (303, "short", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_host_verdicts(spark):
    docs = host_docs(spark)
    judged = {r.id: r for r in judge_documents(docs).collect()}
    assert judged[200].host_rejected and not judged[200].kept and not judged[200].base_failed
    assert judged[301].kept and not judged[300].kept  # one of two failed: too little against a host
    assert judged[302].kept and not judged[302].host_rejected and not judged[303].kept
    assert sorted(r.doc_id for r in filter_documents(docs).collect()) == sorted(i for i, r in judged.items() if r.kept)
    assert filter_documents(docs).columns == docs.columns


def test_prior_shrinks_small_hosts(spark):
    hosts = spark.createDataFrame([("a", 1000, 100), ("b", 1000, 120), ("c", 2, 2)], "host string, n long, failed long")
    alpha, beta = beta_prior(hosts)
    assert (2 + alpha) / (2 + alpha + beta) < 0.5
    assert beta_prior(hosts.where("n < 0")) == (1.0, 1.0)


def test_native_plan(spark):
    docs = host_docs(spark)
    for df in (judge_documents(docs), filter_documents(docs), host_verdicts(judge_documents(docs))):
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(odd_docs, no_docs):
    rows = judge_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = Counter(stats(r) for r in rows)
    assert texts == Counter(brute(r.text) for r in odd_docs.collect())
    assert judge_documents(no_docs).count() == 0 and filter_documents(no_docs).count() == 0
    kept = filter_documents(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]

