"""Quality rules with host verdicts, in native DataFrame functions only.

Each document gets text statistics and rule failures. Failures are counted by host, the
host's failure rate is shrunk towards the corpus by an empirical beta prior (moments of the
host rates), and a host whose shrunk rate is above ``max_rate`` is rejected with all of its
documents, if its own rate is above too: the prior alone rejects no host. A small host thus
needs far more evidence against it than a large one.

The statistics cover whole texts and are computed once, row by row without a shuffle, and
written to the shared folder; host counts combine map-side; a host with a third of all
documents is no hot key but in the last join, which carries a few numbers a row and which
AQE broadcasts or splits.

Words are runs outside of space and U+0009-U+000D. Windows of eight words are compared by
64-bit hashes of word hashes; within one text a false match has a chance below 1e-9 even at
a hundred thousand words.

Defined results: a null text has no words and fails; a null host has no verdict, its
documents are judged by themselves; repeated rows count each; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.llm.common import materialize

SPACE = "\\x20\\x09-\\x0D"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 8

#: Rule failures of a document by its statistics; all of them count for the host's rate.
DEFAULT_RULES: Mapping[str, str] = {
    "too_short": "n_words < 20",
    "repeated": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
}
#: The failures that reject a document by itself.
BASE_RULES = ("too_short", "repeated")

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    """The words of a text that isn't null; none for one that is blank."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def text_statistics(docs: DataFrame, text_col: str = "text", host_col: str = "source", **keep: Column) -> DataFrame:
    """(host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) and the
    columns of ``keep``, row by row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    d = docs.select(*(c.alias(k) for k, c in keep.items()), docs[host_col].cast("string").alias("host"), text.alias("t"))
    d = d.select(*keep, "host", "t", words_of(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"))
    hashes = F.transform("w", lambda x: F.xxhash64(x))
    d = d.select(
        *keep,
        "host",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("h"),
    )
    starts = F.when(F.size("h") >= WINDOW, F.sequence(F.lit(1), F.size("h") - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("at", starts)
    d = d.withColumn("win", F.transform("at", lambda i: F.xxhash64(F.slice("h", i, WINDOW)))).drop("h")
    # only texts with a window seen twice go on: their windows sorted, neighbours compared
    again = F.size(F.array_distinct("win")) < F.size("win")
    d = d.withColumn("s", F.when(again, F.sort_array(F.arrays_zip("win", "at")))).drop("win", "at")
    same = lambda a, b: F.coalesce(F.get("s", a)["win"] == F.get("s", b)["win"], F.lit(False))
    twice = F.filter("s", lambda x, j: same(j, j - 1) | same(j, j + 1))
    d = d.withColumn("p", F.when(F.col("s").isNotNull(), F.sort_array(F.transform(twice, lambda x: x["at"])))).drop("s")
    # a window covers its words up to the next window that counts, eight at most
    steps = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW), lambda acc, x: acc + x)
    return d.withColumn("n_repeat_words", F.when(F.col("p").isNull(), F.lit(0)).otherwise(covered).cast("long")).drop("p")


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) by the moments of the host rates of (n, failed) rows, hosts weighted by n.

    One row of sums comes to the driver. Without spread between hosts the prior is as heavy
    as an average host, so that rates move to the corpus rate but evidence still counts.
    """
    rate = F.col("failed") / F.col("n")
    row = hosts.agg(F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * rate * rate).alias("q")).first()
    if not row["n"]:
        return 1.0, 1.0
    mean = row["f"] / row["n"]
    spread = row["q"] / row["n"] - mean * mean
    inner = mean * (1 - mean)
    weight = row["n"] / row["k"]
    if 1e-12 < spread < inner:
        weight = min(weight, inner / spread - 1)
    weight = max(weight, 2.0)
    return max(mean, 1e-6) * weight, max(1 - mean, 1e-6) * weight


def host_verdicts(stats: DataFrame, rules: Mapping[str, str] = DEFAULT_RULES, max_rate: float = 0.8) -> DataFrame:
    """(host, n, failed, one count per rule, shrunk_rate, rejected) for each host that isn't null."""
    flags = [F.expr(x).alias(f"r_{k}") for k, x in rules.items()]
    failed = F.greatest(*(F.coalesce(F.col(f"r_{k}"), F.lit(False)).cast("int") for k in rules), F.lit(0))
    marked = stats.where("host IS NOT NULL").select("host", *flags)
    hosts = marked.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(failed).alias("failed"), *(F.count_if(f"r_{k}").alias(k) for k in rules))
    alpha, beta = beta_prior(hosts)
    shrunk = (F.col("failed") + alpha) / (F.col("n") + (alpha + beta))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("rejected", (F.col("shrunk_rate") > max_rate) & (F.col("failed") > max_rate * F.col("n")))


def _base_failed(rules: Mapping[str, str], base: tuple[str, ...]) -> Column:
    failed = F.lit(False)
    for k in base:
        failed = failed | F.expr(rules[k])
    return failed


def judge_documents(docs: DataFrame, rules: Mapping[str, str] = DEFAULT_RULES, base: tuple[str, ...] = BASE_RULES, max_rate: float = 0.8, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The statistics with base_failed, host_rejected and kept for every row of ``docs``."""
    stats = materialize(text_statistics(docs, text_col, host_col, id=docs[id_col].cast("long")), "hostrules")
    bad = host_verdicts(stats, rules, max_rate).where("rejected").select("host", F.lit(True).alias("host_rejected"))
    out = stats.join(bad, "host", "left").withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    out = out.withColumn("base_failed", _base_failed(rules, base))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


def filter_documents(docs: DataFrame, rules: Mapping[str, str] = DEFAULT_RULES, base: tuple[str, ...] = BASE_RULES, max_rate: float = 0.8, text_col: str = "text", host_col: str = "source", broadcast_hosts: int = 50_000) -> DataFrame:
    """The rows of ``docs`` that are kept, with all columns as they were.

    One pass computes the statistics and writes each row beside them, so texts are looked at
    once. Failures are counted by host from the written numbers; a row then goes by its own
    or by its host's verdict. No text is shuffled: the rejected hosts are written out, counted,
    and broadcast when there are at most ``broadcast_hosts`` of them; more of them are joined.
    """
    rows = text_statistics(docs, text_col, host_col, _row=F.struct(*(docs[c] for c in docs.columns)))
    # a generator in between: else the optimizer would copy the statistics into the verdict,
    # where each element of an array would compute its whole array again
    rows = rows.select("_row", "host", F.inline(F.array(F.struct(*STATISTICS))))
    rows = materialize(rows.withColumn("_base_failed", _base_failed(rules, base)), "hostrules")
    rejected = materialize(host_verdicts(rows, rules, max_rate).where("rejected").select("host"), "badhosts")
    n_bad = rejected.count()
    kept = rows.where("NOT _base_failed")
    if n_bad:
        kept = kept.join(F.broadcast(rejected) if n_bad <= broadcast_hosts else rejected, "host", "left_anti")
    return kept.select("_row.*")
