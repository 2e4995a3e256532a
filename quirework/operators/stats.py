"""Run statistics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.functions.text import duration as took

__all__ = ["decision_counts", "latency", "per_document", "ratio", "run_stats", "section_counts", "throughput", "took"]


def ratio(a, b):
    return F.when(b == 0, 0.0).otherwise(a / b)


def decision_counts(results: DataFrame, by: str = "decision") -> DataFrame:
    return results.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def latency(results: DataFrame, wall_seconds: float) -> DataFrame:
    """Sum and mean of the latencies, and their sum over the wall clock."""
    total = F.coalesce(F.sum("duration_seconds"), F.lit(0.0))
    return results.agg(total.alias("total_seconds"), F.avg("duration_seconds").alias("mean_seconds"), (total / F.lit(float(wall_seconds) or 1.0)).alias("parallelism"))


def section_counts(chapters: DataFrame, sections: DataFrame, warnings: DataFrame) -> DataFrame:
    """Per document: chapters, sections of either level, notes, warnings."""
    c = chapters.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chapters"))
    s = sections.groupBy("doc_id").agg(F.count_if(F.col("section_level") == 2).alias("n_h2"), F.count_if(F.col("section_level") == 3).alias("n_h3"), F.sum(F.size("notes")).cast("long").alias("n_notes"))
    w = warnings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_warnings"))
    return c.join(s, "doc_id", "left").join(w, "doc_id", "left").na.fill(0, ["n_h2", "n_h3", "n_notes", "n_warnings"])


def run_stats(generated: DataFrame, verified: DataFrame) -> DataFrame:
    """One row over all documents: counts by decision, generation rate and pass rate."""
    g = generated.agg(*(F.count_if(F.col("decision") == d).alias(f"n_{d}") for d in ("generate", "skip", "error")))
    v = verified.agg(*(F.count_if(F.col("decision") == d).alias(f"n_{d.lower()}") for d in ("PASS", "FLAG", "ERROR"))).withColumnRenamed("n_error", "n_verify_error")
    x = g.withColumn("_k", F.lit(1)).join(v.withColumn("_k", F.lit(1)), "_k").drop("_k")
    x = x.withColumn("generation_rate", ratio(F.col("n_generate"), F.col("n_generate") + F.col("n_skip") + F.col("n_error")))
    return x.withColumn("pass_rate", ratio(F.col("n_pass"), F.col("n_pass") + F.col("n_flag") + F.col("n_verify_error")))


def per_document(verified: DataFrame) -> DataFrame:
    """Documents by rows, decisions by columns."""
    return verified.groupBy("doc_id").pivot("decision", ["PASS", "FLAG", "ERROR"]).count().na.fill(0)


def throughput(single: DataFrame, batch: DataFrame, single_seconds: float, batch_seconds: float) -> DataFrame:
    """Tokens per second of either run, from rows with n_tokens, and the speedup."""
    rate = lambda df, s, name: df.agg((F.coalesce(F.sum("n_tokens"), F.lit(0)) / F.lit(float(s))).alias(name)).withColumn("_k", F.lit(1))
    x = rate(single, single_seconds, "single_rate").join(rate(batch, batch_seconds, "batch_rate"), "_k").drop("_k")
    return x.withColumn("speedup", ratio(F.col("batch_rate"), F.col("single_rate")))
