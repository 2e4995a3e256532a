"""An extension: page tables that arrive as files, classified as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quirework.operators.pages import classify_pages

PAGES = "doc_id long, page_number int, text string"


def page_stream(spark: SparkSession, path: str, schema: str = PAGES, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def classify_stream(pages: DataFrame, out: str, checkpoint: str, once: bool = True, title: str = "") -> StreamingQuery:
    """Classified pages appended to a Parquet table; rows need no state, so any file may come late."""
    w = classify_pages(pages, F.lit(title)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()


def event_windows(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by time window and kind of a stream with ts, event_type and value."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
