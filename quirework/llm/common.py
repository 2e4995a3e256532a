"""Shared helpers: input columns under fixed names, and Arrow batches in slices.

All operators of this subpackage select only the columns they need under names of their
own, so extra input columns, also with clashing names, never matter. Ids are long integers:
other types are cast, and an id that isn't a number fails the job under ANSI rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.sources.scratch import discard, materialize, scratch_dir

__all__ = ["arrow_map", "discard", "free_name", "keyed_text", "materialize", "salted_join", "scratch_dir", "sliced"]

#: Rows that the Python side of an operator handles at once; long texts come in small slices.
SLICE_ROWS = 512


def keyed_text(docs: DataFrame, id_col: str, text_col: str, empty_for_null: bool = True) -> DataFrame:
    """(id, text) under fixed names, id as long, null texts as empty ones on demand."""
    text = docs[text_col].cast("string")
    return docs.select(
        docs[id_col].cast("long").alias("id"),
        (F.coalesce(text, F.lit("")) if empty_for_null else text).alias("text"),
    )


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices, so that a worker's memory follows the slice."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_map(df: DataFrame, per_slice: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` of a function from slice to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, rows):
            yield per_slice(batch)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def salted_join(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int, hot: int = 1000, most: int = 100_000) -> DataFrame:
    """``rows`` joined with ``facts``, which has one row a key and in ``count`` how many rows have it.

    A key of more than ``hot`` rows (or ``total / most``, if that is more) is dealt to as many
    parts as it takes, its facts being copied to each. As the counts add up to ``total`` at most,
    there are at most ``most`` such keys, and their list is broadcast.
    """
    least = max(hot, -(-total // most))
    parts = F.ceil(F.col(count) / least).cast("int")
    many = facts.where(F.col(count) > least).select(key, parts.alias("_parts"))
    left = rows.join(F.broadcast(many), key, "left")
    left = left.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    right = facts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return left.join(right, [key, "_part"]).drop("_part")
