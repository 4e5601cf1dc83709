"""Labelled rows for fitting, and task-side counting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5 (null ids: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y, part) of every labelled row. Null ids or labels are left out; a
    doc_id labelled twice counts once, with its larger label. Joins broadcast it only
    after a check of its size."""
    rows = (labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    return rows.withColumn("part", fold())


def count_text(df: DataFrame, cols: list[str], schema: str,
               start: Callable[[], tuple[Callable, Callable]]) -> DataFrame:
    """Fold all batches of a task into counts: ``start()`` gives ``add(columns)``,
    called per batch and yielding full count batches, and ``rest()``, called at
    the end. Columns are Arrow arrays in the order of ``cols``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, rest = start()
        for b in batches:
            if b.num_rows:
                yield from add([b.column(c) for c in cols])
        yield from rest()

    return df.select(*cols).mapInArrow(run, schema)
