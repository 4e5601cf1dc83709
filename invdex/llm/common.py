"""Helpers shared by the operators of this subpackage: session set-up, Arrow
text mapping with all input columns kept, and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path, ship_package

# Words of the contracts, as fixed values: runs of non-space characters (the
# six ASCII white-space characters separate), and runs of letters, digits and
# all non-ASCII characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and package shipped to Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: cuts
    lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns whose (case-insensitive) names a result takes over."""
    taken = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in taken])


def shield(df: DataFrame, used: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with those columns renamed whose (case-insensitive) names an
    operator uses inside, and the renaming that gives them their names back."""
    taken = {n.lower() for n in used}
    hide = {c: f"_input{k}_{c}" for k, c in enumerate(df.columns) if c.lower() in taken}
    return df.withColumnsRenamed(hide), {v: k for k, v in hide.items()}


def map_text(df: DataFrame, text_col: str, fields: list[tuple[str, T.DataType]],
             start: Callable[[], Callable[[pa.Array], list]], keep: list[str] | None = None) -> DataFrame:
    """Append columns computed from ``text_col`` one Arrow batch at a time.

    ``start()`` runs once per task and returns the batch function: string array
    in, one array (or list) per field out. Nulls reach it as empty strings. All
    input columns are kept (or those in ``keep``), except those that share a
    name with a new one."""
    names = {n.lower() for n, _ in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in names and (keep is None or f.name in keep)]
    out = T.StructType(kept + [T.StructField(n, t) for n, t in fields])
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(t) for _, t in fields]
    kept_names = [f.name for f in kept]
    all_names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for b in batches:
            if b.num_rows == 0:
                continue
            text = b.column(text_col)
            if text.null_count:
                text = text.fill_null("")
            made = [x if isinstance(x, pa.Array) and x.type == t else pa.array(x, type=t) for x, t in zip(fn(text), types)]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in kept_names] + made, names=all_names)

    cols = list(dict.fromkeys([*kept_names, text_col]))
    return df.select(*[f"`{c}`" for c in cols]).mapInArrow(run, out)
