"""Corpora as ``documents(block string, file string, text string)``.

Two sources:

* a table (the driver's ``documents`` Parquet): ``block = source``,
  ``file = cast(doc_id as string)``;
* a two-level directory tree ``root/<block>/<file>`` (``directory_source``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .directory_source import filesystem, list_corpus, read_directory  # noqa: F401

CORPUS_COLUMNS = ["block", "file", "text"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``documents`` table as a corpus: one block per source."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        F.coalesce("source", F.lit("")).alias("block"),
        F.col("doc_id").cast("string").alias("file"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def file_count(corpus: DataFrame) -> DataFrame:
    """Number of documents (empty ones included)."""
    return corpus.agg(F.count(F.lit(1)).alias("file_count"))


# ---------------------------------------------------------------- directories

def write_directory(corpus: DataFrame, root: str) -> None:
    """A corpus as a two-level directory, one UTF-8 file per document. Tasks
    write the files; a repeated task writes the same bytes again."""
    uri = root if "://" in root or root.startswith("file:") else f"file://{root}"

    def write(batches):
        fs, path = filesystem(uri)
        for pdf in batches:
            for block, file, text in zip(pdf["block"], pdf["file"], pdf["text"]):
                fs.create_dir(f"{path}/{block}", recursive=True)
                with fs.open_output_stream(f"{path}/{block}/{file}", compression=None) as out:
                    out.write(text.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    corpus.select(*CORPUS_COLUMNS).mapInPandas(write, "n bigint").agg(F.sum("n")).collect()


def encode_query_text(queries: DataFrame, encoding: str = "ISO-8859-1") -> DataFrame:
    """Re-express query text the way ``read_directory`` decodes corpus bytes
    (UTF-8 query bytes read as ``encoding``), so terms match byte for byte."""
    return queries.withColumn("query_text", F.decode(F.encode("query_text", "UTF-8"), encoding))
