"""Answer a stream of query batches against an index.

Two sources. A folder of JSON-lines files ``{"query_id": .., "query_text": ..}``
(``start_search_stream``), and a folder of plain text files, one query per line
(``start_line_search``). Each micro-batch is answered by the batch search inside
``foreachBatch`` and written to ``epoch=<id>`` with overwrite, so a replayed epoch
(after a failure) replaces its own output and nothing is duplicated. (A
stream-static join followed by an aggregation would need a watermark in append
mode; the batch search per epoch avoids that.)

A line's id is its file and byte offset: it depends on neither epochs nor
restarts. The stream carries paths and lengths only; files are cut into byte
ranges, and tasks read the lines that start in their range, byte by byte as they
are. ``read_line_results`` numbers the lines from 1 in (file, offset) order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import dense_ids
from ..operators.index import InvertedIndex
from ..operators.search import search
from ..operators.skew import is_small, salted_join
from ..session import ship_package, stored
from ..sources.directory_source import filesystem

QUERY_SCHEMA = "query_id bigint, query_text string"
RESULT_SCHEMA = "query_id bigint, rank bigint, doc_name string"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LINE_SCHEMA = "path string, offset bigint"
LINE_RESULT_SCHEMA = LINE_SCHEMA + ", rank bigint, doc_name string"
SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20


def start_search_stream(spark: SparkSession, ix: InvertedIndex, source_dir: str, sink_dir: str,
                        checkpoint_dir: str, available_now: bool = True, files_per_trigger: int = 1,
                        seek: bool = False):
    queries = (
        spark.readStream.schema(QUERY_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(source_dir)
    )

    def answer(batch: DataFrame, epoch_id: int) -> None:
        res = search(ix.postings, ix.word_dict, ix.doc_dict, batch, seek=seek, order=ix.name_order)
        res.write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    w = queries.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def read_stream_results(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(sink_dir).select(
        F.col("query_id").cast("bigint"), F.col("rank").cast("bigint"), "doc_name"
    )


def lines_between(read: Callable[[int, int], bytes], start: int, end: int, length: int, chunk: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start in [start, end) of a file whose bytes
    ``read(offset, size)`` gives. Lines end at a newline or the file's end."""
    at = max(start - 1, 0)  # the byte before says whether a line starts at ``start``
    held, skip = b"", start > 0
    while at < length:
        piece = read(at + len(held), chunk)
        held += piece
        done = not piece or at + len(held) >= length
        while True:
            cut = held.find(b"\n")
            if cut < 0:
                break
            if not skip:
                if at >= end:
                    return
                yield at, held[:cut]
            skip, at, held = False, at + cut + 1, held[cut + 1:]
        if done:
            if held and not skip and at < end:
                yield at, held
            return
        if not skip and at >= end:
            return


def _read_lines(encoding: str | None):
    """mapInArrow: (path, length, start, end) ranges to (path, offset, query_text)."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                uri = r["path"]
                fs, _ = filesystem(uri)
                path = uri.removeprefix("file:") if uri.startswith("file:") else filesystem(uri)[1]
                rows: list = []
                with fs.open_input_file(path) as fh:
                    for offset, line in lines_between(lambda at, n: fh.read_at(n, at), r["start"], r["end"], r["length"]):  # noqa: B023
                        rows.append((offset, line.decode(encoding or "utf-8", "strict" if encoding else "replace")))
                        if len(rows) == 10_000:
                            yield batch(uri, rows)
                            rows = []
                if rows:
                    yield batch(uri, rows)

    def batch(path, rows):
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array([o for o, _ in rows], pa.int64()),
                                           pa.array([t for _, t in rows], pa.string())], names=["path", "offset", "query_text"])

    return run


def query_line_stream(spark: SparkSession, source_dir: str, files_per_trigger: int = 1, encoding: str | None = None,
                      split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """S8 as a stream: (path, offset, query_text) of every line of the folder's
    files. Contents are not read by the file source itself (column pruning)."""
    ship_package(spark)
    files = (spark.readStream.schema(FILE_SCHEMA).format("binaryFile").option("maxFilesPerTrigger", files_per_trigger)
             .load(source_dir).where("length > 0").select("path", "length"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint"))
    ranges = files.withColumn("start", F.explode(starts)).withColumn("end", F.least(F.col("start") + split_bytes, "length"))
    return ranges.repartition("path", "start").mapInArrow(_read_lines(encoding), LINE_SCHEMA + ", query_text string")


def _with_line(results: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """``results`` joined with one row per line; a line with many results is
    salted when the lines can't be broadcast."""
    if is_small(lines):
        return results.join(F.broadcast(lines), key)
    sizes = results.groupBy(key).agg(F.count(F.lit(1)).alias("_w"))
    return salted_join(results, lines.join(sizes, key), key, "_w", "rank").drop("_w")


def start_line_search(spark: SparkSession, ix: InvertedIndex, source_dir: str, sink_dir: str, checkpoint_dir: str,
                      available_now: bool = True, files_per_trigger: int = 1, seek: bool = False,
                      encoding: str | None = None, split_bytes: int = SPLIT_BYTES):
    def answer(batch: DataFrame, epoch_id: int) -> None:
        lines = stored(batch.withColumn("query_id", F.monotonically_increasing_id()), "query-lines")
        res = search(ix.postings, ix.word_dict, ix.doc_dict, lines.select("query_id", "query_text"), seek=seek, order=ix.name_order)
        out = _with_line(res, lines.select("query_id", *[c.split()[0] for c in LINE_SCHEMA.split(", ")]), "query_id").drop("query_id")
        out.write.mode("overwrite").parquet(f"{sink_dir}/results/epoch={epoch_id}")
        lines.select("path", "offset").write.mode("overwrite").parquet(f"{sink_dir}/lines/epoch={epoch_id}")

    lines = query_line_stream(spark, source_dir, files_per_trigger, encoding, split_bytes)
    w = lines.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()


def read_line_results(spark: SparkSession, sink_dir: str) -> DataFrame:
    """(query_id, rank, doc_name): query_id numbers all lines from 1, blank ones
    included, in (file, offset) order."""
    lines = spark.read.schema(LINE_SCHEMA).parquet(f"{sink_dir}/lines").select("path", "offset")
    key = F.struct("path", "offset").alias("_line")
    numbers = dense_ids(lines, ["path", "offset"], "query_id", start=1).select("query_id", key)
    res = spark.read.schema(LINE_RESULT_SCHEMA).parquet(f"{sink_dir}/results").select(key, "rank", "doc_name")
    return _with_line(res, numbers, "_line").select("query_id", "rank", "doc_name")
