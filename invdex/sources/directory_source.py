"""The two-level directory corpus as a Spark data source.

``write_manifest`` lists the corpus: the driver sees the root's entries (one per
block), tasks list the files of the blocks, sort them by (block, file) and pack
neighbours into partitions of about ``PACK_BYTES``. The manifest stays a written
table. ``CorpusSource`` plans one partition per pack, without the blocks that a
pushed-down filter on ``block`` excludes, and each task reads the manifest rows
of its own pack and then those files. No list of files passes the driver, and
names are never parsed as URIs or globs: hidden names, zero-byte files and names
with ``:``, ``%`` or ``#`` are ordinary files.

Workers need a file system that pyarrow can open for the root's scheme.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ..session import scratch_path, ship_package

PACK_BYTES = 128 << 20
OPEN_COST = 64 << 10     # a file counts as so many bytes more
BATCH_BYTES = 8 << 20    # of contents in one Arrow batch (a larger file is a batch of its own)
CORPUS_SCHEMA = "block string, file string, text string"
MANIFEST_SCHEMA = "block string, file string, size bigint"


def filesystem(uri: str):
    """pyarrow file system and path for a Hadoop-style URI (file:, hdfs:, s3:,
    gs:, ...), used inside Python tasks."""
    from urllib.parse import unquote, urlsplit

    from pyarrow import fs as pafs

    u = urlsplit(uri)
    if u.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(u.path)
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with the scheme and authority of the session's file system."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString().rstrip("/")


def _list_blocks(root: str):
    """mapInArrow: the entries of each block directory."""
    def run(batches):
        from pyarrow import fs as pafs

        fs, base = filesystem(root)
        for b in batches:
            for block in b.column("block").to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{block}", recursive=False))
                cols = ([block] * len(found), [i.base_name for i in found], [int(i.size or 0) for i in found],
                        [i.type == pafs.FileType.Directory for i in found])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.bool_()))],
                                                 names=["block", "file", "size", "is_dir"])

    return run


def list_corpus(spark: SparkSession, root: str) -> DataFrame:
    """(block, file, size) of a two-level corpus, one row per file
    ``root/<block>/<file>``. Raises ValueError on a missing root, a file directly
    in it or a nested directory."""
    from pyarrow import fs as pafs

    uri = qualified(spark, root)
    fs, base = filesystem(uri)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        raise ValueError(f"corpus root does not exist: {root}")
    tops = fs.get_file_info(pafs.FileSelector(base, recursive=False))
    for top in tops:
        if top.type != pafs.FileType.Directory:
            raise ValueError(f"file directly under the corpus root: {top.base_name}")
    if not tops:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    n = max(1, min(len(tops), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    path = scratch_path(spark, "listing")
    (spark.createDataFrame([(t.base_name,) for t in tops], "block string").repartition(n, "block")
     .mapInArrow(_list_blocks(uri), MANIFEST_SCHEMA + ", is_dir boolean").write.parquet(path))
    listing = spark.read.schema(MANIFEST_SCHEMA + ", is_dir boolean").parquet(path)
    nested = listing.where("is_dir").select("block", "file").limit(1).collect()
    if nested:
        raise ValueError(f"nested directory in block {nested[0].block}: {nested[0].file}")
    return listing.drop("is_dir")


def _pack(pack_bytes: int):
    """mapInArrow: sorted files to packs, numbered across partitions."""
    def run(batches):
        no, size = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            packs = []
            for n in b.column("size").to_pylist():
                if size and size + n + OPEN_COST > pack_bytes:
                    no, size = no + 1, 0
                size += n + OPEN_COST
                packs.append(no)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packs, pa.int64())], names=["block", "file", "size", "pack"])

    return run


def write_manifest(spark: SparkSession, root: str, pack_bytes: int = PACK_BYTES) -> str:
    """The folder with ``files`` (block, file, size, pack; in order) and ``packs``
    (one row per pack: its blocks' range and where its rows are)."""
    out = scratch_path(spark, "manifest")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = MANIFEST_SCHEMA + ", pack bigint"
    (list_corpus(spark, root).repartitionByRange(n, "block", "file").sortWithinPartitions("block", "file")
     .mapInArrow(_pack(pack_bytes), schema).write.parquet(f"{out}/files"))
    (spark.read.schema(schema).parquet(f"{out}/files")
     .groupBy("pack").agg(F.min("_metadata.file_path").alias("rows_in"), F.min("block").alias("min_block"), F.max("block").alias("max_block"))
     .write.parquet(f"{out}/packs"))
    return out


def _read_rows(uri: str, columns: list[str] | None = None, filters=None) -> pa.Table:
    import pyarrow.parquet as pq

    fs, path = filesystem(uri)
    return pq.read_table(path, columns=columns, filters=filters, filesystem=fs)


@dataclass
class Pack(InputPartition):
    pack: int
    rows_in: str


class CorpusReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.manifest, self.encoding = options["root"], options["manifest"], options.get("encoding", "ISO-8859-1")
        self.blocks: set | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("block",):
                values = set(f.value) if isinstance(f, In) else {f.value}
                self.blocks = values if self.blocks is None else self.blocks & values
            else:
                yield f

    def partitions(self) -> list[Pack]:
        rows = _read_rows(f"{self.manifest}/packs").to_pylist()
        return [Pack(r["pack"], r["rows_in"]) for r in sorted(rows, key=lambda r: r["pack"])
                if self.blocks is None or any(r["min_block"] <= b <= r["max_block"] for b in self.blocks)]

    def read(self, partition: Pack | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no pack has such a block
            return
        fs, base = filesystem(self.root)
        rows = _read_rows(partition.rows_in, ["block", "file"], [("pack", "==", partition.pack)]).to_pylist()
        held, size = [], 0
        for r in rows:
            if self.blocks is not None and r["block"] not in self.blocks:
                continue
            with fs.open_input_stream(f"{base}/{r['block']}/{r['file']}", compression=None) as fh:
                text = fh.read().decode(self.encoding)
            held.append({**r, "text": text})
            size += len(text)
            if size >= BATCH_BYTES:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.string()) for n in ("block", "file", "text")]))


class CorpusSource(DataSource):
    """Options: ``root`` (URI), ``manifest`` (folder of ``write_manifest``),
    ``encoding``."""

    @classmethod
    def name(cls) -> str:
        return "corpus_directory"

    def schema(self) -> str:
        return CORPUS_SCHEMA

    def reader(self, schema) -> CorpusReader:
        return CorpusReader(dict(self.options))


def read_directory(spark: SparkSession, root: str, encoding: str = "ISO-8859-1", pack_bytes: int = PACK_BYTES) -> DataFrame:
    """A two-level directory corpus as ``documents(block, file, text)``.

    ``encoding='ISO-8859-1'`` (default) maps every byte to one character, so
    tokens are exact byte strings even for invalid UTF-8; read queries with
    the same encoding (``read_query_lines``, ``encode_query_text``)."""
    ship_package(spark)
    manifest = write_manifest(spark, root, pack_bytes)
    if spark.read.parquet(f"{manifest}/packs").isEmpty():
        return spark.createDataFrame([], CORPUS_SCHEMA)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CorpusSource)
    return (spark.read.format(CorpusSource.name()).option("root", qualified(spark, root)).option("manifest", qualified(spark, manifest))
            .option("encoding", encoding).load())
