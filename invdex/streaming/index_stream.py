"""Grow an index from a stream of documents.

Each micro-batch of documents (block, file, text) gets doc ids that continue
after the largest stored one, in (block, file) order; tokens not yet in the
word dictionary get term ids that continue after the largest stored one, in
order of first occurrence. Postings of the batch are appended. When the
micro-batches arrive in ascending (block, file) order - as the reference
processes its blocks - the result equals a batch build of all documents.

State lives in Parquet tables under ``state_dir``: per epoch (``epoch=<id>``)
doc_dict, word_df, postings, runs and a one-row counters table with the next doc
and term ids. Readers use only epochs that have counters (written last). A
replayed epoch reads only earlier epochs and overwrites its own folders, so
replays are harmless. ``stage_corpus`` orders its files by modification time, so
it needs a store that keeps set times (local, HDFS).

The dictionary is a list of runs, newest last. An epoch writes one run,
``word_runs/run=<epoch>``: its new words, merged with the newest runs as long as
those aren't over twice as large, so sizes fall geometrically and about log2(words) runs live
(a word is rewritten about as often). A run is dealt by token hash into folders of
about ``BUCKET_WORDS`` words. An epoch looks its tokens up only in the folders
that their hashes name, so what it reads of the dictionary follows its own
tokens and not the epochs before it. ``runs/epoch=<id>`` lists the live runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import dense_ids
from ..operators.index import (InvertedIndex, attach_term_ids, doc_terms, explode_lists, keyed_docs, keyed_terms, merge_blocks,
                               postings, seg_of, segment_lists, swap_keys)
from ..operators.skew import broadcast_if_small, is_small
from ..session import stored
from ..sources.index_store import read_index, write_index

CORPUS_SCHEMA = "block string, file string, text string"
DOCS = "did bigint, block string, file string, doc_name string"
WORDS = "term_id bigint, token string"
POSTS = "term_id bigint, did bigint"
RUNS = "run bigint, n_words bigint, buckets bigint"
BUCKET_WORDS = 1 << 18
# Above so many folders to look into, the folders aren't listed in the filter.
MAX_BUCKETS_LISTED = 10_000


def stage_corpus(corpus: DataFrame, source_dir: str, num_files: int) -> None:
    """Write a corpus as ``num_files`` files holding ascending, disjoint
    (block, file) ranges, with modification times in the same order, so a
    file source with one file per trigger replays the blocks in order."""
    spark = corpus.sparkSession
    (corpus.repartitionByRange(num_files, "block", "file").sortWithinPartitions("block", "file")
     .write.mode("overwrite").parquet(source_dir))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(source_dir)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    base = 1_000_000_000_000
    for i, p in enumerate(parts):
        fs.setTimes(p, base + i * 1000, -1)


def _exists(spark: SparkSession, path: str) -> bool:
    """Is there a folder at ``path``? Any storage error is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _epochs(spark: SparkSession, state_dir: str, name: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of the committed epochs (those with counters) of a state table."""
    if not _exists(spark, f"{state_dir}/{name}") or not _exists(spark, f"{state_dir}/counters"):
        return spark.createDataFrame([], schema + ", epoch bigint")
    df = spark.read.schema(schema + ", epoch bigint").parquet(f"{state_dir}/{name}")
    if name != "counters":
        done = spark.read.schema("next_did bigint, next_term bigint, epoch bigint").parquet(f"{state_dir}/counters")
        df = df.join(broadcast_if_small(done.select("epoch").distinct()), "epoch", "left_semi")
    return df if before is None else df.where(F.col("epoch") < before)


def _next_ids(spark: SparkSession, state_dir: str, epoch_id: int) -> tuple[int, int]:
    """Next doc id and next term id, from the one-row-per-epoch counters
    table (never from a scan of the growing dictionaries)."""
    counters = _epochs(spark, state_dir, "counters", "next_did bigint, next_term bigint", epoch_id)
    row = counters.agg(F.max("next_did"), F.max("next_term")).first()
    return (int(row[0]) if row[0] is not None else 1, int(row[1]) if row[1] is not None else 0)


def live_runs(spark: SparkSession, state_dir: str, before: int | None = None) -> list:
    """The dictionary's runs after the last committed epoch, oldest first (about
    log2(words) of them)."""
    runs = _epochs(spark, state_dir, "runs", RUNS, before)
    rows = runs.join(F.broadcast(runs.agg(F.max("epoch").alias("epoch"))), "epoch").orderBy("run").collect()
    return [(r["run"], r["n_words"], r["buckets"]) for r in rows]


def _run(spark: SparkSession, state_dir: str, run: int, slots: list[int] | None = None, buckets: int = 1) -> DataFrame:
    """A run's words; only those in the folders that hash slots fall into."""
    df = spark.read.schema(WORDS + ", bucket bigint").parquet(f"{state_dir}/word_runs/run={run}")
    if slots is not None:
        df = df.where(F.col("bucket").isin(sorted({s % buckets for s in slots})))
    return df.select("term_id", "token")


def _all_words(spark: SparkSession, state_dir: str, runs: list) -> DataFrame:
    df = spark.createDataFrame([], WORDS)
    for run, _, _ in runs:
        df = df.unionByName(_run(spark, state_dir, run))
    return df


def known_words(tokens: DataFrame, state_dir: str, runs: list) -> DataFrame:
    """(term_id, token) of those ``tokens`` that the runs hold. Numbers of folders
    are powers of two, so slots of the largest run name the folders of all."""
    spark = tokens.sparkSession
    most = max([b for _, _, b in runs], default=1)
    slots = [r[0] for r in tokens.select(F.pmod(F.xxhash64("token"), F.lit(most))).distinct().limit(MAX_BUCKETS_LISTED + 1).collect()]
    slots = slots if len(slots) <= MAX_BUCKETS_LISTED else None
    df = spark.createDataFrame([], WORDS)
    for run, _, buckets in runs:
        df = df.unionByName(_run(spark, state_dir, run, slots, buckets))
    return df.join(tokens.select("token"), "token", "left_semi").select("term_id", "token")


def _write_run(new_words: DataFrame, n_new: int, state_dir: str, epoch_id: int, runs: list) -> list:
    """Writes the epoch's run, which takes in the newest runs that are at most
    twice as large as what it holds so far; returns the live runs."""
    spark, words, n = new_words.sparkSession, new_words, n_new
    runs = list(runs)
    while runs and runs[-1][1] <= 2 * n:
        run, size, _ = runs.pop()
        words, n = words.unionByName(_run(spark, state_dir, run)), n + size
    if not n:
        return runs
    buckets = 1 << max(0, (n - 1).bit_length() - (BUCKET_WORDS - 1).bit_length())
    parts = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (words.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets))).repartition(parts, "bucket")
     .sortWithinPartitions("bucket", "token").write.mode("overwrite").partitionBy("bucket").parquet(f"{state_dir}/word_runs/run={epoch_id}"))
    return [*runs, (epoch_id, n, buckets)]


def grow(batch: DataFrame, epoch_id: int, state_dir: str) -> None:
    """One epoch: ids for the batch's documents and new words, and its postings."""
    s = batch.sparkSession
    next_did, next_term = _next_ids(s, state_dir, epoch_id)
    runs = live_runs(s, state_dir, epoch_id)
    # tokenised once per epoch and written; the texts don't move
    keyed = keyed_terms(batch)
    docs = stored(keyed_docs(keyed, next_did), "epoch-docs")
    docs.drop("key").write.mode("overwrite").parquet(f"{state_dir}/doc_dict/epoch={epoch_id}")
    terms = swap_keys(doc_terms(keyed), docs, ["key"])
    stats = stored(terms.groupBy("token").agg(
        F.min("did").alias("_fdid"), F.min_by("dpos", "did").alias("_fpos"), F.count(F.lit(1)).alias("df")), "epoch-words")
    known = stored(known_words(stats, state_dir, runs), "known-words")
    fresh = stats.join(known, "token", "left_anti").select("token", "_fdid", "_fpos")
    new_words = stored(dense_ids(fresh, ["_fdid", "_fpos"], "term_id", start=next_term).select("term_id", "token"), "new-words")
    n_new = new_words.count()
    runs = _write_run(new_words, n_new, state_dir, epoch_id, runs)
    s.createDataFrame(runs, RUNS).write.mode("overwrite").parquet(f"{state_dir}/runs/epoch={epoch_id}")
    words_b = known.unionByName(new_words).join(stats.select("token", "df"), "token")
    words_b.select("term_id", "df").write.mode("overwrite").parquet(f"{state_dir}/word_df/epoch={epoch_id}")
    if is_small(docs.select("key", "did")):
        post = postings(swap_keys(keyed.select("key", "terms"), docs, ["key"], small=True), words_b)
    else:
        post = attach_term_ids(terms.select("did", "token"), words_b).select("term_id", "did")
    post.write.mode("overwrite").parquet(f"{state_dir}/postings/epoch={epoch_id}")
    # counters last: an epoch without them is not read, and is replayed
    s.createDataFrame([(next_did + docs.count(), next_term + n_new)], "next_did bigint, next_term bigint") \
        .write.mode("overwrite").parquet(f"{state_dir}/counters/epoch={epoch_id}")


def start_index_stream(spark: SparkSession, source_dir: str, state_dir: str, checkpoint_dir: str,
                       available_now: bool = True, files_per_trigger: int = 1):
    docs = (
        spark.readStream.schema(CORPUS_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(source_dir)
    )
    w = docs.writeStream.foreachBatch(lambda batch, epoch_id: grow(batch, epoch_id, state_dir))
    w = w.option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_stream_index(spark: SparkSession, state_dir: str) -> dict[str, DataFrame]:
    """The committed epochs as one index; ``df`` is summed over the epochs."""
    words = _all_words(spark, state_dir, live_runs(spark, state_dir))
    df = _epochs(spark, state_dir, "word_df", "term_id bigint, df bigint").groupBy("term_id").agg(F.sum("df").alias("df"))
    return {
        "doc_dict": _epochs(spark, state_dir, "doc_dict", DOCS).drop("epoch"),
        "word_dict": words.join(df, "term_id"),
        "postings": _epochs(spark, state_dir, "postings", POSTS).drop("epoch"),
    }


def epoch_lists(spark: SparkSession, state_dir: str) -> DataFrame:
    """A4: the lists of the committed epochs, merged. The postings are dealt once, by
    (term_id, seg), for the epochs' lists and for their merge."""
    post = _epochs(spark, state_dir, "postings", POSTS).repartition("term_id", seg_of())
    return merge_blocks(segment_lists(post, extra_keys=("epoch",)))


def compact(spark: SparkSession, state_dir: str, root: str) -> InvertedIndex:
    """A4: merge the epochs' lists and write them as a stored index (sorted by
    term, so that lookups prune again); returns it opened."""
    t = read_stream_index(spark, state_dir)
    write_index(InvertedIndex(t["doc_dict"], t["word_dict"], explode_lists(epoch_lists(spark, state_dir))), root)
    return read_index(spark, root)
