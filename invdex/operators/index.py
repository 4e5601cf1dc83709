"""Index construction: dictionaries, occurrences, postings, block lists.

Data flow of a build (``build_index``)::

    corpus(block, file, text)
      -> keyed_terms(key, block, file, terms)          row-local: provisional document keys, distinct
                                                       tokens; written once, the text never moves
      -> doc_dict(did, block, file, doc_name)          I1: dense ids from 1, from the names alone
      -> word_dict(term_id, token, df)                 I2: dense ids from 0 by first occurrence
      -> postings(term_id, did)                        A1+A5

Keys become ids where the tokens lie: a map with one row for ``NEIGHBOURS`` keys is
broadcast if it passes the size check. A larger one is met by rows of three numbers:
tokens first become provisional term numbers (checked broadcast of the words,
else salted shuffle join), then (key, dpos, number) rows meet the key map on the
key, which no document makes heavy, and the term ids on the number, salted.

Every id is a pure function of the corpus, so rebuilding, merging blocks or
growing the index block by block gives the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codecs import invert_batches, run_batches, run_rows, segment_batches
from ..functions.text import distinct_tokens, doc_name, tokens
from ..session import stored
from .ids import dense_ids
from .skew import is_small, salted_join

# Fixed layout parameter: doc-id segment width for list-shaped tables
# (block lists, merged lists, codecs). seg = (did - 1) div SEGMENT.
SEGMENT = 64
# Largest dictionary that the tokens of all postings meet by broadcast.
DICT_BROADCAST = 500_000
# Neighbouring keys that are one row of a packed map.
NEIGHBOURS = 1024


def seg_of(did_col: str = "did", seg_width: int = SEGMENT):
    """Segment number of a doc id: (did - 1) div seg_width."""
    return F.expr(f"({did_col} - 1) div {int(seg_width)}")


def keyed_terms(corpus: DataFrame) -> DataFrame:
    """(key, block, file, terms): every document under a provisional key, with
    its distinct tokens in order of first occurrence. Built row by row in the
    scan's own tasks and written, which fixes the keys."""
    return stored(corpus.select(F.monotonically_increasing_id().alias("key"), "block", "file",
                                distinct_tokens("text").alias("terms")), "doc-terms")


def keyed_docs(corpus: DataFrame, start: int = 1) -> DataFrame:
    """I1 + P2 with the provisional keys of ``keyed_terms``, if there are any."""
    cols = [c for c in ("block", "file", "key") if c in corpus.columns]
    return dense_ids(corpus.select(*cols), cols, "did", start=start).select(
        "did", "block", "file", doc_name("block", "file").alias("doc_name"), *cols[2:])


def doc_dict(corpus: DataFrame) -> DataFrame:
    """I1 + P2: ``did`` from 1 in (block, file) byte order; ``doc_name``."""
    return keyed_docs(corpus).drop("key")


def name_order(docs: DataFrame) -> DataFrame:
    """Q7 + Q8: (did, name_rank), rank from 1 in byte order of the names (equal
    names by did). Results are then ordered by numbers; only here names are sorted."""
    return dense_ids(docs.select("did", "doc_name"), ["doc_name", "did"], "name_rank", start=1).select("did", "name_rank")


def check_keys(docs: DataFrame) -> None:
    """Documents must have unique, non-null (block, file) keys; a clear error
    instead of lost or doubled postings."""
    bad = (docs.groupBy("block", "file").agg(F.count(F.lit(1)).alias("n"))
           .where("n > 1 OR block IS NULL OR file IS NULL").limit(1).collect())
    if bad:
        raise ValueError(f"document key is null or not unique: block={bad[0]['block']!r}, file={bad[0]['file']!r}")


def swap_keys(rows: DataFrame, docs: DataFrame, key: list[str], small: bool | None = None) -> DataFrame:
    """Narrow ``rows`` with the columns ``key`` replaced by ``did``. The map is
    broadcast if its size allows, else shuffled; no document is a hot key."""
    ids = docs.select(*key, "did")
    if small is None:
        small = is_small(ids)
    return rows.join(F.broadcast(ids) if small else ids, key).drop(*key)


def packed(docs: DataFrame, key: str, value: str) -> DataFrame | None:
    """The map key -> value (numbers, a key once) with one row for NEIGHBOURS keys:
    (_chunk, _from, _vals), ``_vals`` from the key ``_from`` on. Its rows and bytes are
    then a fraction of the documents'. None where it is too large to broadcast or keys
    are missing in between."""
    rows = docs.select(F.expr(f"{key} div {NEIGHBOURS}").alias("_chunk"), F.struct(F.col(key).alias("k"), F.col(value).alias("v")).alias("_kv"))
    lists = rows.groupBy("_chunk").agg(F.array_sort(F.collect_list("_kv")).alias("_kvs"))
    out = stored(lists.select("_chunk", F.element_at("_kvs", 1)["k"].alias("_from"), F.element_at("_kvs", -1)["k"].alias("_to"),
                              F.col("_kvs.v").alias("_vals")), "packed-map")
    gaps = out.where("_chunk IS NULL OR _to - _from + 1 <> size(_vals)").limit(1).count()
    return out.drop("_to") if not gaps and is_small(out) else None


def look_up(rows: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` with ``value`` of their ``key`` from a ``packed`` map, by broadcast; rows
    whose key it lacks are dropped."""
    met = rows.withColumn("_chunk", F.expr(f"{key} div {NEIGHBOURS}")).join(F.broadcast(table), "_chunk")
    met = met.withColumn(value, F.get("_vals", (F.col(key) - F.col("_from")).cast("int"))).drop("_chunk", "_from", "_vals")
    return met.where(F.col(value).isNotNull())


def token_positions(corpus: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per token occurrence: (did, pos, token), pos from 0. Tokenised
    in the scan's tasks; only (block, file, pos, token) rows meet the ids."""
    rows = corpus.select("block", "file", F.posexplode(tokens("text")).alias("pos", "token"))
    return swap_keys(rows, docs, ["block", "file"]).select("did", F.col("pos").cast("bigint").alias("pos"), "token")


def doc_terms(keyed: DataFrame) -> DataFrame:
    """Each (key, token) once, with ``dpos`` = rank of its first occurrence
    among the document's distinct tokens."""
    return keyed.select("key", F.posexplode("terms").alias("dpos", "token"))


def word_dict(terms: DataFrame) -> DataFrame:
    """I2 + A6: ``term_id`` from 0 in order of first occurrence (did, position);
    ``df`` = number of documents holding the token.

    The group-by on token is partially aggregated, so a hot token costs one
    row per map task in the shuffle. A token occurs once per document in
    ``terms``, so the first occurrence is (min did, dpos at that did); both
    are fixed-width buffers, which keeps the aggregate hash-based."""
    stats = terms.groupBy("token").agg(
        F.min("did").alias("_fdid"),
        F.min_by("dpos", "did").alias("_fpos"),
        F.count(F.lit(1)).alias("df"),
    )
    return dense_ids(stats, ["_fdid", "_fpos"], "term_id", start=0).select("term_id", "token", "df")


def attach_term_ids(rows: DataFrame, words: DataFrame, spread_col: str = "did") -> DataFrame:
    """A1: replace ``token`` by ``term_id``.

    A dictionary whose rows and bytes pass the checks is broadcast,
    so the postings are not shuffled at all; a larger one is joined by a
    shuffle join whose heaviest tokens are salted."""
    w = words.select("token", "term_id", "df")
    if _broadcast_dict(w):
        return rows.join(F.broadcast(w.drop("df")), "token")
    return salted_join(rows, w, "token", "df", spread_col).drop("df")


def _broadcast_dict(w: DataFrame) -> bool:
    return is_small(w) and w.limit(DICT_BROADCAST + 1).count() <= DICT_BROADCAST


def postings(docs: DataFrame, words: DataFrame) -> DataFrame:
    """A5: the whole index in long form, (term_id, did), each pair once, from (did,
    terms); a task's rows in order of term_id. Tokens are first gathered in the scan's
    tasks, batch by batch, so that a token moves once for all its documents there; what
    is joined, shuffled and sorted are these coded runs, not postings."""
    w = words.select("token", "term_id", "df")
    runs = docs.select("did", "terms").mapInArrow(invert_batches, "token string, first bigint, n bigint, vb binary")
    if _broadcast_dict(w):
        runs = runs.join(F.broadcast(w.drop("df")), "token")
    else:
        runs = salted_join(runs, w, "token", "df", "first")
    return _in_term_order(runs)


def _in_term_order(runs: DataFrame) -> DataFrame:
    """(term_id, did) of coded runs, each task's rows in order of term_id."""
    runs = runs.select("term_id", "first", "n", "vb").sortWithinPartitions("term_id", "first")
    return runs.mapInArrow(run_rows, "term_id bigint, did bigint")


def occurrences(corpus: DataFrame, docs: DataFrame, words: DataFrame) -> DataFrame:
    """A1: every occurrence, duplicates kept: (did, pos, term_id)."""
    return attach_term_ids(token_positions(corpus, docs), words).select("did", "pos", "term_id")


def document_frequency(post: DataFrame) -> DataFrame:
    """A6 from postings: df per term (partially aggregated)."""
    return post.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))


def segment_lists(post: DataFrame, extra_keys: tuple[str, ...] = (), seg_width: int = SEGMENT) -> DataFrame:
    """Postings as sorted arrays keyed by (extra_keys..., term_id, seg).

    A list never holds more than ``seg_width`` ids, so a stop word's list is
    spread over many rows and many tasks instead of one unbounded row."""
    keys = [*extra_keys, "term_id"]
    return (
        post.withColumn("seg", seg_of("did", seg_width))
        .groupBy(*keys, "seg")
        .agg(F.array_sort(F.collect_set("did")).alias("dids"))
    )


def with_blocks(post: DataFrame, docs: DataFrame) -> DataFrame:
    """(block, term_id, did): the postings with their documents' blocks. Blocks are
    numbered, so that the map from ids to blocks is packed and broadcast; one that is too
    large is shuffled."""
    blocks = docs.select("did", "block")
    if not is_small(blocks):
        names = stored(blocks.select("block").distinct().withColumn("_no", F.monotonically_increasing_id()), "block-names")
        if is_small(names):
            numbered = blocks.join(F.broadcast(names), blocks["block"].eqNullSafe(names["block"])).select("did", "_no")
            table = packed(numbered, "did", "_no")
            if table is not None:
                return look_up(post, table, "did", "_no").join(F.broadcast(names), "_no").select("block", "term_id", "did")
    rows = post.join(F.broadcast(blocks) if is_small(blocks) else blocks, "did")
    return rows.select("block", "term_id", "did")


def block_postings(post: DataFrame, docs: DataFrame) -> DataFrame:
    """A3: per block, per term, the sorted distinct doc ids (segmented). The
    postings meet the doc dictionary's (did, block), not the texts; a batch's ids of one
    block and term are one coded run in the shuffle."""
    rows = with_blocks(post, docs).withColumn("_hi", F.expr(f"(did - 1) div {SEGMENT << 16}"))
    runs = rows.select("block", "term_id", "_hi", "did").mapInArrow(
        run_batches(["block", "term_id", "_hi"]), "block string, term_id bigint, _hi bigint, first bigint, n bigint, vb binary")
    dealt = runs.repartition("block", "term_id", "_hi").sortWithinPartitions("block", "term_id", "_hi")
    lists = dealt.mapInArrow(segment_batches(["block", "term_id"], SEGMENT),
                             "block string, term_id bigint, _hi bigint, seg bigint, _prev bigint, _last bigint, dids array<bigint>")
    return lists.select("block", "term_id", "seg", F.array_distinct("dids").alias("dids"))


def merge_blocks(*block_lists: DataFrame) -> DataFrame:
    """A4: merge any number of segmented posting tables into one.

    Same (term_id, seg) in several inputs -> union of their ids, sorted."""
    union = block_lists[0].select("term_id", "seg", "dids")
    for other in block_lists[1:]:
        union = union.unionByName(other.select("term_id", "seg", "dids"))
    return union.groupBy("term_id", "seg").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("dids")))).alias("dids")
    )


def explode_lists(lists: DataFrame) -> DataFrame:
    """Segmented lists back to long form (term_id, did)."""
    return lists.select("term_id", F.explode("dids").alias("did"))


@dataclass
class InvertedIndex:
    doc_dict: DataFrame    # did, block, file, doc_name
    word_dict: DataFrame   # term_id, token, df
    postings: DataFrame    # term_id, did
    corpus: DataFrame | None = None      # block, file, text (a build's input)
    name_order: DataFrame | None = None  # did, name_rank


def _narrow_index(terms: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(word_dict, postings) when the key map is too large to broadcast: tokens
    become provisional numbers before anything is shuffled by document."""
    counted = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    seen = stored(counted.withColumn("term_id", F.monotonically_increasing_id()), "seen-words")  # unique, not dense
    numbered = attach_term_ids(terms, seen, "key").select("key", "dpos", F.col("term_id").alias("_no"))
    rows = stored(swap_keys(numbered, docs, ["key"], small=False), "numbered-postings")
    first = rows.groupBy("_no").agg(F.min("did").alias("_fdid"), F.min_by("dpos", "did").alias("_fpos"))
    words = stored(dense_ids(first.join(seen.withColumnRenamed("term_id", "_no"), "_no"), ["_fdid", "_fpos"], "term_id", start=0)
                   .select("term_id", "token", "df", "_no"), "word-dict")
    ids = words.select("_no", "term_id", "df")
    post = rows.join(F.broadcast(ids), "_no") if is_small(ids) else salted_join(rows, ids, "_no", "df", "did")
    runs = post.select("term_id", "did").mapInArrow(run_batches(["term_id"]), "term_id bigint, first bigint, n bigint, vb binary")
    return words.drop("_no"), _in_term_order(runs)


def build_index(corpus: DataFrame) -> InvertedIndex:
    """A5: the full build in one pass of shuffles (no merge queue). What is read
    twice is written to the shared folder, so a lost executor costs no rebuild."""
    keyed = keyed_terms(corpus)
    docs = keyed_docs(keyed)  # numbered rows are checkpointed
    check_keys(docs)
    ids = packed(docs, "key", "did")
    if ids is not None:
        rows = look_up(keyed.select("key", "terms"), ids, "key", "did").select("did", "terms")
        words = word_dict(rows.select("did", F.posexplode("terms").alias("dpos", "token")))
        post = postings(rows, words)
    else:
        words, post = _narrow_index(doc_terms(keyed), docs)
    docs = docs.drop("key")
    return InvertedIndex(docs, words, post, corpus, name_order(docs))
