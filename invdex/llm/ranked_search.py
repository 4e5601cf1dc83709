"""Ranked lexical search (operator 11): the best documents for each query item.

Hybrid of term-at-a-time and document-at-a-time evaluation over an index that is
partitioned by documents:

1. One scan cuts the documents into blocks and writes, per block, the postings of
   the items' terms (term, position in the block, occurrences) and each
   document's number of terms. The text itself is never shuffled.
2. Document frequencies, N and L are summed over the blocks; they give each
   term's integer weight.
3. An item's short lists (its rarest terms, as long as they hold at most
   ``SHORT_SHARE`` of N together; the rarest always) are summed term at a time
   into accumulators. The ``k``-th best accumulator over all blocks is a lower
   bound of the item's ``k``-th best score.
4. The summed accumulators are then one more iterator beside the item's long
   lists, bounded by its largest sum, as each long list is bounded by its
   largest contribution in the block. Blocks whose bounds together stay below the
   threshold are skipped; elsewhere documents that can still reach it are looked
   up in the long lists, the largest bound first, and leave as soon as what is
   left can't lift them over the threshold. It rises with the documents found.
5. Every task hands on its ``k`` best documents per item; a window over those few
   rows ranks them.

Exact: bounds only skip what cannot be among the ``k`` best, and documents that
tie with the threshold stay. Hashes find the terms, their bytes are compared.
Items are dealt by hash into parts of about ``PART_BYTES`` of terms; each part
is its own broadcast and its own passes.

Defined cases: null, empty or word-less documents aren't counted and never found;
null, empty or word-less items have no rows; equal (item_id, text) rows of the
items are one item, rows that share only the id are ranked each for themselves;
repeated documents are found each; equal scores go by ascending doc_id, null
last; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import words as W
from .common import LOWER, UPPER, prepare, table, written

TOP = 50
SHORT_SHARE = 1 / 8     # of all documents: what an item's short lists hold together
BLOCK_BYTES = 4 << 20   # text of one block (a longer document is a block of its own)
PART_BYTES = 16 << 20   # terms of one broadcast
SMOOTH = 50             # per cent of a document's m that doesn't depend on its length

_BLOCK = "n_docs bigint, n_terms bigint, ids binary, no_id binary, lengths binary, terms binary, sizes binary, pos binary, tf binary"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of every item that has any."""
    found = F.expr(f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), "
                   r"'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)")
    return (items.select("item_id", "text").distinct().select("item_id", "text", F.array_distinct(found).alias("terms"))
            .filter(F.size("terms") > 0))


class _Vocabulary:
    """The terms of one part of the items, found by hash and compared by bytes."""

    def __init__(self, terms: list[bytes]):
        self.size = len(terms)
        buf = np.frombuffer(b" ".join(terms), np.uint8)
        lens = np.array([len(t) for t in terms], np.int64)
        start = np.cumsum(lens + 1) - lens - 1
        h = W.word_hashes(buf, start, start + lens, W.AS_IS)
        self.order = np.argsort(h, kind="stable")
        self.keys, self.buf, self.start, self.lens = h[self.order], buf, start, lens
        # terms of one hash are tried one after another
        self.tries = int(np.max(np.diff(np.flatnonzero(np.concatenate(([True], self.keys[1:] != self.keys[:-1], [True]))))))

    def find(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The term number of every word, or -1."""
        h = W.word_hashes(buf, s, e, W.FOLD)
        out = np.full(len(s), -1, np.int64)
        at = np.searchsorted(self.keys, h)
        for k in range(self.tries):
            slot = np.minimum(at + k, self.size - 1)
            w = np.flatnonzero((out < 0) & (self.keys[slot] == h))
            no = self.order[slot[w]]
            same = self.lens[no] == (e - s)[w]
            w, no = w[same], no[same]
            same = self._equal(buf, s[w], no)
            out[w[same]] = no[same]
        return out

    def _equal(self, buf, s, no, step=1 << 16):
        """Do the words starting at ``s`` have the bytes of the terms ``no``?"""
        ok = np.ones(len(s), bool)
        for a in range(0, len(s), step):
            lens = self.lens[no[a:a + step]]
            first = np.cumsum(lens) - lens
            within = np.arange(int(lens.sum())) - np.repeat(first, lens)
            same = W.FOLD[buf[np.repeat(s[a:a + step], lens) + within]] == self.buf[np.repeat(self.start[no[a:a + step]], lens) + within]
            ok[a:a + step] = np.logical_and.reduceat(same, first)
        return ok


def _blocks(vocabulary):
    """Documents to blocks: lengths of all, and the postings of the vocabulary."""
    def run(batches):
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        for b in batches:
            ids = b.column("doc_id")
            no_id = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, buf, off in W.slices(b.column("text").fill_null(""), BLOCK_BYTES):
                s, e, row = W.spans(buf, off, W.ALNUM)
                n = np.bincount(row, minlength=j - i)
                term = vocabulary.value.find(buf, s, e)
                at = np.flatnonzero(term >= 0)
                # one posting per (term, document), in that order
                key, tf = np.unique(term[at] * (j - i) + row[at], return_counts=True)
                terms, sizes = np.unique(key // (j - i), return_counts=True)
                cols = (ids[i:j], no_id[i:j], n.astype(np.int64), terms.astype(np.int32), sizes.astype(np.int32),
                        (key % (j - i)).astype(np.int32), tf.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])] + [pa.array([x.tobytes()], pa.binary()) for x in cols], names=names)

    return run


def _frequencies(size):
    """Per task: (term, documents); N and L go as the terms -1 and -2."""
    def run(batches):
        df, n, length = np.zeros(size, np.int64), 0, 0
        for b in batches:
            n += sum(b.column("n_docs").to_pylist())
            length += sum(b.column("n_terms").to_pylist())
            for t, k in zip(b.column("terms").to_pylist(), b.column("sizes").to_pylist()):
                df[np.frombuffer(t, np.int32)] += np.frombuffer(k, np.int32)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1, -2], at))), pa.array(np.concatenate(([n, length], df[at])))], names=["term", "n"])

    return run


class _Block:
    """One block's lists with their contributions to scores."""

    def __init__(self, row: dict, model: dict):
        read = lambda c, t: np.frombuffer(row[c], t)
        self.lengths, self.pos = read("lengths", np.int64), read("pos", np.int32).astype(np.int64)
        terms, tf = read("terms", np.int32), read("tf", np.int64)
        self.first = np.concatenate(([0], np.cumsum(read("sizes", np.int32), dtype=np.int64)))
        m = 100 - SMOOTH + (SMOOTH * self.lengths * model["docs"]) // max(model["length"], 1)
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 20 * m[self.pos]) * np.repeat(model["weights"][terms], np.diff(self.first))
        # one entry more, of an absent term: an empty list
        self.most = np.append(np.maximum.reduceat(self.gain, self.first[:-1]) if len(terms) else [], 0).astype(np.int64)
        self.list_of = np.full(len(model["weights"]), len(terms))
        self.list_of[terms] = np.arange(len(terms))

    def lists(self, terms: np.ndarray) -> np.ndarray:
        at = self.list_of[terms]
        return at[at < len(self.most) - 1]

    def accumulate(self, lists: np.ndarray) -> np.ndarray:
        """Term at a time: the summed contributions of whole lists, per document."""
        if not len(lists):
            return np.zeros(len(self.lengths), np.int64)
        cut = [slice(self.first[k], self.first[k + 1]) for k in lists]
        out = np.zeros(len(self.lengths), np.int64)
        np.add.at(out, np.concatenate([self.pos[c] for c in cut]), np.concatenate([self.gain[c] for c in cut]))
        return out

    def best(self, short: np.ndarray, long: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the documents that score ``least`` or more."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        short, long = self.lists(short), self.lists(long)
        rest = int(self.most[long].sum())
        if int(self.most[short].sum()) + rest < least:
            return none
        sums = self.accumulate(short)
        at = np.flatnonzero(sums >= least - rest)
        score = sums[at]
        for k in long[np.argsort(-self.most[long], kind="stable")]:
            if not len(at):
                return none
            rest -= int(self.most[k])
            pos = self.pos[self.first[k]:self.first[k + 1]]
            skip = np.minimum(np.searchsorted(pos, at), len(pos) - 1)
            score = score + np.where(pos[skip] == at, self.gain[self.first[k] + skip], 0)
            stay = score >= least - rest
            at, score = at[stay], score[stay]
        return at, score


def _sums(model, k):
    """Per task and item the ``k`` largest accumulators."""
    def run(batches):
        items = model.value["items"]
        top = [np.zeros(0, np.int64)] * len(items)
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, model.value)
                for no, (short, _) in enumerate(items):
                    lists = block.lists(short)
                    least = top[no][0] if len(top[no]) == k else 0
                    if int(block.most[lists].sum()) <= least:
                        continue
                    sums = block.accumulate(lists)
                    top[no] = np.sort(np.concatenate((top[no], sums[sums > least])))[-k:]
        for no, x in enumerate(top):
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), no)), pa.array(x)], names=["no", "sum"])

    return run


def _found(model, floors, k):
    """Per task and item the ``k`` best documents."""
    def run(batches):
        items = model.value["items"]
        least = floors.value.copy()
        top = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(items)
        for b in batches:
            for row in b.to_pylist():
                block = _Block(row, model.value)
                ids, no_id = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_id"], bool)
                for no, (short, long) in enumerate(items):
                    at, score = block.best(short, long, int(least[no]))
                    if not len(at):
                        continue
                    one = [np.concatenate(x) for x in zip(top[no], (score, ids[at], no_id[at]))]
                    order = np.lexsort((one[1], one[2], -one[0]))[:k]
                    top[no] = tuple(x[order] for x in one)
                    if len(order) == k:
                        least[no] = max(least[no], top[no][0][-1])
        for no, (score, ids, no_id) in enumerate(top):
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), no)), pa.array(ids, mask=no_id), pa.array(score)],
                                                 names=["no", "doc_id", "score"])

    return run


def _part(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """The ranking for the items in ``rows``: (no, rank, doc_id, score)."""
    spark = docs.sparkSession
    terms = sorted({t.encode() for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    vocabulary = spark.sparkContext.broadcast(_Vocabulary(terms))
    blocks = written(docs.mapInArrow(_blocks(vocabulary), _BLOCK), "rank-blocks")
    counted = (blocks.select("n_docs", "n_terms", "terms", "sizes").mapInArrow(_frequencies(len(terms)), "term bigint, n bigint")
               .groupBy("term").agg(F.sum("n").alias("n")).collect())  # one row per term of the part
    n = {r["term"]: r["n"] for r in counted}
    df = np.array([n.get(t, 0) for t in range(len(terms))], np.int64)
    docs_n, length = n.get(-1, 0), n.get(-2, 0)
    weights = np.floor(1000 * np.log((2 * docs_n + 2) / (2 * df + 1))).astype(np.int64)
    items = []
    for r in rows:
        own = np.array(sorted((number[t.encode()] for t in r["terms"]), key=lambda t: (df[t], t)), np.int64)
        short = np.cumsum(df[own]) <= docs_n * SHORT_SHARE
        short[0] = True
        items.append((own[short], own[~short]))
    model = spark.sparkContext.broadcast({"items": items, "weights": weights, "docs": docs_n, "length": length})
    first = Window.partitionBy("no").orderBy(F.desc("sum"))
    sums = blocks.mapInArrow(_sums(model, k), "no bigint, sum bigint").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k)
    floors = np.ones(len(rows), np.int64)  # scores above 0
    for r in sums.filter(F.col("r") == k).collect():  # at most one row per item of the part
        floors[r["no"]] = max(1, r["sum"])
    found = blocks.mapInArrow(_found(model, spark.sparkContext.broadcast(floors), k), "no bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, part_bytes: int = PART_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    prepare(spark)
    terms = written(item_terms(items), "rank-items")
    size = terms.select(F.sum(F.aggregate("terms", F.lit(0), lambda a, t: a + F.octet_length(t) + 32))).first()[0] or 0
    parts = max(1, -(-int(size) // part_bytes))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    id_type = items.schema["item_id"].dataType
    out = None
    for p in range(parts):
        mine = terms if parts == 1 else terms.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p)
        rows = mine.select("item_id", "terms").collect()  # about part_bytes
        if not rows:
            continue
        ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                    T.StructType([T.StructField("no", T.LongType()), T.StructField("item_id", id_type)]))
        one = _part(docs, rows, k).join(F.broadcast(ids), "no").select("item_id", "rank", "doc_id", "score")
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = items.select("item_id").limit(0).selectExpr("item_id", "0 AS rank", "0L AS doc_id", "0L AS score")
    return out


def q_op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS no, item_id, w FROM (SELECT DISTINCT item_id, text, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark)),
it AS (SELECT no, item_id, unnest(w) AS t FROM i),
s AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM it) GROUP BY rid, t),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS wt FROM p, s GROUP BY t, nn),
x AS (SELECT no, item_id, doc_id, rid, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(w) * nn) // ll)))) AS BIGINT) AS score
  FROM it JOIN p USING (t) JOIN f USING (t) JOIN d USING (rid), s GROUP BY no, item_id, doc_id, rid),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
