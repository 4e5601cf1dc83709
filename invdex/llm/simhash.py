"""SimHash near-duplicates (operator 2).

Fingerprint: ``A-Z`` lower-cased, words are runs of non-space characters, every
three-word shingle (repeats included; fewer words: the whole sequence) is hashed
with XXH64 (seed 42), and a bit is set if over half of the hashes have it.

Links: two fingerprints link at ``max_distance`` (3) or fewer differing bits.
Method: anchor-point covering. Two fingerprints within 3 bits are within 1 bit
on one of their 32-bit halves. The anchors of a half are the words of the
perfect [31,26] Hamming code with one free bit: its covering radius is 1, so
replicating each distinct fingerprint to every anchor within radius 1 + 1 (at
most 17 per half) brings every linked pair together at some anchor. Fingerprints
are compared with all 64 bits per anchor, after equal ones were merged.

Scale: an anchor with more than ``BLOCK`` fingerprints is dealt into blocks and
its block pairs are compared in separate tasks; a task emits a spanning forest
of the links it finds, never the pairs. Components follow from the forests.

Defined cases: null, empty and blank texts have fingerprint zero, linked like
any other; repeated rows share a fingerprint; a null doc_id never names a
component unless no member has an id (then it is null); an empty table gives an
empty result; input columns that clash with result names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import broadcast_if_small
from . import words as W
from .common import map_text, prepare, shield, table, written
from .components import components, forest

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
BLOCK = 2048  # fingerprints of one anchor compared in one go


class _Fingerprint:
    def __call__(self, text):
        out = [self._slice(j - i, buf, off) for i, j, buf, off in W.slices(text)]
        return [pa.array(np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64), pa.int64())]

    def _slice(self, n_rows, buf, off):
        s, e, row = W.spans(buf, off, W.NOT_SPACE)
        fp = np.zeros(n_rows, np.uint64)
        if not len(s):
            return fp
        lens = e - s
        ns = np.cumsum(lens + 1) - lens - 1
        ne = ns + lens
        pos = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        norm = np.full(int(ne[-1]), 32, np.uint8)
        norm[np.repeat(ns, lens) + pos] = W.FOLD[buf[np.repeat(s, lens) + pos]]
        norm = norm.tobytes()
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        count = np.diff(np.concatenate((first, [len(row)])))
        # shingle starts: all but the last two words of a row; short rows: one
        left = np.repeat(first + np.maximum(count - SHINGLE + 1, 1), count) - np.arange(len(row))
        at = np.flatnonzero(left > 0)
        last = np.minimum(at + SHINGLE - 1, np.repeat(first + count - 1, count)[at])
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(norm[a:b], SEED) for a, b in zip(ns[at].tolist(), ne[last].tolist())), np.uint64, len(at))
        r = row[at]
        begin = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        size = np.diff(np.concatenate((begin, [len(r)])))
        votes = np.zeros((len(begin), 64), np.int64)
        step = 1 << 16  # shingles unpacked at a time
        for a in range(0, len(h), step):
            z = min(len(h), a + step)
            bits = np.unpackbits(h[a:z].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            k0, k1 = np.searchsorted(begin, a, "right") - 1, np.searchsorted(begin, z, "left")
            cut = np.maximum(begin[k0:k1], a) - a
            votes[k0:k1] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
        on = (2 * votes > size[:, None]).astype(np.uint8)
        fp[r[begin]] = np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
        return fp


def fingerprints(docs: DataFrame, keep: list[str], out: str = "fp") -> DataFrame:
    """``keep`` columns of ``docs`` and the fingerprint as a bigint."""
    prepare(docs.sparkSession)
    return map_text(docs.select(*dict.fromkeys([*keep, "text"])), "text", [(out, T.LongType())], _Fingerprint, keep=keep)


def _anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fingerprint) for all anchors within two bits on each half."""
    keys, who = [], []
    for half in (0, 1):
        x = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        syn = np.zeros(len(x), np.uint64)
        for p in range(1, 32):
            syn ^= np.where((x >> np.uint64(p - 1)) & np.uint64(1), np.uint64(p), np.uint64(0))
        tag = np.uint64(half << 32)
        bit = lambda p: np.where(p > 0, np.uint64(1) << (np.maximum(p, 1) - np.uint64(1)), np.uint64(0))
        near = x ^ bit(syn)
        flip = np.uint64(1 << 31)
        keys += [near | tag, (near ^ flip) | tag]
        who += [fp, fp]
        odd = syn > 0
        xo, so, fo = x[odd], syn[odd], fp[odd]
        for p in range(1, 32):  # the pairs p < q with p xor q = syndrome
            q = so ^ np.uint64(p)
            ok = q > p
            keys.append((xo ^ np.uint64(1 << (p - 1)) ^ bit(q))[ok] | tag)
            who.append(fo[ok])
    return np.concatenate(keys), np.concatenate(who)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.asarray(b.column("fp").to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
        for i in range(0, len(fp), 20_000):
            key, who = _anchors(fp[i:i + 20_000])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(who.view(np.int64))], names=["anchor", "fp"])


def _compare(max_distance: int):
    """Compare the fingerprints of each group of a partition sorted by group;
    whole groups may cross batches. Emits a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        rest = [none, none, none]
        links = [(none, none)]
        held = 0

        def compare(cols):
            nonlocal links, held
            a, blk, fp = cols
            n = len(a)
            if n < 2:
                return
            new = np.concatenate(([True], (a[1:] != a[:-1]) | (blk[1:] != blk[:-1])))
            first = np.flatnonzero(new)
            end = np.repeat(np.concatenate((first[1:], [n])), np.diff(np.concatenate((first, [n]))))
            at, d = np.arange(n), 1
            u = fp.view(np.uint64)
            while True:
                at = at[end[at] > at + d]
                if not len(at):
                    break
                near = at[np.bitwise_count(u[at] ^ u[at + d]) <= max_distance]
                if len(near):
                    links.append((fp[near], fp[near + d]))
                    held += len(near)
                    if held > 1 << 20:
                        links = [forest(*map(np.concatenate, zip(*links)))]
                        held = len(links[0][0])
                d += 1

        for b in batches:
            cols = [np.concatenate((r, np.asarray(b.column(k).to_numpy(zero_copy_only=False), np.int64)))
                    for r, k in zip(rest, ("anchor", "block", "fp"))]
            if not len(cols[0]):
                continue
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            compare([c[:cut] for c in cols])
            rest = [c[cut:] for c in cols]
        compare(rest)
        x, y = forest(*map(np.concatenate, zip(*links)))
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

    return run


def links(classes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Distinct fingerprints (``fp``) -> edges (a, b) that span all links."""
    if not 0 <= max_distance <= 3:
        raise ValueError("the anchors of this code cover distances up to 3")
    reps = classes.select("fp").mapInArrow(_replicate, "anchor bigint, fp bigint")
    # hot anchors are few; how many blocks each needs is known before any group meets
    hot = written(reps.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
                  .select("anchor", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("blocks")), "sh-hot")
    dealt = (
        reps.join(broadcast_if_small(hot), "anchor", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("anchor", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("block"), "fp")
    )
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "anchor", "block").sortWithinPartitions("anchor", "block")
            .mapInArrow(_compare(max_distance), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, extra: list[str] | None = None, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row per document: ``doc_id``, ``extra`` columns, ``fp``, ``root`` (a
    fingerprint that names its component) and ``component_id`` (smallest doc_id
    reachable over links, itself included)."""
    fps = written(fingerprints(docs, ["doc_id", *(extra or [])]), "sh-fps")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "sh-classes")
    roots = components(links(classes, max_distance))
    # only classes that hold several documents or several fingerprints need a label
    linked = written(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "sh-linked")
    named = linked.withColumn("root", F.coalesce("root", "fp"))
    by_root = written(named.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("members")), "sh-roots")
    label = written(named.join(by_root.filter("members > 1"), "root").select("fp", "root", "component_id"), "sh-labels")
    out = fps.join(broadcast_if_small(label.withColumn("_many", F.lit(True))), "fp", "left")
    out = out.withColumn("component_id", F.when(F.col("_many"), F.col("component_id")).otherwise(F.col("doc_id")))
    return out.withColumn("root", F.coalesce("root", "fp")).drop("_many")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (same columns) with one document of each component: the one with
    the smallest doc_id (ties: smallest row hash; equal rows: one of them)."""
    docs, back = shield(docs, ["_row", "_id"])
    cols = docs.columns
    keyed = docs.withColumn("_row", F.xxhash64(*cols))
    marked = written(near_duplicates(keyed, ["_row"]), "sh-marked")
    groups = marked.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("root")).alias("_null"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id"), F.col("_row"))).alias("w")
    win = groups.agg(best).select("w.doc_id", "w._row")
    rows = written(_counted(marked, win), "sh-rows")
    lost = rows.filter("not win").select("_id", "_row")
    twice = rows.filter("win and n > 1").select("_id", "_row")
    keyed = keyed.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    on = ["_id", "_row"]
    kept = keyed.join(broadcast_if_small(lost), on, "left_anti")
    if not twice.isEmpty():
        again = keyed.join(broadcast_if_small(twice), on, "left_semi").dropDuplicates(on)
        kept = kept.join(broadcast_if_small(twice), on, "left_anti").unionByName(again)
    return kept.select(*cols).withColumnsRenamed(back)


def _counted(marked: DataFrame, win: DataFrame) -> DataFrame:
    """(id, row hash) with its count and whether it wins its component."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id")
    n = marked.select(key, "_row").withColumn("n", F.lit(1)).withColumn("win", F.lit(0))
    w = win.select(key, "_row").withColumn("n", F.lit(0)).withColumn("win", F.lit(1))
    return (n.unionByName(w).groupBy("_id", "_row").agg(F.sum("n").alias("n"), (F.max("win") == 1).alias("win")))


def q_op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
