"""Document fingerprints (operator 12): an improbable-feature digest.

A feature is a window of 64 bytes of the text (UTF-8). Its Shannon entropy falls
into one of 1,001 bins; how rare a bin is among the windows of all documents is
the feature's rank (bins of nearly no entropy come last). In every run of 64
neighbouring windows the rarest one, the leftmost of equals, wins; windows that
win often are the text's improbable features. They are hashed and inserted, five
bits each, into a chain of Bloom filters of 2,048 bits that hold up to 160
distinct features.

The likeness of two digests compares filters by the bits they share, above what
chance would share and a cut-off, relative to the filter's own bits. Each filter
takes its best partner; the mean over all filters of both digests, by their
numbers of features, is the likeness: 1 for equal digests, about 0 for unrelated.

Where it runs: one scan sums the entropy bins (a table of at most 1,001 rows is
broadcast); ``fingerprint`` is a scan too. ``with_next`` compares every document
with the next one and an edited text: narrow (doc_id, hash) keys are sorted into
buckets, and one shuffle brings each bucket's texts, in order, and the first text
of the bucket after it, into a task that holds a few texts at a time.

Defined cases: a null or empty text has no feature and an empty fingerprint; two
empty ones are alike (1), an empty one and another are not (0); a text under 64
bytes is one feature; if no window wins often enough, those that win most often
are taken. Equal texts have equal fingerprints. Rows with equal ids are ordered by
a hash of the text, null ids come first; repeated rows follow each other; a
single document is its own next one; an empty table gives no rows; other columns
are kept by ``fingerprint``, except those named like its result.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import map_text, prepare, table

WIDTH = 64          # bytes of a feature, and windows of a run
WINS = 16           # runs a feature has to win
FILTER_BITS = 2048
FEATURES = 160      # in one filter
HASHES = 5
CUT = 0.3           # of the room above chance: shared bits below it count as chance
DULL = 100          # entropy bins below it are the last choice
SLICE = 1 << 20
BUCKETS = 4         # buckets of neighbouring documents per shuffle partition

_SCALE = 1 << 16
_F = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WIDTH + 1)], np.int64)
_FULL = int(_F[WIDTH])


def entropy_bins(buf: np.ndarray) -> np.ndarray:
    """The entropy bin (0 to 1000) of every window of 64 bytes."""
    n = len(buf)
    if n < WIDTH:
        return np.zeros(0, np.int64)
    # how often a byte occurs among the 63 before it, and after it
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WIDTH):
        same = (buf[d:] == buf[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    gain = _F[1:] - _F[:-1]
    total = np.empty(n - WIDTH + 1, np.int64)
    total[0] = _F[np.bincount(buf[:WIDTH], minlength=256)].sum()
    total[1:] = gain[before[WIDTH:]] - gain[after[:n - WIDTH]]
    # the first 63 bytes of ``before`` and the last of ``after`` aren't used
    return (_FULL - np.cumsum(total)) * 1000 // _FULL


def _histogram(batches):
    """Per task: windows per entropy bin."""
    counts = np.zeros(1001, np.int64)
    for b in batches:
        for _, _, buf, off in W.slices(b.column("text").fill_null(""), SLICE):
            bins = entropy_bins(buf)
            counts += np.bincount(bins[_whole(off, len(bins))], minlength=1001)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bin", "n"])


def _whole(off: np.ndarray, n: int, width: int = WIDTH) -> np.ndarray:
    """Which of ``n`` places start ``width`` places that lie in one row."""
    ok = np.ones(n, bool)
    inner = off[1:-1]
    if len(inner):
        # places less than ``width`` before a row's end, but not before its start
        mark = np.zeros(n + 1, np.int64)
        lo, hi = np.minimum(np.maximum(inner - width + 1, 0), n), np.minimum(inner, n)
        np.add.at(mark, lo, 1)
        np.add.at(mark, hi, -1)
        ok = np.cumsum(mark)[:-1] == 0
    return ok


def rarity(docs: DataFrame) -> np.ndarray:
    """The rank of each entropy bin: 0 for the rarest among all windows of all
    documents; bins below ``DULL`` come last."""
    prepare(docs.sparkSession)
    n = np.zeros(1001, np.int64)
    for r in docs.select("text").mapInArrow(_histogram, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        n[r["bin"]] = r["n"]
    order = np.lexsort((np.arange(1001), n, np.arange(1001) < DULL))
    rank = np.empty(1001, np.int64)
    rank[order] = np.arange(1001)
    return rank


class Digest:
    """Bloom filters with their numbers of features."""

    __slots__ = ("counts", "bits", "text")

    def __init__(self, counts: np.ndarray, bits: np.ndarray):
        self.counts, self.bits = counts, bits
        self.text = ".".join(f"{c}:{base64.b64encode(b.tobytes()).decode()}" for c, b in zip(counts.tolist(), bits))

    @classmethod
    def read(cls, text: str) -> "Digest":
        parts = [p.split(":", 1) for p in text.split(".")] if text else []
        bits = np.frombuffer(b"".join(base64.b64decode(b) for _, b in parts), np.uint8).reshape(len(parts), FILTER_BITS // 8)
        return cls(np.array([int(c) for c, _ in parts], np.int64), bits)


def _features(buf: np.ndarray, off: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the selected features of each row, in text order."""
    lens = np.diff(off)
    bins = entropy_bins(buf)
    whole = _whole(off, len(bins))
    at = np.arange(len(bins))
    row = np.searchsorted(off, at, "right") - 1 if len(bins) else at
    key = np.where(whole, rank[bins], 1 << 20) << 40 | at
    wins = np.zeros(len(buf), np.int64)
    if len(bins) >= WIDTH:
        best = key.copy()
        for h in (1, 2, 4, 8, 16, 32):
            best = np.minimum(best[:-h], best[h:])
        start = _whole(off, len(best), 2 * WIDTH - 1)
        wins += np.bincount(best[start] & ((1 << 40) - 1), minlength=len(buf))
    # rows with less than 64 windows are one run
    few = np.flatnonzero((lens >= WIDTH) & (lens < 2 * WIDTH - 1))
    if len(few):
        first = off[few]
        cut = np.stack((first, first + lens[few] - WIDTH + 1), axis=1).ravel()
        cut_key = np.append(key, 0)
        wins[np.minimum.reduceat(cut_key, cut)[::2] & ((1 << 40) - 1)] += 1
    tiny = off[:-1][(lens > 0) & (lens < WIDTH)]
    wins[tiny] = 1
    sel = np.flatnonzero(wins)
    if not len(sel):
        return sel, np.zeros(0, np.uint64)
    r = np.searchsorted(off, sel, "right") - 1
    # rows without text share their offset with the next one: the last of them owns it
    most = np.zeros(len(lens), np.int64)
    np.maximum.at(most, r, wins[sel])
    stay = wins[sel] >= np.minimum(WINS, most[r])
    sel, r = sel[stay], r[stay]
    h = _hashes(buf, sel, np.minimum(off[r + 1] - sel, WIDTH))
    order = np.lexsort((sel, h, r))
    o_h, o_r = h[order], r[order]
    once = np.sort(order[np.concatenate(([True], (o_h[1:] != o_h[:-1]) | (o_r[1:] != o_r[:-1])))])
    return r[once], h[once]


def _hashes(buf: np.ndarray, start: np.ndarray, width: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    inside = np.arange(WIDTH)
    for a in range(0, len(start), step):
        s, w = start[a:a + step, None], width[a:a + step, None]
        one = np.where(inside < w, buf[np.minimum(s + inside, len(buf) - 1)], 0).astype(np.uint8)
        words = np.ascontiguousarray(one).view("<u8")
        acc = W.mix(width[a:a + step].astype(np.uint64))
        for k in range(words.shape[1]):
            acc = W.chain(acc, words[:, k])
        out[a:a + step] = acc
    return out


def digests(texts: pa.Array, rank: np.ndarray) -> list[Digest]:
    """The digest of every text of an array without nulls."""
    out = []
    for i, j, buf, off in W.slices(texts, SLICE):
        row, h = _features(buf, off, rank)
        n = np.bincount(row, minlength=j - i)
        first = np.cumsum(n) - n
        chain = -(-n // FEATURES)  # filters of each row
        base = np.cumsum(chain) - chain
        no = base[row] + (np.arange(len(row)) - first[row]) // FEATURES
        total = int(chain.sum())
        counts = np.bincount(no, minlength=total)
        bits = np.zeros((total, FILTER_BITS), bool)
        for k in range(HASHES):
            bits[no, ((h >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        packed = np.packbits(bits, axis=1)
        out += [Digest(counts[b:b + c], packed[b:b + c]) for b, c in zip(base.tolist(), chain.tolist())]
    return out


def _covered(a: Digest, b: Digest) -> float:
    """Features of ``a`` times the share of their filters' bits found in ``b``."""
    x, y = a.bits.view(np.uint64), b.bits.view(np.uint64)
    size_b = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    total, step = 0.0, max(1, (1 << 14) // len(y))
    for k in range(0, len(x), step):
        one = x[k:k + step]
        size_a = np.bitwise_count(one).sum(axis=1, dtype=np.int64)[:, None]
        shared = np.bitwise_count(one[:, None, :] & y[None, :, :]).sum(axis=2, dtype=np.int64)
        chance = size_a * size_b / FILTER_BITS
        room = np.maximum(size_a - chance, 1e-9)
        score = np.clip((shared - chance - CUT * room) / ((1 - CUT) * room), 0, 1).max(axis=1)
        total += float((score * a.counts[k:k + step]).sum())
    return total


def likeness(a: Digest, b: Digest) -> float:
    """0 (unrelated) to 1 (equal)."""
    if a.text == b.text:
        return 1.0
    if not len(a.counts) or not len(b.counts):
        return 0.0
    return min(1.0, (_covered(a, b) + _covered(b, a)) / float(a.counts.sum() + b.counts.sum()))


def fingerprint(docs: DataFrame, rank: np.ndarray | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs.select(F.col(text_col).alias("text"))) if rank is None else rank)
    return map_text(docs, text_col, [("fingerprint", T.StringType())], lambda: lambda t: [[d.text for d in digests(t, shared.value)]])


def compare(pairs: DataFrame, a: str, b: str, out: str = "near") -> DataFrame:
    """``pairs`` with the likeness of two fingerprint columns (null: null)."""
    prepare(pairs.sparkSession)

    @F.pandas_udf("double")
    def near(x, y):
        return x.combine(y, lambda p, q: None if p is None or q is None else likeness(Digest.read(p), Digest.read(q)))

    return pairs.withColumn(out, near(a, b))


def edited(text: str, after: str) -> str:
    """The contract's edit: the last quarter replaced by the next text's beginning."""
    k = len(text) // 4
    return text[:len(text) - k] + after[:k]


def _key(doc_id, h) -> tuple:
    return (doc_id is not None, doc_id or 0, h)


def _deal(firsts):
    """Rows to their buckets; a bucket's first row goes to the one before too."""
    def run(batches):
        keys = firsts.value
        before = {k: (i - 1) % len(keys) for i, k in enumerate(keys)}
        for b in batches:
            bucket, row, tail = [], [], []
            for i, k in enumerate(map(_key, b.column("doc_id").to_pylist(), b.column("h").to_pylist())):
                bucket.append(max(bisect_right(keys, k) - 1, 0))
                row.append(i)
                tail.append(0)
                if k in before:
                    bucket.append(before[k])
                    row.append(i)
                    tail.append(1)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(tail, pa.int32())] + [b.column(c).take(take) for c in ("doc_id", "h", "text")],
                                             names=["bucket", "tail", "doc_id", "h", "text"])

    return run


_NEXT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double")


def _pair(shared, least=1 << 20):
    """Sorted rows of buckets to the results of every row that has a next one."""
    def flush(rows, rank):
        """Results of all of ``rows`` but the last, which is kept."""
        missing = [r for r in rows if r[4] is None]
        for r, d in zip(missing, digests(pa.array([r[3] for r in missing], pa.string()), rank)):
            r[4] = d
        pairs = [(x, y) for x, y in zip(rows, rows[1:]) if x[0] == y[0] and not x[1]]
        texts = [edited(x[3], y[3]) for x, y in pairs]
        new = digests(pa.array(texts, pa.string()), rank)
        cols = zip(*[(x[2], len(x[3]), hashlib.sha256(t.encode()).hexdigest(), x[4].text, e.text, likeness(x[4], e), likeness(x[4], y[4]))
                     for (x, y), t, e in zip(pairs, texts, new)])
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        cols = list(cols) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in _NEXT.split(", ")])

    def run(batches):
        rank, held, size = shared.value, [], 0
        for b in batches:
            for bucket, tail, doc_id, text in zip(*[b.column(c) for c in ("bucket", "tail", "doc_id", "text")]):
                held.append([bucket.as_py(), tail.as_py(), doc_id.as_py(), text.as_py() or "", None])
                size += len(held[-1][3])
                if size > least:
                    yield flush(held, rank)
                    held, size = held[-1:], 0
        if held:
            yield flush(held, rank)

    return run


def with_next(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likenesses
    to the edited and to the next document (after the last: the first)."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(rarity(docs) if rank is None else rank)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one row per bucket, a number that the session's partitions set
    firsts = (keyed.select("doc_id", "h").repartitionByRange(BUCKETS * n, F.asc_nulls_first("doc_id"), "h").groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min(F.struct("doc_id", "h")).alias("k")).collect())
    firsts = spark.sparkContext.broadcast(sorted({_key(r["k"]["doc_id"], r["k"]["h"]) for r in firsts}))
    dealt = keyed.mapInArrow(_deal(firsts), "bucket bigint, tail int, doc_id bigint, h bigint, text string")
    ordered = dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.asc_nulls_first("doc_id"), "h")
    return ordered.select("bucket", "tail", "doc_id", "text").mapInArrow(_pair(shared), _NEXT)


def q_op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, compared with its edited text's and the next
    document's."""
    return with_next(table(spark, sf_dir, "documents"))
