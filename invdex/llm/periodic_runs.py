"""Periodic run detection (operator 13) by internal pattern matching.

A run is a longest stretch of words with smallest period q and length at least
``max(LEAST_WORDS, EXPONENT * q)``. For every length 2^k the text is cut into
dyadic blocks; a block's nearest occurrences in its two neighbouring windows lie
in a progression whose difference is a candidate period:

* Prefix doubling gives each block the range of the suffix array whose suffixes
  start with it (only positions that still share their prefix are sorted again).
* A wavelet tree over the suffix array answers range successor and range
  predecessor for all blocks of all lengths together: the nearest occurrence
  after and before the block. Its levels are built, used and dropped one after
  another, so memory stays linear.
* A run of period q, 2^(k-1) < q <= 2^k, holds at least one whole block of 2^k
  words whose next occurrence on one side is q words away (the run is 4 q long),
  and no block of 2^k >= q words recurs nearer than its smallest period there.
  Occurrences q words apart give stretches in which words q apart are equal;
  overlapping ones are joined, and their ends extended word by word, which takes
  less than one block.

Many documents are searched together: equal words of different documents have
different numbers, so nothing matches across documents. A slice holds whole
documents; a longer one is a slice of its own. There is no shuffle.

``collapsed`` is the text without the repeated part of each run (what follows a
run's first period), its words joined by one space.

Defined cases: null, empty and blank texts have no words, no runs and an empty
``collapsed``; very long texts are read whole; repeated rows are judged alike; an
empty table gives no rows; input columns named like results are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, table, without

LEAST_WORDS = 6
EXPONENT = 4
SLICE_WORDS = 1 << 17

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _blocks(words: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array to the depth needed, blocks): a row per dyadic block that
    occurs again: its start, the ends of its range, and its length's power."""
    n = len(words)
    sa = np.argsort(words, kind="stable")
    new = np.concatenate(([True], words[sa][1:] != words[sa][:-1]))
    lo = np.flatnonzero(new)
    rank, size = np.empty(n, np.int64), np.empty(n, np.int64)
    rank[sa] = np.repeat(lo, np.diff(np.append(lo, n)))
    size[sa] = np.repeat(np.diff(np.append(lo, n)), np.diff(np.append(lo, n)))
    found, k = [], 0
    while True:
        starts = np.arange(0, n - (1 << k) + 1, 1 << k)
        starts = starts[size[starts] > 1]
        found.append(np.stack((starts, rank[starts], rank[starts] + size[starts], np.full(len(starts), k))))
        if (1 << k) >= most:
            break
        active = np.flatnonzero(size > 1)
        if not len(active):
            break
        after = active + (1 << k)
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.lexsort((second, rank[active]))
        a, g, second = active[order], rank[active][order], second[order]
        at = np.arange(len(a))
        new_g = np.concatenate(([True], g[1:] != g[:-1]))
        new_s = new_g | np.concatenate(([True], second[1:] != second[:-1]))
        in_group = at - np.maximum.accumulate(np.where(new_g, at, 0))
        sub = np.flatnonzero(new_s)
        many = np.diff(np.append(sub, len(a)))
        sa[g + in_group] = a
        rank[a] = np.repeat((g + in_group)[sub], many)
        size[a] = np.repeat(many, many)
        k += 1
    return sa, np.concatenate(found, axis=1)


def _wavelet(values: np.ndarray) -> Iterator[tuple[int, np.ndarray, int]]:
    """The levels of a wavelet tree over distinct numbers below their count, from
    the highest bit: (bit, zeros before each place, zeros in all)."""
    now = values
    for bit in range(max(len(values) - 1, 1).bit_length() - 1, -1, -1):
        zero = (now >> bit) & 1 == 0
        before = np.concatenate(([0], np.cumsum(zero)))
        yield bit, before, int(before[-1])
        now = np.concatenate((now[zero], now[~zero]))


def _below(sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many values of ``sa[lo:hi]`` are below ``x``."""
    out = np.zeros(len(lo), np.int64)
    for bit, before, zeros in _wavelet(sa):
        l0, h0 = before[lo], before[hi]
        one = (x >> bit) & 1 == 1
        out += np.where(one, h0 - l0, 0)
        lo, hi = np.where(one, zeros + lo - l0, l0), np.where(one, zeros + hi - h0, h0)
    return out


def _ranked(sa: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The ``k``-th smallest value (from 0) of ``sa[lo:hi]``."""
    out = np.zeros(len(lo), np.int64)
    for bit, before, zeros in _wavelet(sa):
        l0, h0 = before[lo], before[hi]
        one = k >= h0 - l0
        k = np.where(one, k - (h0 - l0), k)
        out += one.astype(np.int64) << bit
        lo, hi = np.where(one, zeros + lo - l0, l0), np.where(one, zeros + hi - h0, h0)
    return out


def _extend(words: np.ndarray, at: np.ndarray, q: np.ndarray, step: int, by: int) -> np.ndarray:
    """Moves each place ``at`` on (``step`` 1 or -1) while the words there and ``q``
    further on are equal; looks at ``by`` places at a time."""
    n, at = len(words), at.copy()
    todo = np.arange(len(at))
    while len(todo):
        j = at[todo, None] + step * np.arange(by)
        far = j + q[todo, None]
        same = (j >= 0) & (far < n)
        same &= words[np.clip(j, 0, n - 1)] == words[np.clip(far, 0, n - 1)]
        moved = np.where(same.all(axis=1), by, np.argmin(same, axis=1))
        at[todo] += step * moved
        todo = todo[moved == by]
    return at


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of the runs in a sequence of numbers, of which
    no run is over ``longest`` words long; sorted by start, then period."""
    none = np.zeros((0, 3), np.int64)
    if longest < LEAST_WORDS:
        return none
    sa, (s, lo, hi, k) = _blocks(words, max(longest // EXPONENT, 1))
    before = _below(sa, lo, hi, s)  # the block itself has this many occurrences before it
    starts, periods, powers = [], [], []
    for there, rank in ((before > 0, before - 1), (before + 1 < hi - lo, before + 1)):
        other = _ranked(sa, lo[there], hi[there], rank[there])
        q, first, power = np.abs(other - s[there]), np.minimum(other, s[there]), k[there]
        near = (q <= 1 << power) & (2 * q > 1 << power)
        starts.append(first[near])
        periods.append(q[near])
        powers.append(power[near])
    a, q, k = np.concatenate(starts), np.concatenate(periods), np.concatenate(powers)
    if not len(a):
        return none
    order = np.lexsort((a, q))
    a, q, k = a[order], q[order], k[order]
    b = a + (1 << k)
    new = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (a[1:] > b[:-1]))))
    a, q, k, b = a[new], q[new], k[new], b[np.append(new[1:], len(b)) - 1]
    for power in np.unique(k):
        m = np.flatnonzero(k == power)
        b[m] = _extend(words, b[m], q[m], 1, 1 << power)
        a[m] = _extend(words, a[m] - 1, q[m], -1, 1 << power) + 1
    length = b - a + q
    long = length >= np.maximum(LEAST_WORDS, EXPONENT * q)
    return np.unique(np.stack((a, q, length), axis=1)[long], axis=0)[:, [0, 2, 1]]


def _slice(docs: list[list[bytes]]) -> tuple[list, list]:
    """(runs, collapsed text) of each document of a slice."""
    seq, first, number = [], [0], 0
    for words in docs:
        known: dict[bytes, int] = {}
        seq += [known.setdefault(w, number + len(known)) for w in words]
        number += len(known)
        first.append(len(seq))
    words, first = np.array(seq, np.int64), np.array(first)
    found = find_runs(words, int(np.diff(first).max(initial=0)))
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, found[:, 0] + found[:, 2], 1)
    np.add.at(drop, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(drop) == 0
    of = np.searchsorted(first, found[:, 0], "right") - 1
    runs: list[list] = [[] for _ in docs]
    for d, (start, length, period) in zip(of.tolist(), found.tolist()):
        runs[d].append({"start": start - int(first[d]), "length": length, "period": period})
    out = [b" ".join(w if not r else [x for x, stay in zip(w, kept[i:j].tolist()) if stay])
           for w, r, i, j in zip(docs, runs, first[:-1], first[1:])]
    return runs, out


def runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period; by start,
    then period) and ``collapsed``. ``rewrite(id, words)`` may change the words
    of a document before it is searched."""
    prepare(docs.sparkSession)
    own = without(docs, ["n_words", "runs", "collapsed"])
    schema = T.StructType(own.schema.fields + [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                                               T.StructField("collapsed", T.StringType())])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def one(batch, i, words):
        found, text = _slice(words)
        cols = [pa.array([len(w) for w in words], pa.int64()), pa.array(found, run_type), pa.array(text, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(batch.slice(i, len(words)).columns + cols, names=schema.names)

    def run(batches):
        for b in batches:
            texts = b.column(text_col).cast(pa.binary())
            ids = b.column(id_col) if rewrite else None
            i, held, size = 0, [], 0
            for j in range(b.num_rows):
                words = (texts[j].as_py() or b"").split()  # ASCII white space, as in the contract
                held.append(rewrite(ids[j].as_py(), words) if rewrite else words)
                size += len(words)
                if size >= slice_words:
                    yield one(b, i, held)
                    i, held, size = j + 1, [], 0
            if held:
                yield one(b, i, held)

    return own.mapInArrow(run, schema)


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The contract's periodic tails: in a tenth of the documents, by crc32 of the
    id, the words repeat from word ``a`` on. A null id plants nothing."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def q_op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, the longest of them, and digests."""
    found = runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=planted)
    key = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(key)
    length, period = -best["l"], best["p"]
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["s"].alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * -array_min(transform(runs, r -> struct(-r.length as l, r.start as s, r.period as p))).l) div "
               "array_min(transform(runs, r -> struct(-r.length as l, r.start as s, r.period as p))).p").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
