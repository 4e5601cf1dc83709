"""Quality rules (operator 10).

Base rules count words, symbols, repeated lines and repeated five-word windows.
The method's verdict is a hashed n-gram log-likelihood ratio: words and word
pairs are hashed into ``2 ** BITS`` buckets, two add-one smoothed multinomials
over the buckets are counted (trusted target: labelled quality = 1; raw corpus:
every document), and a document scores the mean log ratio of its n-grams. Every
document is compared with one threshold, deterministically.

The target is counted on all labelled rows with crc32(doc_id) mod 5 <> 0; the
threshold is the exact ``LOSS`` quantile of all trusted rows of the remaining fifth,
so about one trusted text in a thousand is lost.

Repeated windows are found by 64-bit hashes within one text, and the bytes of
their words are compared; should windows with one hash differ, the text's windows
are counted by their words instead.

Defined cases: null, empty and blank texts have no words and fail the base
rules; lines without a word never count; repeated rows are judged alike;
without trusted labels every score is 0 and the base rules decide alone; an empty
table gives no rows; only doc_id and text are read, whatever other columns are
called.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import broadcast_if_small
from . import words as W
from .common import map_text, prepare, table, written
from .labelled import count_text, fold, labelled

BITS = 18
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
LOSS = 0.001

_SYMBOL = W._class(b"#*$%&|<>", True)
_FIELDS = [(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("score", T.DoubleType())]


def _buckets(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and every pair of neighbouring words."""
    pair, at = W.ngrams(h, row, 2)
    b = np.concatenate((h, pair)) >> np.uint64(64 - BITS)
    return b.astype(np.int64), np.concatenate((row, row[at]))


def _counter():
    raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)

    def add(cols):
        text, trusted = cols
        trusted = np.asarray(trusted.fill_null(False))
        for i, j, buf, off in W.slices(text.fill_null("")):
            s, e, row = W.spans(buf, off, W.NOT_SPACE)
            b, r = _buckets(W.word_hashes(buf, s, e, W.AS_IS), row)
            raw[:] += np.bincount(b, minlength=1 << BITS)
            t = trusted[i:j]
            if t.any():
                target[:] += np.bincount(b[t[r]], minlength=1 << BITS)
        return ()

    def rest():
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["b", "raw", "target"])

    return add, rest


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log ratio of each bucket (a table of fixed size)."""
    flagged = docs.select("doc_id", "text").join(trusted.select("doc_id", F.lit(True).alias("trusted")), "doc_id", "left")
    n = (count_text(flagged, ["text", "trusted"], "b int, raw bigint, target bigint", _counter)
         .groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    raw, target = np.ones(1 << BITS), np.ones(1 << BITS)
    at = n.column("b").to_numpy()
    raw[at] += n.column("raw").to_numpy()
    target[at] += n.column("target").to_numpy()
    if target.sum() == 1 << BITS:
        return np.zeros(1 << BITS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


class _Features:
    def __init__(self, ratio):
        self.ratio = ratio

    def __call__(self, text):
        parts = [self._slice(j - i, buf, off) for i, j, buf, off in W.slices(text)]
        return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0)]

    def _slice(self, n, buf, off):
        s, e, row = W.spans(buf, off, W.NOT_SPACE)
        per_row = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
        chars = per_row(((buf & 0xC0) != 0x80) & W.NOT_SPACE[buf])
        symbols = per_row(_SYMBOL[buf])
        dup = np.zeros(n, np.int64)
        for r in np.flatnonzero(per_row(buf == 10)):
            seen: set[bytes] = set()
            for line in buf[off[r]:off[r + 1]].tobytes().split(b"\n"):
                if line in seen:
                    dup[r] += 1
                elif line.strip():
                    seen.add(line)
        h = W.word_hashes(buf, s, e, W.AS_IS)
        win, at = W.ngrams(h, row, WINDOW)
        repeat = np.zeros(len(s) + 1, np.int64)
        if len(win):
            _, first, inv, cnt = np.unique(W.mix(win + row[at].astype(np.uint64)), return_index=True, return_inverse=True, return_counts=True)
            many = cnt[inv] > 1
            again, rep = at[many], at[first[inv[many]]]
            k = np.arange(WINDOW)
            same = W.same_words(buf, s, e, (again[:, None] + k).ravel(), (rep[:, None] + k).ravel()).reshape(-1, WINDOW).all(axis=1)
            same &= row[again] == row[rep]
            if not same.all():
                again = _repeated(buf, s, e, row, np.unique(row[again[~same]]), again)
            np.add.at(repeat, again, 1)
            np.add.at(repeat, again + WINDOW, -1)
        b, r = _buckets(h, row)
        grams = np.bincount(r, minlength=n)
        score = np.bincount(r, self.ratio[b], minlength=n) / np.maximum(grams, 1)
        return (np.bincount(row, minlength=n), chars, symbols, dup,
                np.bincount(row, np.cumsum(repeat)[:-1] > 0, minlength=n).astype(np.int64), score)


def _repeated(buf, s, e, row, rows, again) -> np.ndarray:
    """First words of the repeated windows, those of ``rows`` counted by words."""
    out = [again[~np.isin(row[again], rows)]]
    for r in rows:
        words = np.flatnonzero(row == r)
        text = [buf[s[i]:e[i]].tobytes() for i in words]
        seen: dict[tuple, list] = {}
        for i in range(len(text) - WINDOW + 1):
            seen.setdefault(tuple(text[i:i + WINDOW]), []).append(words[i])
        out.append(np.array([i for x in seen.values() if len(x) > 1 for i in x], np.int64))
    return np.concatenate(out)


def quantile(df: DataFrame, col: str, share: float) -> float | None:
    """Smallest value with at least ``share`` of all rows at or below it, exactly; null
    without rows. Only that share of the values is sorted."""
    n = df.count()
    return df.select(col).orderBy(col).limit(max(1, math.ceil(share * n))).agg(F.max(col)).first()[0]


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base features, ``score``, ``base_failed`` and ``kept``."""
    spark = docs.sparkSession
    prepare(spark)
    good = labelled(labels, "quality").filter("y = 1")
    ratio = log_ratios(docs, broadcast_if_small(good.filter("part <> 0").select("doc_id")))
    shared = spark.sparkContext.broadcast(ratio)
    out = written(map_text(docs.select("doc_id", "text"), "text", _FIELDS, lambda: _Features(shared.value), keep=["doc_id"]), "quality")
    held = (out.select("doc_id", "n_words", "score").join(broadcast_if_small(good.filter("part = 0").select("doc_id")), "doc_id", "left_semi")
            .filter(f"n_words >= {MIN_WORDS}"))
    threshold = quantile(held, "score", LOSS)
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(-1e300 if threshold is None else threshold))))


def q_op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base features and the verdict."""
    return assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
