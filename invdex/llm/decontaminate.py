"""Benchmark decontamination (operator 1).

Method: the normalised n-grams of the benchmark form a hash set that is
broadcast; one scan over the documents hashes every token window, windows
whose hash is in the set are verified byte by byte, and the hit words decide
which spans or documents go.

* Words: ``A-Z`` lower-cased, then maximal runs of ASCII letters, digits and
  non-ASCII characters. A benchmark window is ``n`` consecutive words of an
  item; an item with fewer words (but some) is one window.
* The broadcast has a proven bound: windows are dealt by hash into blocks of
  about ``block_bytes``; each block is its own broadcast and its own pass over
  the documents (one pass up to about 32 MB of windows), and the hits of all
  passes are united per document.
* Defined cases: null or empty text has no words and is clean; null, empty or
  word-less items make no window; a null item_id still marks hits but cannot
  be listed; repeated item rows count once; repeated document rows are judged
  each for themselves; an empty benchmark leaves every document clean; input
  columns that share a name with a result column are replaced by it (those
  that remove spans or documents keep every input column).
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import map_text, prepare, shield, table, without, written

N_GRAM = 13          # words per window
HIT_SHARE = 20       # contaminated: 20 * hit words >= words
BLOCK_BYTES = 32 << 20



def benchmark_windows(benchmark: DataFrame, n: int = N_GRAM) -> DataFrame:
    """Distinct (window, item) rows; ``window`` is its words joined by spaces,
    ``size`` its number of words."""
    words = F.expr(r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                   r"'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)")
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words.alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    at = w.withColumn("size", size).withColumn("at", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    return at.select(F.concat_ws(" ", F.slice("w", F.col("at"), F.col("size"))).alias("window"), "size", "item").distinct()


def _blocks(windows: DataFrame, block_bytes: int) -> list[list]:
    """The windows in blocks that are small enough to broadcast."""
    windows = written(windows, "dc-windows")
    total = windows.select(F.sum(F.octet_length("window") + F.octet_length(F.coalesce("item", F.lit(""))) + 64)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for b in range(n):
        part = windows if n == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == b)
        yield part.collect()


def _index(rows: list) -> tuple[dict[int, np.ndarray], dict[bytes, tuple]]:
    """Per window length the sorted hashes; and the windows with their items."""
    items: dict[bytes, set] = {}
    by_size: dict[int, list[bytes]] = {}
    for r in rows:
        key = r["window"].encode()
        if key not in items:
            items[key] = set()
            by_size.setdefault(r["size"], []).append(key)
        if r["item"] is not None:
            items[key].add(r["item"])
    hashes = {}
    for size, keys in sorted(by_size.items()):
        buf = np.frombuffer(b" ".join(keys), np.uint8)
        off = np.concatenate(([0], np.cumsum([len(k) + 1 for k in keys])))
        off[-1] -= 1
        s, e, row = W.spans(buf, off, W.ALNUM)
        h, _ = W.ngrams(W.word_hashes(buf, s, e, W.FOLD), row, size)
        hashes[size] = np.unique(h)
    return hashes, {k: tuple(sorted(v)) for k, v in items.items()}


class _Scan:
    """Batch function: finds the benchmark windows inside the texts."""

    def __init__(self, hashes, items):
        self.items = items
        self.sets = {}
        for size, keys in hashes.items():
            bits = max(16, int(np.ceil(np.log2(len(keys) * 16 + 1))))
            sieve = np.zeros(1 << bits, bool)
            sieve[keys & np.uint64((1 << bits) - 1)] = True
            self.sets[size] = (keys, sieve, np.uint64((1 << bits) - 1))

    def __call__(self, text):
        n_words, hits, items = [], [], []
        for i, j, buf, off in W.slices(text):
            s, e, row = W.spans(buf, off, W.ALNUM)
            n_words.append(np.bincount(row, minlength=j - i))
            hits += [[] for _ in range(j - i)]
            items += [[] for _ in range(j - i)]
            found = self._windows(buf, s, e, row) if self.sets else []
            if not found:
                continue
            mark = np.zeros(len(s) + 1, np.int64)
            per_row: dict[int, set] = {}
            for at, size, ids in found:
                mark[at] += 1
                mark[at + size] -= 1
                per_row.setdefault(int(row[at]), set()).update(ids)
            on = np.cumsum(mark)[:-1] > 0
            # runs of hit words, cut at row ends; byte offsets inside the row
            first = np.flatnonzero(on & ~(np.concatenate(([False], on[:-1])) & np.concatenate(([False], row[1:] == row[:-1]))))
            last = np.flatnonzero(on & ~(np.concatenate((on[1:], [False])) & np.concatenate((row[1:] == row[:-1], [False]))))
            for a, b in zip(first, last):
                r = int(row[a])
                hits[i + r].append((int(a), int(b) + 1, int(s[a] - off[r]), int(e[b] - off[r])))
            starts = np.searchsorted(row, np.arange(j - i))
            for r, ids in per_row.items():
                items[i + r] = sorted(ids)
                hits[i + r] = [(a - int(starts[r]), b - int(starts[r]), x, y) for a, b, x, y in hits[i + r]]
        return np.concatenate(n_words) if n_words else np.zeros(0, np.int64), hits, items

    def _windows(self, buf, s, e, row):
        found = []
        h = W.word_hashes(buf, s, e, W.FOLD)
        acc, most = None, max(self.sets)
        for k in range(1, most + 1):
            if len(h) < k:
                break
            acc = W.mix(h) if k == 1 else W.chain(acc[:len(h) - k + 1], h[k - 1:])
            if k not in self.sets:
                continue
            keys, sieve, mask = self.sets[k]
            at = np.flatnonzero(sieve[acc & mask])
            at = at[(row[at] == row[at + k - 1])]
            pos = np.minimum(np.searchsorted(keys, acc[at]), len(keys) - 1)
            for a in at[keys[pos] == acc[at]]:
                key = b" ".join(W.FOLD[buf[s[x]:e[x]]].tobytes() for x in range(a, a + k))
                if key in self.items:
                    found.append((int(a), k, self.items[key]))
        return found


_RESULTS = ["n_words", "hit_runs", "hit_items", "n_hit", "contaminated"]
_RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first", "end", "byte_start", "byte_end")]))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = N_GRAM, block_bytes: int = BLOCK_BYTES,
         keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_runs`` (runs of hit words: word range and
    byte range) and ``hit_items`` (ids of items with occurring windows)."""
    spark = docs.sparkSession
    prepare(spark)
    fields = [("n_words", T.LongType()), ("hit_runs", _RUN), ("hit_items", T.ArrayType(T.StringType()))]
    cols = None if keep is None else [*keep, "text"]
    out = docs if cols is None else docs.select(*cols)
    out = without(out, [x for x, _ in fields])
    for k, rows in enumerate(_blocks(benchmark_windows(benchmark, n), block_bytes)):
        shared = spark.sparkContext.broadcast(_index(rows))
        one = map_text(out, "text", fields, lambda shared=shared: _Scan(*shared.value))
        if k:  # a later block: unite its hits with those found so far
            before = [F.col(f"_old_{x}") for x, _ in fields[1:]]
            one = map_text(out.withColumnsRenamed({x: f"_old_{x}" for x, _ in fields[1:]}), "text", fields,
                           lambda shared=shared: _Scan(*shared.value))
            one = (one.withColumn("hit_items", F.array_sort(F.array_union("hit_items", before[1])))
                   .withColumn("hit_runs", F.concat("hit_runs", before[0]))
                   .drop(*[f"_old_{x}" for x, _ in fields[1:]]))
            out = written(one, "dc-block")  # bounded memory: one block's worker at a time
        else:
            out = one
    # one pass already gives disjoint sorted runs; those of several may overlap
    return (_merge(out) if k else out).withColumn(
        "n_hit", F.aggregate("hit_runs", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["first"]))


def _merge(df: DataFrame) -> DataFrame:
    """Runs sorted, overlapping and touching ones joined."""
    def step(acc, x):
        end = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(-1).cast("bigint"))
        return F.when(x["first"] > end, F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.try_element_at(acc, F.lit(-1))["first"].alias("first"), F.greatest(end, x["end"]).alias("end"),
                F.try_element_at(acc, F.lit(-1))["byte_start"].alias("byte_start"),
                F.greatest(F.try_element_at(acc, F.lit(-1))["byte_end"], x["byte_end"]).alias("byte_end")))))

    empty = F.expr("cast(array() as array<struct<first:bigint,end:bigint,byte_start:bigint,byte_end:bigint>>)")
    runs = F.when(F.size("hit_runs") < 2, F.col("hit_runs")).otherwise(F.aggregate(F.array_sort("hit_runs"), empty, step))
    return df.withColumn("hit_runs", runs)


def judge(scanned: DataFrame) -> DataFrame:
    """Adds ``contaminated``."""
    return scanned.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words")))


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (same columns) without the contaminated documents."""
    own, back = shield(docs, _RESULTS)
    kept = judge(scan(own, benchmark)).filter(~F.col("contaminated"))
    return kept.select(*own.columns).withColumnsRenamed(back)


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (same columns) with every run of hit words cut from ``text``."""
    own, back = shield(docs, _RESULTS)
    scanned = scan(own, benchmark)
    text = F.encode("text", "UTF-8")
    n = F.size("hit_runs")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("hit_runs", lambda r: r["byte_end"]))
    ends = F.concat(F.transform("hit_runs", lambda r: r["byte_start"]), F.array(F.octet_length("text").cast("bigint")))
    parts = F.transform(F.sequence(F.lit(0), n), lambda k: F.decode(
        F.substring(text, F.get(starts, k).cast("int") + 1, (F.get(ends, k) - F.get(starts, k)).cast("int")), "UTF-8"))
    cut = scanned.withColumn("text", F.when(n == 0, F.col("text")).otherwise(F.concat_ws("", parts)))
    return cut.select(*own.columns).withColumnsRenamed(back)


def q_op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged against the whole benchmark."""
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    out = judge(scan(docs, bench, keep=["doc_id"]))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = """
WITH doc AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM item WHERE len(w) > 0),
pos AS (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM sized),
win AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM pos),
sizes AS (SELECT DISTINCT k FROM win),
cand AS (SELECT rid, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM doc, sizes WHERE len(w) >= k),
hit AS (SELECT rid, c.k, i, win.item_id FROM (SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM cand) c JOIN win ON win.k = c.k AND win.g = c.g),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
