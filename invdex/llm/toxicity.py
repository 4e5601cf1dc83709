"""Toxicity scores (operator 5) from class-conditional Kneser-Ney models.

Two models, toxic and ordinary, are counted from labelled rows. An expression
is a word (``A-Z`` lower-cased; ASCII letters, digits and non-ASCII characters);
it is predicted through its stem (first ``STEM`` characters):

    p_c(word) = p_c(stem) * p_c(word | stem)
    p_c(stem)        = (max(n_c(stem) - D, 0) + D * stems_c * q(stem)) / N_c
    p_c(word | stem) = (max(n_c(word) - D, 0) + D * types_c(stem) / types(stem)) / n_c(stem)
    q(stem)          = types(stem) / types

``n_c(word)`` counts the documents of a class that hold the word (its distinct
contexts), ``n_c(stem)`` adds up its words. ``types`` are counted over both
classes together: the two models back off to the same Kneser-Ney continuation
counts, so an expression that is rare in both gets nearly the same likelihood
from either. The log ratio of an expression is ln p_toxic - ln p_ordinary; a word
new to both models backs off to its stem's, a new stem to none. A document's evidence is
the sum over all its words, repeats included, divided by their number. Ratios below
``NEUTRAL``, nearly all chance, count with the weight ``FAINT``.

Every word and stem has its own ratio, in written tables that grow with the
vocabulary. A word's value is its stem's plus what its own differs from that, so a
text's sum takes one value of each word and one of each stem. ``SHARE`` only
divides the work: words and stems with at least this share of all counts (at most
1 / SHARE of each) are broadcast; the others are dealt into parts by their hash, as
packed runs, where those of the texts meet those of the model, and the sums go back to
their block of rows (as in ``lm_score``). So no key stands for a text.

With ``TABLE`` set to a number of hash slots, ``fit`` gives a model of a fixed size instead,
which can be kept and sent whole: strong ratios by expression, and the faint ones of the
words that fall into one slot as their mean (weighted by their counts).

Fitting: all labelled rows with crc32(doc_id) mod 5 <> 0. Models counted on folds 2-4 score fold 1, which fixes the
evidence threshold t with the fewest errors; the final models use folds 1-4.
score = (1 + z / (1 + |z|)) / 2 with z = 4 (x - t) / t: 0.5 at the threshold, 0.1
without evidence, and never so close to 0 or 1 that documents tie.

Defined cases: null, empty or word-less texts have no evidence; without toxic
or without ordinary labels nothing is evidence; an empty table of documents gives
no rows; repeated rows score alike; a null doc_id counts as held out;
``remove_toxic`` keeps every input column, whatever its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.ids import dense_ids
from ..operators.skew import is_small, salted_join
from . import lm_score as L
from . import words as W
from .common import map_text, prepare, shield, table, without, written
from .labelled import count_text, fold, labelled

STEM = 5         # characters
DISCOUNT = 0.75
NEUTRAL = 3.5    # natural-log factor below which an expression is faint
FAINT = 0.001    # weight of faint ratios: they order documents without clear evidence
TABLE = None     # slots of the faint ratios in a model of fixed size; None: every word has its own
SHARE = 1e-6     # of all counts: from here on an expression is broadcast, below it is dealt into parts
PART_COUNTS = 1 << 22  # counts a part stands for
MODEL, ROWS, USES = 0, 1, 2  # kinds of runs, in the order a part reads them
STEMS_BROADCAST = 500_000  # rows of seven numbers each
FLUSH = 1 << 21  # distinct words a task holds before it hands its counts on


def stem_ends(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ends of the first ``STEM`` characters of every word."""
    chars = np.append(np.flatnonzero((buf & 0xC0) != 0x80), np.full(STEM, len(buf)))
    return np.minimum(ends, chars[np.searchsorted(chars, starts) + STEM])


def _hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, stem) hashes."""
    return W.word_hashes(buf, starts, ends, W.FOLD), W.word_hashes(buf, starts, stem_ends(buf, starts, ends), W.FOLD)


def _counter():
    """Per task: (word, stem, toxic and ordinary documents in folds 2-4 and 1)."""
    held: list = []
    size = 0

    def merged():
        word = np.concatenate([h[0] for h in held])
        keys, first, inv = np.unique(word, return_index=True, return_inverse=True)
        stem = np.concatenate([h[1] for h in held])[first]
        n = np.stack([np.bincount(inv, weights=np.concatenate([h[2][k] for h in held]), minlength=len(keys)) for k in range(4)])
        return keys, stem, n

    def out():
        nonlocal held, size
        if held:
            keys, stem, n = merged()
            held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(stem.view(np.int64)), *(pa.array(x.astype(np.int64)) for x in n)],
                names=["word", "stem", "ta", "oa", "tb", "ob"])

    def add(cols):
        nonlocal held, size
        text, y, part = cols
        cls = (np.asarray(part) == 1) * 2 + (np.asarray(y) == 0)
        for i, j, buf, off in W.slices(text.fill_null("")):
            s, e, row = W.spans(buf, off, W.ALNUM)
            if not len(s):
                continue
            word, stem = _hashes(buf, s, e)
            keys, first, inv = np.unique(word, return_index=True, return_inverse=True)
            once = np.unique(row * len(keys) + inv)  # a document counts a word once
            c = cls[i:j][once // len(keys)]
            n = np.bincount(once % len(keys) * 4 + c, minlength=4 * len(keys)).reshape(-1, 4).T
            held.append((keys, stem[first], n))
            size += len(keys)
            if size > FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield from out()

    return add, out


def _ratios(counts: DataFrame, toxic: str, ordinary: str) -> tuple[DataFrame, DataFrame, int] | None:
    """Log ratios of every word (word, n, r: its stem's, llr: its own) and of every stem
    (stem, n, r), and the sum of all counts; None where a class has no words."""
    c = counts.select("word", "stem", F.expr(toxic).alias("t"), F.expr(ordinary).alias("o")).filter("t + o > 0")
    stems = written(c.groupBy("stem").agg(
        F.sum("t").alias("st"), F.sum("o").alias("so"), F.count_if(F.col("t") > 0).alias("kt"),
        F.count_if(F.col("o") > 0).alias("ko"), F.count(F.lit(1)).alias("k")), "tox-stems")
    all_ = stems.agg(F.sum("st"), F.sum("so"), F.count_if(F.col("st") > 0), F.count_if(F.col("so") > 0), F.sum("k")).first()
    nt, no, mt, mo, k = (int(x or 0) for x in all_)
    if not nt or not no:
        return None

    def p_stem(n, total, m):
        return (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * m * F.col("k") / k) / total

    def p_word(n, st, kinds):
        shared = 1.0 / F.col("k")
        return F.when(F.col(st) > 0, (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(kinds) * shared)
                      / F.col(st)).otherwise(shared)

    stems = stems.withColumn("r", F.log(p_stem("st", nt, mt)) - F.log(p_stem("so", no, mo)))
    # a stem can own a large part of the words: broadcast the checked stems, or salt
    small = stems.limit(STEMS_BROADCAST + 1).count() <= STEMS_BROADCAST
    both = c.join(F.broadcast(stems), "stem") if small else salted_join(c, stems, "stem", "k", "word")
    words = both.withColumn("llr", F.col("r") + F.log(p_word("t", "st", "kt")) - F.log(p_word("o", "so", "ko")))
    words = written(words.select("word", F.expr("t + o").alias("n"), "r", "llr"), "tox-ratios")
    return words, stems.select("stem", F.expr("st + so").alias("n"), "r"), nt + no


def _arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two columns (hash, value) as arrays sorted by hash."""
    t = df.toArrow()
    keys = t.column(0).to_numpy().astype(np.int64).view(np.uint64)
    at = np.argsort(keys, kind="stable")
    return keys[at], t.column(1).to_numpy()[at].astype(float)


NONE = np.zeros(0, np.uint64), np.zeros(0)


def _own(ratios: tuple[DataFrame, DataFrame, int] | None, parts: int) -> dict:
    """The model of every expression's own ratio: frequent words and stems as sorted
    numpy arrays, the others as a table (``rare``; None where there are none)."""
    if ratios is None:
        return {"words": NONE, "stems": NONE, "rare": None, "parts": parts}
    words, stems, total = ratios

    def weighed(x):
        return F.when(F.abs(x) >= NEUTRAL, F.col(x)).otherwise(F.col(x) * FAINT)

    words = words.select(F.col("word").alias("h"), F.lit(False).alias("stem"), "n", (weighed("llr") - weighed("r")).alias("value"))
    stems = stems.select(F.col("stem").alias("h"), F.lit(True).alias("stem"), "n", weighed("r").alias("value"))
    often = F.col("n") >= F.lit(SHARE * total)
    rare = words.unionByName(stems).filter(~often) if SHARE * total > 1 else None  # counts are at least 1
    return {"words": _arrays(words.filter(often).select("h", "value")), "stems": _arrays(stems.filter(often).select("h", "value")),
            "rare": rare, "parts": max(parts, total // PART_COUNTS)}


def _table(ratios: tuple[DataFrame, DataFrame, int] | None) -> dict:
    """The model of a fixed size: strong words and stems, as sorted numpy arrays, and
    the table of faint ratios. What is collected is bounded by ``TABLE`` and by the strong
    expressions, each of which several labelled documents of one class hold."""
    faint = np.zeros(TABLE, np.float32)
    if ratios is None:
        return {"words": NONE, "stems": NONE, "faint": faint}
    words, stems, _ = ratios
    strong, heavy = F.abs("r") >= NEUTRAL, F.abs("llr") >= NEUTRAL
    slot = F.pmod("word", F.lit(TABLE)).cast("int").alias("slot")
    seen = words.filter(~heavy).groupBy(slot).agg((F.sum(F.expr("llr * n")) / F.sum("n")).cast("float").alias("llr")).toArrow()
    faint[seen.column(0).to_numpy()] = FAINT * seen.column(1).to_numpy()
    # a known faint word below a strong stem must not fall back to the stem
    words = words.filter(strong | heavy).select("word", F.when(heavy, F.col("llr")).otherwise(F.col("llr") * FAINT).alias("llr"))
    return {"words": _arrays(words), "stems": _arrays(stems.filter(strong).select("stem", "r")), "faint": faint}


class _Slots:
    """Batch function: length-normalised log-likelihood difference by the model of a fixed size."""

    def __init__(self, model):
        self.model = model

    def _find(self, which, h, other):
        keys, vals = self.model[which]
        if not len(keys):
            return other
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, vals[at], other)

    def __call__(self, text):
        out = [np.zeros(0)]
        for i, j, buf, off in W.slices(text):
            s, e, row = W.spans(buf, off, W.ALNUM)
            word, stem = _hashes(buf, s, e)
            table = self.model["faint"]
            faint = table[(word % np.uint64(len(table))).astype(np.int64)].astype(float)
            llr = self._find("words", word, self._find("stems", stem, faint))
            n = np.bincount(row, minlength=j - i)
            out.append(np.bincount(row, llr, minlength=j - i) / np.maximum(n, 1))
        return [np.concatenate(out)]


def _stem_key(stem: np.ndarray) -> np.ndarray:
    """Keys of stems among those of words (a short word is its own stem)."""
    return W.mix(stem + np.uint64(1))


def _known(text: pa.Array, model: dict) -> Iterator[tuple]:
    """Per slice of texts: its rows (i, j), their numbers of words, their sums of broadcast
    values, and (key, row - i) of the words and stems that aren't broadcast."""
    for i, j, buf, off in W.slices(text):
        s, e, row = W.spans(buf, off, W.ALNUM)
        sums, others = np.zeros(j - i), []
        for which, h in zip(("words", "stems"), _hashes(buf, s, e)):
            keys, vals = model[which]
            at, known = L._found(keys, h)
            sums += np.bincount(row[known], vals[at[known]], minlength=j - i)
            others.append((h[~known] if which == "words" else _stem_key(h[~known]), row[~known]))
        key, rows = (np.concatenate(x) for x in zip(*others))
        yield i, j, np.bincount(row, minlength=j - i), sums, key, rows


def _mean(model: dict):
    """Batch function: length-normalised log-likelihood difference, all of the model being broadcast."""
    def run(text):
        return [np.concatenate([np.zeros(0), *(sums / np.maximum(n, 1) for _, _, n, sums, _, _ in _known(text, model))])]

    return run


def _runs(cols: list[np.ndarray], parts: int, kind: int, block: int = 0) -> pa.RecordBatch:
    """Columns (key, ...) as one packed run for each part, sorted by key."""
    part = (cols[0] % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((cols[0], part))
    part, cols = part[order], [x[order] for x in cols]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)
    return L._run_batch([(int(part[a]), kind, block, int(b - a), L._pack([x[a:b] for x in cols])) for a, b in zip(cuts[:-1], cuts[1:])])


def _packed(parts: int):
    """The model's rarer words and stems as runs (key, value)."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            h, stem = b.column("h").to_numpy().astype(np.int64).view(np.uint64), np.asarray(b.column("stem"))
            held.append((np.where(stem, _stem_key(h), h), b.column("value").to_numpy().astype(float)))
            size += len(h)
            if size > L.FLUSH:
                yield _runs([np.concatenate(x) for x in zip(*held)], parts, MODEL)
                held, size = [], 0
        if held:
            yield _runs([np.concatenate(x) for x in zip(*held)], parts, MODEL)

    return run


def _uses(shared, parts: int, kept: list[str]):
    """Documents in blocks: per block one run of its rows (kept columns, words, sums of
    broadcast values), and for each part one run of its other words and stems (key, row in
    the block, times)."""
    def run(batches):
        block, rows, uses, size, at = TaskContext.get().partitionId() << 32, [], [], 0, 0

        def out():
            nonlocal block, rows, uses, size, at
            whole = pa.Table.from_batches(rows).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema) as stream:
                stream.write_table(whole)
            raw = sink.getvalue()
            yield L._run_batch([(block % parts, ROWS, block, at, pa.compress(raw, codec="zstd", asbytes=True) + len(raw).to_bytes(8, "little"))])
            if size:
                yield _runs([np.concatenate(x) for x in zip(*uses)], parts, USES, block)
            block, rows, uses, size, at = block + 1, [], [], 0, 0

        for b in batches:
            for i, j, n, sums, key, row in _known(b.column("text").fill_null(""), shared.value):
                order = np.lexsort((row, key))
                key, row = key[order], row[order]
                if len(key):
                    one = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]))))
                    uses.append((key[one], row[one] + at, np.diff(np.concatenate((one, [len(row)])))))
                    size += len(one)
                made = [pa.array(n.astype(np.int64)), pa.array(sums)]
                rows.append(pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in kept), *made],
                                                       names=[*(f"in{k}" for k in range(len(kept))), "words", "sum"]))
                at += j - i
                if size > L.FLUSH or sum(x.nbytes for x in rows) > L.ROW_BYTES:
                    yield from out()
        if rows:
            yield from out()

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part's texts meet its model, run by run: per block, sums of values by row."""
    part, held, model = None, [], NONE
    for b in batches:
        made = []
        for p, kind, block, n, run in zip(*(b.column(k).to_pylist() for k in ("part", "kind", "block", "n", "run"))):
            if p != part:
                part, held, model = p, [], NONE
            if kind == MODEL:
                held.append(L._unpack(run, n, [np.uint64, float]))
                continue
            if held:
                key, value = (np.concatenate(x) for x in zip(*held))
                order = np.argsort(key, kind="stable")
                held, model = [], (key[order], value[order])
            if kind == ROWS:
                made.append((p, kind, block, n, run))
                continue
            key, row, times = L._unpack(run, n, [np.uint64, np.int64, np.int64])
            at, known = L._found(model[0], key)
            if known.any():
                doc, inv = np.unique(row[known], return_inverse=True)
                sums = np.bincount(inv, times[known] * model[1][at[known]])
                made.append((p, kind, block, len(doc), L._pack([doc, sums])))
        yield L._run_batch(made)


def _finish(fields: list[str]):
    """A block's rows with the sums of all parts."""
    def run(batches):
        for (_, _, _, _, rows), *sums in L._by("block", batches):
            raw = pa.decompress(rows[:-8], decompressed_size=int.from_bytes(rows[-8:], "little"), codec="zstd")
            t = pa.ipc.open_stream(raw).read_all()
            total = t.column("sum").to_numpy().astype(float)
            for r in sums:
                doc, x = L._unpack(r[4], r[3], [np.int64, float])
                total[doc] += x
            cols = [*t.columns[:-2], pa.array(total / np.maximum(t.column("words").to_numpy(), 1))]
            yield from pa.Table.from_arrays(cols, names=fields).combine_chunks().to_batches(max_chunksize=1 << 14)

    return run


def _evidence(df: DataFrame, model: dict, col: str, keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns, or those in ``keep``) with the evidence of its texts."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast({k: v for k, v in model.items() if k in ("words", "stems", "faint")})
    field = [(col, T.DoubleType())]
    if "faint" in model:
        return map_text(df, "text", field, lambda: _Slots(shared.value), keep)
    if model["rare"] is None:
        return map_text(df, "text", field, lambda: _mean(shared.value), keep)
    parts = model["parts"]
    kept = [f for f in df.schema.fields if f.name.lower() != col.lower() and (keep is None or f.name in keep)]
    names = [f.name for f in kept]
    uses = df.select(*[f"`{c}`" for c in dict.fromkeys([*names, "text"])]).mapInArrow(_uses(shared, parts, names), L.RUN)
    met = (uses.unionByName(model["rare"].mapInArrow(_packed(parts), L.RUN)).repartitionById(parts, F.col("part"))
           .sortWithinPartitions("part", "kind", "block").mapInArrow(_meet, L.RUN))
    out = T.StructType([*kept, T.StructField(col, T.DoubleType())])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(n, "block").sortWithinPartitions("block", "kind", "part").mapInArrow(_finish(out.names), out)


def best_threshold(x: np.ndarray, y: np.ndarray) -> float:
    """Positive threshold with the fewest errors (toxic above it); between equal
    ones the middle. 1.0 where nothing is above zero."""
    at = np.argsort(x, kind="stable")
    x, y = x[at], y[at]
    cuts = np.flatnonzero(np.diff(x) > 0) + 1
    cuts = cuts[x[cuts] > 0]
    if not len(cuts):
        return 1.0
    wrong = np.array([(y[k:] == 0).sum() + (y[:k] == 1).sum() for k in cuts]) if len(cuts) < 50 else (
        (y == 0).sum() - np.cumsum(np.concatenate(([0], y == 0)))[cuts] + np.cumsum(np.concatenate(([0], y == 1)))[cuts])
    best = cuts[wrong == wrong.min()]
    k = int(best[len(best) // 2])
    return float((max(x[k - 1], 0.0) + x[k]) / 2)


def fitted_threshold(seen: DataFrame) -> float:
    """``best_threshold`` of all rows (x, y), counted by Spark: errors at every cut are
    running sums over ranges of x plus the sums of the ranges before."""
    n = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = (seen.groupBy("x").agg(F.count_if(F.col("y") == 0).alias("zeros"), F.count_if(F.col("y") == 1).alias("ones"))
          .repartitionByRange(n, "x").withColumn("part", F.spark_partition_id()))
    at = written(at, "tox-cuts")  # fixes the ranges
    ranges = at.groupBy("part").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.max("x").alias("last"))
    by_part = Window.orderBy("part")  # one row per range
    back = by_part.rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.select("part", F.sum("zeros").over(back).alias("_z"), F.sum("ones").over(back).alias("_o"), F.lag("last").over(by_part).alias("_x"))
    inside = Window.partitionBy("part").orderBy("x")
    back = inside.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0)
    cuts = at.join(F.broadcast(before), "part").select(
        "x", F.coalesce(F.lag("x").over(inside), "_x").alias("prev"),
        (F.coalesce(F.sum("ones").over(back), none) + F.coalesce("_o", none)
         - F.coalesce(F.sum("zeros").over(back), none) - F.coalesce("_z", none)).alias("wrong"))  # but for a constant
    cuts = written(cuts.filter("prev IS NOT NULL AND x > 0"), "tox-errors")
    least = cuts.agg(F.min("wrong")).first()[0]
    if least is None:
        return 1.0
    best = cuts.filter(F.col("wrong") == least)
    k = best.count() // 2
    row = dense_ids(best, ["x"], "_at").filter(F.col("_at") == k).first()
    return float((max(row["prev"], 0.0) + row["x"]) / 2)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict, float]:
    """(model, threshold) from all labelled rows of ``docs`` outside fold 0."""
    prepare(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def model(toxic, ordinary):
        ratios = _ratios(counts, toxic, ordinary)
        return _table(ratios) if TABLE else _own(ratios, parts)

    chosen = labelled(labels.filter(fold() != 0), "toxic")
    mine = docs.select("doc_id", "text")
    if is_small(chosen):
        mine = mine.join(F.broadcast(chosen), "doc_id")
    else:
        mine = written(mine.join(chosen, "doc_id"), "tox-texts")  # read twice, moved once
    counts = written(count_text(mine, ["text", "y", "part"], "word bigint, stem bigint, ta bigint, oa bigint, tb bigint, ob bigint", _counter)
                     .groupBy("word", "stem").agg(*[F.sum(c).alias(c) for c in ("ta", "oa", "tb", "ob")]), "tox-counts")
    seen = written(_evidence(mine.filter("part = 1"), model("ta", "oa"), "x", ["y"]).select("x", "y"), "tox-evidence")
    threshold = fitted_threshold(seen)
    return model("ta + tb", "oa + ob"), threshold


def score(docs: DataFrame, model: dict, threshold: float, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns, or those in ``keep``) with ``score`` (0 to 1) and ``predicted``."""
    out = _evidence(without(docs, ["score", "predicted"]), model, "_evidence", keep)
    z = F.lit(4.0) * (F.col("_evidence") - threshold) / threshold
    return (out.withColumn("score", (1.0 + z / (1.0 + F.abs(z))) / 2.0)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("_evidence"))


def remove_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (same columns) without those predicted toxic."""
    model, threshold = fit(docs, labels)
    own, back = shield(docs, ["score", "predicted", "_evidence"])
    return score(own, model, threshold).filter("predicted = 0").select(*own.columns).withColumnsRenamed(back)


def q_op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by models of the labelled ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score(docs.select("doc_id", "text"), *fit(docs, labels), keep=["doc_id"])
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")
