"""Language-model scoring by cross-entropy difference (operator 6).

Two matched word-bigram models share one vocabulary and one set of bigrams: the
background model is counted on every document, the target model on every trusted
document (labelled quality = 1). A document's score is the mean over its tokens
of loss under the target model minus loss under the background model; lower
means closer to the target.

* Vocabulary and bigrams: every word and every bigram of the corpus, without a
  least count; a word never seen (in other documents) is one unknown word. Their
  counts are written tables, which grow with the corpus.
* Both models: p(w | h) = max(n(hw) - D, 0) / n(h) + rest(h) * p(w) over the
  shared bigrams, and add-one smoothed unigrams p(w); a document starts after a
  start symbol.
* ``MIN_SHARE`` only divides the work: words and bigrams with at least this share
  of all tokens (at most 1 / MIN_SHARE of each) are broadcast, as short word ids
  and ready losses. All other bigrams are dealt into parts, by their context where
  that is not frequent (a part then knows its contexts whole), or else by both words;
  none of them is frequent, so no part is heavy. A part holds about PART_TOKENS tokens.
* What is shuffled are packed runs: bigrams sorted by context and word, their
  columns byte plane by byte plane, compressed. A part's reducer merges counted
  runs, or meets the runs of the documents with those of the model; its sums go
  back to the documents of one block of rows, which travel with their block. So no
  key stands for a text, and copies of one text are rows like all others.

Defined cases: null, empty or blank texts have no tokens and score 0; without
trusted labels the target model is uniform; repeated rows score alike; an empty
table gives an empty result; input columns named like a result column (n_tokens,
loss_target, loss_background, score, selected) give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import broadcast_if_small
from . import words as W
from .common import prepare, table, without, written
from .labelled import count_text

MIN_SHARE = 1e-6  # of all tokens: from here on an entry is broadcast, below it is joined
DISCOUNT = 0.75
THRESHOLD = 0.0  # selected: score at most this
FLUSH = 1 << 20
PART_TOKENS = 1 << 22  # tokens a part stands for
ROW_BYTES = 8 << 20    # of a block's other columns
RUN = "part int, kind int, block bigint, n bigint, run binary"
ROWS, USES, MODEL = 0, 1, 2  # kinds of runs
RESULTS = ["n_tokens", "loss_target", "loss_background", "score", "selected"]


def _pack(cols: list[np.ndarray]) -> bytes:
    """Columns of eight-byte numbers, the first ascending, as one compressed run."""
    cols = [np.diff(cols[0], prepend=cols[0].dtype.type(0)), *cols[1:]]
    planes = [np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes() for x in cols]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(run: bytes, n: int, kinds: list) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(run, decompressed_size=8 * n * len(kinds), codec="zstd"), np.uint8).reshape(len(kinds), 8, n)
    cols = [np.ascontiguousarray(planes[k].T).reshape(-1).view(kind) for k, kind in enumerate(kinds)]
    return [np.cumsum(cols[0]), *cols[1:]]


def _part(c: np.ndarray, w: np.ndarray, parts: int) -> np.ndarray:
    """The part of a bigram: that of its context, or of both where the context is frequent."""
    return (np.where(c < 0, W.mix(c.view(np.uint64)), _key([c, w])) % np.uint64(parts)).astype(np.int64)


def _runs(cols: list[np.ndarray], parts: int, kind: int, block: int = 0) -> pa.RecordBatch:
    """Bigrams (c, w, ...) as one packed run for each part."""
    part = _part(cols[0], cols[1], parts)
    order = np.lexsort((cols[1], cols[0], part))
    part, cols = part[order], [x[order] for x in cols]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)
    made = [(int(part[a]), kind, block, int(b - a), _pack([x[a:b] for x in cols])) for a, b in zip(cuts[:-1], cuts[1:])]
    return _run_batch(made)


def _run_batch(made: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in made], t) for k, t in enumerate(types)],
                                      names=["part", "kind", "block", "n", "run"])


def _by(key: str, batches) -> Iterator[list[tuple]]:
    """Runs sorted by ``key``, one list (part, kind, block, n, run) for each of its values."""
    held, at = [], {"part": 0, "block": 2}[key]
    for b in batches:
        for r in zip(*(b.column(k).to_pylist() for k in ("part", "kind", "block", "n", "run"))):
            if held and held[0][at] != r[at]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _sums(codes_of, parts: int = 0):
    """Per task: (codes, background count, target count) of the codes, one or
    two columns, that ``codes_of(hashes, row)`` makes of each slice; as rows, or
    packed into runs for ``parts``."""
    held: list = []
    size = 0

    def merged():
        cols = [np.concatenate(x) for x in zip(*held)]
        _, first, inv = np.unique(_key(cols[2:]), return_index=True, return_inverse=True)
        return [np.bincount(inv, weights=x, minlength=len(first)) for x in cols[:2]] + [x[first] for x in cols[2:]]

    def out():
        nonlocal held, size
        if held:
            n, t, *codes = merged()
            held, size = [], 0
            if parts:
                yield _runs([*codes, n.astype(np.int64), t.astype(np.int64)], parts, MODEL)
                return
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*codes, n.astype(np.int64), t.astype(np.int64))],
                                             names=["c", "w"][-len(codes):] + ["n", "t"])

    def add(cols):
        nonlocal held, size
        text, trusted = cols
        trusted = np.asarray(trusted.fill_null(False))
        for i, j, buf, off in W.slices(text.fill_null("")):
            s, e, row = W.spans(buf, off, W.ALNUM)
            if not len(s):
                continue
            codes = codes_of(W.word_hashes(buf, s, e, W.FOLD), row)
            _, first, inv = np.unique(_key(codes), return_index=True, return_inverse=True)
            held.append((np.bincount(inv, minlength=len(first)), np.bincount(inv, weights=trusted[i:j][row], minlength=len(first)),
                         *[x[first] for x in codes]))
            size += len(first)
            if size > FLUSH:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield from out()

    return add, out


def _key(codes: list[np.ndarray]) -> np.ndarray:
    """One number for each word or bigram."""
    key = codes[0].view(np.uint64)
    return W.chain(W.mix(key), codes[1].view(np.uint64)) if len(codes) > 1 else key


def _words(vocab: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Codes of words: the position in the (sorted) frequent words, or else the
    hash as a negative number. The start symbol is ``len(vocab)``."""
    other = (h | np.uint64(1 << 63)).view(np.int64)
    if not len(vocab):
        return other
    at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
    return np.where(vocab[at] == h, at, other)


def _pairs(vocab: np.ndarray, h: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """Codes of the context and of the word, for every token."""
    w = _words(vocab, h)
    c = np.concatenate(([len(vocab)], w[:-1]))
    c[np.concatenate(([True], row[1:] != row[:-1]))] = len(vocab)
    return [c, w]


def _coded(vocab):
    """Word hashes of a counts table to codes."""
    def run(batches):
        for b in batches:
            w = _words(vocab.value, b.column("w").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(w), b.column("n"), b.column("t")], names=["w", "un", "ut"])

    return run


def _steps(c: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """Where a new context (or bigram) starts in sorted ones, and the end."""
    new = c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate(([True], new if w is None else new | (w[1:] != w[:-1]), [True])))


def _merge(batches):
    """Counted runs of a part to its bigrams: counts, and those of each context
    that is not frequent (all its bigrams are in this part)."""
    names = ["c", "w", "n", "t", "cn", "ct", "fn", "ft"]
    for rows in _by("part", batches):
        c, w, n, t = (np.concatenate(x) for x in zip(*(_unpack(r[4], r[3], [np.int64] * 4) for r in rows)))
        at = np.lexsort((w, c))
        c, w, n, t = c[at], w[at], n[at], t[at]
        cut = _steps(c, w)[:-1]
        c, w, n, t = c[cut], w[cut], np.add.reduceat(n, cut), np.add.reduceat(t, cut)
        edge = _steps(c)
        first, size = edge[:-1], np.diff(edge)
        own = (np.add.reduceat(x, first) for x in (n, t, np.ones_like(n), (t > 0).astype(np.int64)))
        cols = [c, w, n, t, *(np.where(c < 0, np.repeat(x, size), 0) for x in own)]
        for a in range(0, len(c), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[a:a + (1 << 16)]) for x in cols], names=names)


def _pair_counts(flagged: DataFrame, vocab, parts: int) -> DataFrame:
    runs = count_text(flagged, ["text", "trusted"], RUN, lambda: _sums(lambda h, row: _pairs(vocab.value, h, row), parts))
    return (runs.repartitionById(parts, F.col("part")).sortWithinPartitions("part")
            .mapInArrow(_merge, ", ".join(f"{x} bigint" for x in ("c", "w", "n", "t", "cn", "ct", "fn", "ft"))))


STATS = ["n", "t", "cn", "ct", "fn", "ft", "un", "ut"]


def _known(pairs: DataFrame, model: dict) -> DataFrame:
    """Bigrams with the counts of their contexts and words. Frequent contexts and
    words (c, w >= 0) are at most 1 / MIN_SHARE rows each, hence broadcast; a rare
    word is the key of few rows, so that join needs no salt."""
    words = model["words"]
    often = model["contexts"].withColumnsRenamed({k: f"o_{k}" for k in ("cn", "ct", "fn", "ft")})
    pairs = pairs.join(F.broadcast(often), "c", "left").select(
        "c", "w", "n", "t", *[F.coalesce(f"o_{k}", k).alias(k) for k in ("cn", "ct", "fn", "ft")])
    both = (pairs.filter("w >= 0").join(F.broadcast(words.filter("w >= 0")), "w", "left")
            .unionByName(pairs.filter("w < 0").join(words.filter("w < 0"), "w", "left")))
    return both.select("c", "w", *[F.coalesce(k, F.lit(0).cast("bigint")).alias(k) for k in STATS])


def _losses(cols: list[np.ndarray], size: int, tokens: int, tokens_t: int) -> tuple[np.ndarray, np.ndarray]:
    """Losses under the target and the background model, from columns STATS."""
    n, t, cn, ct, fn, ft, un, ut = (x.astype(float) for x in cols)

    def loss(n, total, kinds, uni, all_):
        most = np.maximum(total, 1)
        rest = np.maximum(1 - (total - DISCOUNT * kinds) / most, 1e-9)
        return -np.log(np.maximum(n - DISCOUNT, 0) / most + rest * (uni + 1) / (all_ + size + 1))

    return loss(t, ct, ft, ut, tokens_t), loss(n, cn, fn, un, tokens)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The two matched models: counts as written tables, and the frequent part
    of the vocabulary and of the bigrams as numpy tables of bounded size."""
    spark = docs.sparkSession
    prepare(spark)
    trusted = labels.filter("doc_id IS NOT NULL AND cast(quality AS int) = 1").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    flagged = docs.select("doc_id", "text").join(broadcast_if_small(trusted), "doc_id", "left")
    words = written(count_text(flagged, ["text", "trusted"], "w bigint, n bigint, t bigint", lambda: _sums(lambda h, row: [h.view(np.int64)]))
                    .groupBy("w").agg(F.sum("n").alias("n"), F.sum("t").alias("t")), "lm-words")
    size, tokens, tokens_t = (int(x or 0) for x in words.agg(F.count(F.lit(1)), F.sum("n"), F.sum("t")).first())
    often = words.filter(F.col("n") >= F.lit(MIN_SHARE * tokens)).select("w").toArrow()
    vocab = np.sort(often.column("w").to_numpy().astype(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(vocab)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // PART_TOKENS)
    pairs = written(_pair_counts(flagged, shared, parts), "lm-pairs")
    contexts = written(pairs.filter("c >= 0").groupBy("c").agg(
        F.sum("n").alias("cn"), F.sum("t").alias("ct"), F.count(F.lit(1)).alias("fn"), F.count_if(F.col("t") > 0).alias("ft")), "lm-contexts")
    model = {"vocab": shared, "contexts": contexts, "size": size, "tokens": tokens, "tokens_t": tokens_t, "parts": parts,
             "pairs": pairs, "words": words.mapInArrow(_coded(shared), "w bigint, un bigint, ut bigint"),
             "often": F.col("n") >= F.lit(MIN_SHARE * tokens)}
    ready = _known(pairs.filter(model["often"]), model).toArrow()
    c, w, *stats = (ready.column(k).to_numpy().astype(np.int64) for k in ("c", "w", *STATS))
    key = _key([c, w])
    at = np.argsort(key, kind="stable")
    model["ready"] = spark.sparkContext.broadcast((key[at], *[x[at] for x in _losses(stats, size, tokens, tokens_t)]))
    return model


def _found(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the frequent bigrams, and which are there."""
    if not len(keys):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return at, keys[at] == key


def _uses(vocab, ready, parts: int, kept: list[str]):
    """Documents in blocks: per block one run of its rows (kept columns, tokens,
    sums of losses over frequent bigrams), and for each part one run of its other
    bigrams (c, w, row in the block, times)."""
    def run(batches):
        block, rows, uses, size, at = TaskContext.get().partitionId() << 32, [], [], 0, 0

        def out():
            nonlocal block, rows, uses, size, at
            whole = pa.Table.from_batches(rows).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema) as stream:
                stream.write_table(whole)
            yield _run_batch([(block % parts, ROWS, block, at, pa.compress(sink.getvalue(), codec="zstd", asbytes=True)
                               + len(sink.getvalue()).to_bytes(8, "little"))])
            if size:
                yield _runs([np.concatenate(x) for x in zip(*uses)], parts, USES, block)
            block, rows, uses, size, at = block + 1, [], [], 0, 0

        for b in batches:
            for i, j, buf, off in W.slices(b.column("text").fill_null("")):
                s, e, row = W.spans(buf, off, W.ALNUM)
                sums = [np.zeros(j - i)] * 2
                if len(s):
                    c, w = _pairs(vocab.value, W.word_hashes(buf, s, e, W.FOLD), row)
                    keys, *losses = ready.value
                    where, known = _found(keys, _key([c, w]))
                    sums = [np.bincount(row[known], x[where[known]], minlength=j - i) for x in losses]
                    c, w, r = c[~known], w[~known], row[~known]
                    order = np.lexsort((w, c, r))
                    c, w, r = c[order], w[order], r[order]
                    one = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (w[1:] != w[:-1]) | (r[1:] != r[:-1])))) if len(r) else order
                    uses.append((c[one], w[one], r[one] + at, np.diff(np.concatenate((one, [len(r)])))))
                    size += len(one)
                made = [pa.array(np.bincount(row, minlength=j - i).astype(np.int64)), *(pa.array(x) for x in sums)]
                rows.append(pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in kept), *made],
                                                       names=[*(f"in{k}" for k in range(len(kept))), "tokens", "t", "b"]))
                at += j - i
                if size > FLUSH or sum(x.nbytes for x in rows) > ROW_BYTES:
                    yield from out()
        if rows:
            yield from out()

    return run


def _packed(parts: int):
    """The model's bigrams as runs."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append([b.column(k).to_numpy().astype(np.int64) for k in ("c", "w", *STATS)])
            size += b.num_rows
            if size > FLUSH:
                yield _runs([np.concatenate(x) for x in zip(*held)], parts, MODEL)
                held, size = [], 0
        if held:
            yield _runs([np.concatenate(x) for x in zip(*held)], parts, MODEL)

    return run


def _meet(size: int, tokens: int, tokens_t: int):
    """A part's documents meet its model: per block, sums of losses by row."""
    def run(batches):
        for rows in _by("part", batches):
            uses, known = [r for r in rows if r[1] == USES], [r for r in rows if r[1] == MODEL]
            through = [r for r in rows if r[1] == ROWS]
            if through:
                yield _run_batch(through)
            if not uses:
                continue
            if not known:
                raise ValueError("documents with bigrams outside the model: score them with fitted=False")
            c, w, *stats = (np.concatenate(x) for x in zip(*(_unpack(r[4], r[3], [np.int64] * (2 + len(STATS))) for r in known)))
            losses = _losses(stats, size, tokens, tokens_t)
            uc, uw, ur, um = (np.concatenate(x) for x in zip(*(_unpack(r[4], r[3], [np.int64] * 4) for r in uses)))
            use = np.repeat([False, True], [len(c), len(uc)])
            c, w = np.concatenate((c, uc)), np.concatenate((w, uw))
            order = np.lexsort((use, w, c))
            edge = _steps(c[order], w[order])
            head = np.repeat(order[edge[:-1]], np.diff(edge))
            mine = use[order]
            if use[head[mine]].any():
                raise ValueError("documents with bigrams outside the model: score them with fitted=False")
            model_row = np.empty(len(uc), np.int64)
            model_row[order[mine] - (len(c) - len(uc))] = head[mine]
            a, made = 0, []
            for r in uses:
                here = slice(a, a + r[3])
                a += r[3]
                doc, inv = np.unique(ur[here], return_inverse=True)
                sums = [np.bincount(inv, um[here] * x[model_row[here]], minlength=len(doc)) for x in losses]
                made.append((r[0], USES, r[2], len(doc), _pack([doc, *sums])))
            yield _run_batch(made)

    return run


def _finish(fields: list[str]):
    """A block's rows with the sums of all parts."""
    def run(batches):
        for (_, _, _, n, rows), *sums in _by("block", batches):
            raw = pa.decompress(rows[:-8], decompressed_size=int.from_bytes(rows[-8:], "little"), codec="zstd")
            t = pa.ipc.open_stream(raw).read_all()
            total = [t.column(k).to_numpy().astype(float) for k in ("t", "b")]
            for r in sums:
                doc, *x = _unpack(r[4], r[3], [np.int64, float, float])
                for have, more in zip(total, x):
                    have[doc] += more
            tokens = t.column("tokens").to_numpy()
            cols = [*t.columns[:-3], pa.array(tokens), *(pa.array(x / np.maximum(tokens, 1)) for x in total)]
            yield from pa.Table.from_arrays(cols, names=fields).combine_chunks().to_batches(max_chunksize=1 << 14)

    return run


def score(docs: DataFrame, model: dict, threshold: float = THRESHOLD, fitted: bool = False) -> DataFrame:
    """``docs`` with n_tokens, loss_target, loss_background, score, selected; the
    text is left out. ``fitted``: the model was fitted on these documents (or more
    of them), so that no bigram is new; otherwise new ones are looked for first."""
    vocab, ready, parts = model["vocab"], model["ready"], model["parts"]
    rarer = model["pairs"].filter(~model["often"])
    if not fitted:
        none = F.lit(0).cast("bigint")
        mine = _pair_counts(docs.select("text", F.lit(False).alias("trusted")), vocab, parts).select("c", "w")
        new = mine.join(model["pairs"].select("c", "w"), ["c", "w"], "left_anti")
        of = model["pairs"].filter("c < 0").select("c", "cn", "ct", "fn", "ft").distinct()
        new = new.join(of, "c", "left").withColumns({"n": none, "t": none})
        rarer = rarer.unionByName(written(new.select(rarer.columns), "lm-new"))
    rows = without(docs, RESULTS)
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept]
    uses = rows.mapInArrow(_uses(vocab, ready, parts, names), RUN)
    known = _known(rarer, model).mapInArrow(_packed(parts), RUN)
    met = (uses.unionByName(known).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind", "block")
           .mapInArrow(_meet(model["size"], model["tokens"], model["tokens_t"]), RUN))
    out = T.StructType([*kept, T.StructField("n_tokens", T.LongType()),
                        *[T.StructField(k, T.DoubleType()) for k in ("loss_target", "loss_background")]])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = (met.repartition(n, "block").sortWithinPartitions("block", "kind", "part")
              .mapInArrow(_finish([f.name for f in out.fields]), out))
    return (scored.withColumn("score", F.col("loss_target") - F.col("loss_background"))
            .withColumn("selected", F.col("score") <= threshold))


def q_op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored against the trusted target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")), fitted=True)
