"""Mixing sources to target weights (operator 3), DataFrame functions only.

Capped water-filling: the sources share ``share`` of all words in proportion to
their weights; a source whose part exceeds ``max_epochs`` times its size is
clamped there and the excess is reshared by weight among the others, until no
source is above. Rounds compare exact integers; each is one aggregation over the
table of sources.

Sampling: a source with target t and size s is taken floor(t / s) whole times,
and the remaining quota is filled with whole documents in the order of a seeded
hash of doc_id: a document is in if the middle of its words lies within the
quota, so a source misses its target by half a document at most. The cut is
found in two steps: word sums of 4,096 hash buckets give the bucket that holds
the quota's end, and only that bucket's documents are ordered. A document is then
judged by comparing its (hash, id, size) with its source's cut; no window runs
over a whole source.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; documents with the same id and size are taken alike; a source
without words has target 0; an empty table gives an empty mix; a null doc_id
hashes as the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ids import dense_ids
from ..operators.skew import BROADCAST_MAX_ROWS, salted_join
from .common import WORD_CLASS, prepare, shield, table, without, written

WEIGHTS = (1, 2, 3)  # by source in code point order, null last, repeating
MAX_EPOCHS = 3
SEED = 0
_INSIDE = ["copies", "docs", "whole", "cut_bucket", "cut", "_key", "_u", "_bucket", "_rank"]
_PLAN = ["source_size", "target", "whole", "cut_bucket", "cut"]


def n_words(text: str = "text") -> Column:
    """Runs of non-space characters (null: 0), without building an array."""
    marks = F.translate(F.regexp_replace(F.col(text), WORD_CLASS, "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("bigint")


def _keys(df: DataFrame, seed: int) -> DataFrame:
    u = F.md5(F.concat(F.lit(f"mix:{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    rank = F.struct(F.col("_u").alias("u"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("i"), F.col("size").alias("z"))
    return (df.withColumn("_u", u).withColumn("_key", key).withColumn("_bucket", F.substring("_u", 1, 3)).withColumn("_rank", rank))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """(source, size) rows -> one row per source: source_size, weight, target."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    per = per.withColumn("last", F.col("source").isNull())
    numbered = dense_ids(per, ["last", "source"], "no")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    src = written(numbered.select("source", "source_size", "docs", F.get(cycle, (F.col("no") % len(weights)).cast("int")).alias("weight")), "mix-sources")
    big = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    cap = F.col("source_size") * max_epochs
    total, width = (int(x or 0) for x in src.agg(F.sum("source_size"), F.sum("weight")).first())
    total = int(total * share) if share != 1.0 else total
    num, den = total, width
    while den:
        over = cap.cast("decimal(38,0)") * F.lit(den).cast("decimal(19,0)") <= big(num) * F.col("weight")
        c, w = (int(x or 0) for x in src.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first())
        if (total - c, w) == (num, den):
            break
        num, den = total - c, w
    if den:
        target = F.when(over, cap.cast("double")).otherwise(F.lit(num).cast("bigint") * F.col("weight") / F.lit(den))
    else:
        target = cap.cast("double")
    return src.withColumn("target", target.cast("double"))


def plan(docs: DataFrame, seed: int = SEED, **how) -> tuple[DataFrame, DataFrame]:
    """(sized, plan): the documents' ids and sizes, and one row per source with
    its target, whole repetitions and the cut of the fractional one."""
    prepare(docs.sparkSession)
    sized = written(docs.select("doc_id", "source", n_words().alias("size")), "mix-sized")
    want = targets(sized, **how)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    want = want.withColumn("whole", whole).withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    want = want.withColumn("_key", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))).drop("source")
    keyed = _keys(sized, seed)
    per_bucket = keyed.groupBy("_key", "_bucket").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("_key").orderBy("_bucket")) - F.col("words")
    edge = (per_bucket.withColumn("before", before).join(want.select("_key", "quota"), "_key")
            .filter((F.col("before") <= F.col("quota")) & (F.col("quota") < F.col("before") + F.col("words")))
            .select("_key", "_bucket", "before", "quota"))
    edge = written(edge, "mix-edge")  # one row per source
    small = edge.limit(BROADCAST_MAX_ROWS // 10 + 1).count() <= BROADCAST_MAX_ROWS // 10
    inside = keyed.join(F.broadcast(edge) if small else edge, ["_key", "_bucket"])
    run = F.sum("size").over(Window.partitionBy("_key").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1))
    middle = F.col("before") + F.coalesce(run, F.lit(0)) + F.col("size") / 2
    cuts = (inside.withColumn("_in", middle <= F.col("quota")).filter("_in").groupBy("_key").agg(F.max("_rank").alias("cut")))
    out = (want.join(edge.select("_key", F.col("_bucket").alias("cut_bucket")), "_key", "left").join(cuts, "_key", "left"))
    return sized, written(out.select("_key", "docs", *_PLAN), "mix-plan")


def mix(docs: DataFrame, plan_: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` (which has ``size``) with source_size, target, copies, taken."""
    keyed = _keys(without(docs, ["source_size", "target", "copies", "taken"]), seed)
    if plan_.limit(BROADCAST_MAX_ROWS // 10 + 1).count() <= BROADCAST_MAX_ROWS // 10:
        joined = keyed.join(F.broadcast(plan_), "_key")
    else:
        joined = salted_join(keyed, plan_, "_key", "docs", "_u")
    below = F.coalesce(F.col("_bucket") < F.col("cut_bucket"), F.lit(False))
    at_cut = F.coalesce((F.col("_bucket") == F.col("cut_bucket")) & (F.col("_rank") <= F.col("cut")), F.lit(False))
    # words that don't fill a repetition belong to the hash order's first documents
    copies = F.col("whole") + F.when(below | at_cut, 1).otherwise(0)
    return (joined.withColumn("copies", copies.cast("bigint")).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("_key", "_u", "_bucket", "_rank", "docs", "whole", "cut_bucket", "cut"))


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: each document repeated as often as it is taken, with
    ``size``, ``source_size``, ``target``, ``taken`` and ``repetition`` (from 1)."""
    _, p = plan(docs)
    docs, back = shield(docs, _INSIDE)
    out = mix(without(docs, ["size", "repetition"]).withColumn("size", n_words()), p)
    return (out.filter("copies > 0").withColumn("repetition", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
            .drop("copies").withColumnsRenamed(back))


def q_op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words taken of it."""
    sized, p = plan(table(spark, sf_dir, "documents"))
    return mix(sized, p).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, md5('mix:0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS u FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS HUGEINT) AS s FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, 3 * s AS cap FROM s0),
tot AS (SELECT sum(s) AS t FROM s1),
s2 AS (SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST) AS k FROM s1),
s3 AS (SELECT *, t - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den FROM s2, tot),
lam AS (SELECT num, den FROM s3 WHERE num * w < cap * den ORDER BY k LIMIT 1),
tg AS (SELECT source, s, CASE WHEN den IS NULL OR cap * den <= num * w THEN CAST(cap AS DOUBLE) ELSE CAST(num * w AS DOUBLE) / CAST(den AS DOUBLE) END AS target FROM s1 LEFT JOIN lam ON true),
pl AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole FROM tg),
x AS (SELECT doc_id, size, s, target, whole, target - whole * s AS quota, sum(size) OVER (PARTITION BY d.source ORDER BY u, coalesce(doc_id, -9223372036854775808), size ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN pl ON d.source IS NOT DISTINCT FROM pl.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target, CAST((whole + CASE WHEN before + size / 2.0 <= quota THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM x
"""
