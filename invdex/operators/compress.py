"""Compressed posting tables (C1-C6, A7) on segmented lists.

``segments(term_id, seg, base, dids)``: ``base`` is the last doc id of the
previous non-empty segment of the same term (0 for the first one), i.e. the
gap reference the whole-list coding of the reference would use there. Each
segment is therefore decodable on its own, and VB segment bytes joined in
``seg`` order are exactly the whole-list bytes.

``base`` comes from a two-level lag, so that no task ever sees a whole stop-word
list: level 1 inside groups of FANOUT consecutive segments (whose rows lie sorted in
one partition), level 2 over the per-group maxima of one term (at most max_doc_id / (SEGMENT * FANOUT) rows per
term). The lists are built once, dealt by group, so level 1 needs no shuffle of
its own; level 2 reads two narrow columns of the written lists, and is left out
while all documents (4M of them) fall into one group.

``skips(term_id, seg, first, last, n)`` is the narrow table that search uses to
decide which segments have to be decoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.codecs import FORMS, encode_batches, gaps_array, id_batches, list_batches, merge_batches, run_batches, segment_batches
from ..session import stored
from .index import SEGMENT, seg_of, with_blocks
from .skew import broadcast_if_small

FANOUT = 1 << 16  # a term's group: at most 4M ids, which one task sorts and codes
ENCODED = ("term_id bigint, seg bigint, base bigint, n bigint, first bigint, last bigint, vb binary, gamma binary, "
           "gamma_pad int")
ENCODED_COLUMNS = [c.split()[0] for c in ENCODED.split(", ")]
SKIPS = ["term_id", "seg", "first", "last", "n"]


def _groups_before(rows: DataFrame, keys: list[str], last: str) -> DataFrame:
    """(keys, _hi, _hi_prev): the largest ``last`` of the group before, for the groups
    that have one."""
    return (rows.groupBy(*keys, "_hi").agg(F.max(last).alias("_hi_last"))
            .withColumn("_hi_prev", F.lag("_hi_last").over(Window.partitionBy(*keys).orderBy("_hi")))
            .where(F.col("_hi_prev").isNotNull()).select(*keys, "_hi", "_hi_prev"))


def _with_bases(rows: DataFrame, keys: list[str], last: str, tag: str, one_group: bool) -> DataFrame:
    """``rows`` with ``_base``: the ``last`` of the row before, per ``keys``. ``_prev``
    has it inside a group (keys, _hi); groups further back count by their largest
    ``last``."""
    if one_group:  # then there is nothing further back
        return rows.withColumn("_base", F.coalesce("_prev", F.lit(0).cast("bigint"))).drop("_prev")
    rows = stored(rows, tag)
    groups = _groups_before(rows, keys, last)
    # only a group's first row lacks a base, and only those rows meet the groups
    # before; terms within one group have none to add
    heads = (rows.where(F.col("_prev").isNull()).join(broadcast_if_small(groups), [*keys, "_hi"], "left")
             .withColumn("_base", F.coalesce("_hi_prev", F.lit(0).cast("bigint"))))
    inner = rows.where(F.col("_prev").isNotNull()).withColumn("_base", F.col("_prev"))
    return heads.drop("_prev", "_hi_prev").unionByName(inner.drop("_prev"))


def segments(post: DataFrame, seg_width: int = SEGMENT, fanout: int = FANOUT, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """(extra_keys..., term_id, seg, base, dids) from long-form postings (each pair
    once). What is shuffled and sorted are coded runs, a batch's ids of one (keys, group of
    segments), so that a term's ids don't become rows of their own there. One shuffle,
    by ranges of (keys, group): at most ``seg_width * fanout`` ids share a key, and the
    lists come out in order, up to the first group (see ``_with_bases``). The boundaries
    are sampled by a job of its own, so the runs are written."""
    keys = [*extra_keys, "term_id"]
    rows = post.select(*keys, "did").withColumn("_hi", F.expr(f"(did - 1) div {int(seg_width) * int(fanout)}"))
    n = int(post.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys).schema.fields)
    rows = rows.select(*keys, "_hi", "did").mapInArrow(run_batches([*keys, "_hi"]), f"{schema}, _hi bigint, first bigint, n bigint, vb binary")
    runs = stored(rows, "runs").repartitionByRange(n, *keys, "_hi").sortWithinPartitions(*keys, "_hi")
    lists = runs.mapInArrow(segment_batches(keys, int(seg_width)),
                            f"{schema}, _hi bigint, seg bigint, _prev bigint, _last bigint, dids array<bigint>")
    top = post.agg(F.max("did")).first()[0] or 0
    return _with_bases(lists, keys, "_last", "lists", top <= seg_width * fanout).select(*keys, "seg", F.col("_base").alias("base"), "dids")


def block_segments(post: DataFrame, docs: DataFrame) -> DataFrame:
    """A3 coded: every block as an index of its own, its lists starting at base 0;
    one row per (block, term_id, seg)."""
    return encode(segments(with_blocks(post, docs), extra_keys=("block",)))


def merge_compressed(*parts: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """A4 without decoding: indexes whose lists don't overlap (blocks of documents
    in ascending order) become one, with the bytes of a whole build. A part's list
    keeps its code but for the first gap, whose base is now the list before it."""
    union = parts[0].select(*ENCODED_COLUMNS)
    for p in parts[1:]:
        union = union.unionByName(p.select(*ENCODED_COLUMNS))
    # a list's old base is not needed: its first gap is coded anew
    rows = union.drop("base").withColumn("_hi", F.expr(f"seg div {int(fanout)}"))
    top = union.agg(F.max("seg")).first()[0] or 0
    if top < fanout:
        rows = rows.withColumn("_hi_prev", F.lit(None).cast("bigint"))
    else:
        rows = rows.join(broadcast_if_small(_groups_before(rows, ["term_id"], "last")), ["term_id", "_hi"], "left")
    # parts of a list, and the list before it, are neighbours in the sorted rows
    return rows.repartition("term_id", "_hi").sortWithinPartitions("term_id", "first").mapInArrow(merge_batches, ENCODED)


def gap_segments(segs: DataFrame) -> DataFrame:
    """C1 on segments: (term_id, seg, base, dids, gaps)."""
    return segs.withColumn("gaps", gaps_array("dids", "base"))


def ungap(gaps: DataFrame) -> DataFrame:
    """(term_id, did) from lists of gaps and their bases."""
    return gaps.select("term_id", "base", "gaps").mapInArrow(id_batches("gaps"), "term_id bigint, did bigint")


def encode(segs: DataFrame) -> DataFrame:
    """C3 + C5: the compressed index, one row per (term_id, seg):
    base, n, first, last, vb (binary), gamma (binary), gamma_pad."""
    return segs.select("term_id", "seg", "base", "dids").mapInArrow(encode_batches, ENCODED)


def _ids(enc: DataFrame, form: str) -> DataFrame:
    return enc.select("term_id", "base", *FORMS[form][1]).mapInArrow(id_batches(form), "term_id bigint, did bigint")


def decode_vb(enc: DataFrame) -> DataFrame:
    """C4 + C2: (term_id, did) from VB segments."""
    return _ids(enc, "vb")


def decode_gamma(enc: DataFrame) -> DataFrame:
    """C6 + C2: (term_id, did) from gamma segments."""
    return _ids(enc, "gamma")


def decode_lists(enc: DataFrame, form: str) -> DataFrame:
    """C4 or C6 with C2, one row per segment: (term_id, seg, dids)."""
    return enc.select("term_id", "seg", "base", *FORMS[form][1]).mapInArrow(
        list_batches(form), "term_id bigint, seg bigint, dids array<bigint>")


def index_size(post: DataFrame, enc: DataFrame) -> DataFrame:
    """Stored size of the whole index per format, one row.

    plain: one ``term_id:id,id,...\\n`` line per term; vb: sum of segment
    bytes (byte aligned, so equal to whole-list bytes); gamma: per term
    ceil(total code bits / 8), as the whole list would be packed. All from
    per-term partial sums (two term-keyed aggregates joined on a unique
    key), never from whole lists."""
    ids = post.groupBy("term_id").agg(
        F.count(F.lit(1)).alias("_df"), F.sum(F.length(F.col("did").cast("string"))).alias("_idc")
    )
    coded = enc.groupBy("term_id").agg(
        F.sum(F.length("vb")).alias("_vb"), F.sum(F.length("gamma") * 8 - F.col("gamma_pad")).alias("_bits")
    )
    per_term = ids.join(coded, "term_id")
    return per_term.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_terms"),
        F.sum("_df").cast("bigint").alias("n_postings"),
        F.sum(F.length(F.col("term_id").cast("string")) + 1 + F.col("_idc") + F.col("_df")).cast("bigint")
        .alias("plain_bytes"),
        F.sum("_vb").cast("bigint").alias("vb_bytes"),
        F.sum(F.expr("(_bits + 7) div 8")).cast("bigint").alias("gamma_bytes"),
    )


def term_stats(enc: DataFrame) -> DataFrame:
    """Per term df, VB bytes, and bytes and front pad of the whole list's
    gamma code (partial sums over its segments)."""
    per = enc.groupBy("term_id").agg(F.sum("n").alias("df"), F.sum(F.length("vb")).alias("vb_bytes"),
                                     F.sum(F.length("gamma") * 8 - F.col("gamma_pad")).alias("_bits"))
    return per.select("term_id", "df", "vb_bytes", F.expr("(_bits + 7) div 8").alias("gamma_bytes"),
                      F.expr("(8 - _bits % 8) % 8").alias("gamma_pad"))
