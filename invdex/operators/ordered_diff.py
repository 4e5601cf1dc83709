"""Ordered diff of result lists (Q9): like ``diff``, and unlike a multiset
difference, it sees lines that changed places.

Equal lines of a query are paired in order (first with first). Unpaired lines are
``+`` (actual only) or ``-`` (expected only). Of the paired ones a longest
run that keeps its order stays; the others are ``moved``. Among several longest
runs the one ending last, and before that last at each step, is taken.

The paired lines, renumbered from 1 on both sides, are a permutation. Wherever a
prefix of it maps onto itself it is cut: the longest increasing subsequence of
the whole is that of its pieces, one after the other. Pieces are found with
running maxima in two levels, so no task holds a whole list; a piece (lines that
changed places with each other) is read as a stream of two numbers a line, and lines that
stay where they were are pieces of one and go nowhere.

Defined cases: empty lists on either side give only ``+`` or ``-``; null lines
pair with null lines; repeated lines pair by their order.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored
from .ids import global_rank_in_group
from .search import RANK_WINDOW_MAX

STRIDE = 1 << 16  # positions in one first-level group of the running maxima


def _rank(df: DataFrame, group: list[str], order: str, out: str) -> DataFrame:
    """``out`` = 1.. by ``order`` in each group; a window only where the largest
    group is known to fit one task."""
    most = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= RANK_WINDOW_MAX:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(order)).cast("bigint"))
    return global_rank_in_group(df.withColumn("_g", F.struct(*group)), "_g", [order], out).drop("_g")


def _running_max(df: DataFrame, value, out: str, last: int) -> DataFrame:
    """Maximum of ``value`` over the query's positions up to this one (``last`` 0)
    or the one before (-1); 0 where there is none."""
    df = df.withColumn("_v", value).withColumn("_hi", F.floor((F.col("pos") - 1) / STRIDE))
    upper = df.groupBy("query_id", "_hi").agg(F.max("_v").alias("_m"))
    before = Window.partitionBy("query_id").orderBy("_hi").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("query_id", "_hi", F.max("_m").over(before).alias("_before"))
    inside = Window.partitionBy("query_id", "_hi").orderBy("pos").rowsBetween(Window.unboundedPreceding, last)
    own = df.withColumn("_own", F.max("_v").over(inside))
    return (own.join(upper, ["query_id", "_hi"])
            .withColumn(out, F.greatest(F.coalesce("_own", F.lit(0)), F.coalesce("_before", F.lit(0))))
            .drop("_v", "_hi", "_own", "_before"))


def _out_of_order(values: array) -> list[int]:
    """Indices outside the longest increasing subsequence."""
    tails, level = array("q"), array("q")
    for v in values:
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
        else:
            tails[k] = v
        level.append(k)
    want, out = len(tails) - 1, []
    for i in range(len(values) - 1, -1, -1):
        if level[i] == want:  # the last of its level before the one taken is the smallest
            want -= 1
        else:
            out.append(i)
    return out


def _moved(batches):
    """(query_id, pos) of moved lines, from pieces sorted by position."""
    key, first, values = None, 0, array("q")

    def out():
        at = _out_of_order(values)
        return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(at), pa.int64()), pa.array([first + i for i in at], pa.int64())],
                                          names=["query_id", "pos"])

    for b in batches:
        for q, piece, pos, to in zip(*(b.column(k).to_pylist() for k in ("query_id", "piece", "pos", "to"))):
            if key != (q, piece):
                if key is not None:
                    yield out()
                key, first, values = (q, piece), pos, array("q")
            values.append(to)
    if key is not None:
        yield out()


def ordered_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(query_id, side, line, rank_actual, rank_expected) of two tables
    (query_id, rank, line); side is ``+``, ``-`` or ``moved``. Ranks are unique
    within a query."""
    def side(df, rank):
        return _rank(df.select("query_id", F.col("rank").cast("bigint").alias(rank), "line"), ["query_id", "line"], rank, "k")

    a, e = side(actual, "rank_actual").alias("a"), side(expected, "rank_expected").alias("e")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"e.{c}")) for c in ("query_id", "line", "k")]
    both = stored(a.join(e, same[0] & same[1] & same[2], "full").select(
        *[F.when(F.col("rank_actual").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in ("query_id", "line")],
        "rank_actual", "rank_expected"), "diff-pairs")
    paired = _rank(both.filter("rank_actual IS NOT NULL AND rank_expected IS NOT NULL"), ["query_id"], "rank_actual", "pos")
    paired = stored(_rank(paired, ["query_id"], "rank_expected", "to"), "diff-paired")
    reach = _running_max(paired.select("query_id", "pos", "to"), F.col("to"), "reach", 0)
    pieces = _running_max(reach, F.when(F.col("reach") == F.col("pos"), F.col("pos")), "piece", -1)
    alone = (F.col("reach") == F.col("pos")) & (F.col("piece") == F.col("pos") - 1)
    moved = (pieces.filter(~alone).select("query_id", "piece", "pos", "to").repartition("query_id", "piece")
             .sortWithinPartitions("query_id", "piece", "pos").mapInArrow(_moved, "query_id bigint, pos bigint"))
    moved = paired.join(moved, ["query_id", "pos"]).select(
        "query_id", F.lit("moved").alias("side"), "line", "rank_actual", "rank_expected")
    only = both.filter("rank_actual IS NULL OR rank_expected IS NULL").select(
        "query_id", F.when(F.col("rank_expected").isNull(), "+").otherwise("-").alias("side"), "line", "rank_actual", "rank_expected")
    return only.unionByName(moved)
