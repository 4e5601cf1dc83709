"""Dense, gap-free ids in a global order without a single-partition window.

``row_number() over (order by ...)`` moves every row into one task. Instead:

1. range-partition on the order columns (Spark samples the boundaries, and a
   key that holds many rows is still split because the order is total),
2. sort inside each partition and number the rows there
   (``monotonically_increasing_id`` minus the partition's base),
3. checkpoint to the shared checkpoint folder, so a recompute after an
   executor loss cannot move rows between partitions (the sampled
   boundaries are not stable across recomputes),
4. count rows per partition: one row per partition, a bounded table,
   turned into running offsets and broadcast back.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from .skew import broadcast_if_small

_PID = "_ix_pid"
_LOCAL = "_ix_local"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dense_ids(df: DataFrame, order_cols: list[str | Column], id_col: str, start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = ``start`` + position of the row in ``order_cols`` order.

    The order must be total (unique keys) for the ids to be deterministic."""
    ensure_checkpoint_dir(df.sparkSession)
    n = _partitions(df, num_partitions)
    staged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("bigint"), 33))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # persisted first, so writing the checkpoint does not recompute the shuffle
    ranged = staged.checkpoint(eager=True)
    staged.unpersist()
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_ix_n"))
    # One row per partition: the window below sees at most ``n`` rows.
    offsets = counts.select(
        _PID,
        (F.sum("_ix_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1))).alias("_ix_off"),
    ).fillna(0, subset=["_ix_off"])
    return (
        ranged.join(F.broadcast(offsets), _PID)
        .withColumn(id_col, F.lit(start).cast("bigint") + F.col("_ix_off") + F.col(_LOCAL))
        .drop(_PID, _LOCAL, "_ix_off")
    )


def global_rank_in_group(df: DataFrame, group_col: str, order_cols: list[str], rank_col: str,
                         num_partitions: int | None = None) -> DataFrame:
    """1-based rank of each row inside its group by ``order_cols``.

    Skew-safe replacement for ``row_number() over (partition by group order
    by ...)``: one global dense numbering (split across partitions even when
    one group holds most rows), then rank = number - first number of the
    group + 1. The per-group minimum is a partially aggregated group-by."""
    numbered = dense_ids(df, [group_col, *order_cols], "_rk_g", start=0, num_partitions=num_partitions)
    firsts = numbered.groupBy(group_col).agg(F.min("_rk_g").alias("_rk_first"))
    # One row per group; broadcast only after a size check, so a group that
    # owns most rows never lands in a single join task.
    return (
        numbered.join(broadcast_if_small(firsts), group_col)
        .withColumn(rank_col, F.col("_rk_g") - F.col("_rk_first") + F.lit(1))
        .drop("_rk_g", "_rk_first")
    )
