"""Join helpers for skewed keys and size-checked broadcasts.

A stop word such as ``the`` can own a third of all postings. Plain
shuffle joins on such a key send all of its rows to one task. The helpers
here either broadcast a side whose size has been checked, or salt the few
heavy keys so that their rows spread over many partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sizing parameters. Heavy keys are the HOT_KEYS keys with the largest
# weight; every other key then holds at most 1/HOT_KEYS of the total weight.
HOT_KEYS = 1024
MAX_SALT = 4096
# Largest table broadcast after a size check: rows, and bytes of column data
# (a token has no length bound, so rows alone prove nothing).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """At most ``max_rows`` rows and ``max_bytes`` bytes of column data, counted
    over at most ``max_rows + 1`` rows."""
    wide = [f"octet_length(`{f.name}`)" for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    nested = [f"octet_length(to_json(struct(`{f.name}`)))" for f in df.schema.fields
              if f.dataType.typeName() in ("array", "map", "struct")]
    fixed = 8 * (len(df.columns) - len(wide) - len(nested))
    size = " + ".join([str(fixed), *(f"coalesce({x}, 0)" for x in [*wide, *nested])])
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.expr(size).cast("bigint"))).first()
    return n <= max_rows and (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after checking its rows and bytes; otherwise
    return it unchanged (shuffle join, AQE may still convert it at run time)."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def salt_buckets(spark) -> int:
    return max(1, min(MAX_SALT, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def salted_join(big: DataFrame, small: DataFrame, key: str, weight_col: str, spread_col: str,
                hot_keys: int = HOT_KEYS, buckets: int | None = None, how: str = "inner") -> DataFrame:
    """Equi-join ``big`` with ``small`` on ``key`` (``how``: inner or left).

    The ``hot_keys`` keys with the largest ``weight_col`` in ``small`` are
    salted: their rows in ``big`` are spread over ``buckets`` salts by a hash
    of ``spread_col``, and their rows in ``small`` are replicated once per
    salt. The hot set is a top-k, so its broadcast size is bounded by
    ``hot_keys`` rows. Every other key has weight <= total / hot_keys.
    """
    buckets = buckets or salt_buckets(big.sparkSession)
    hot = (
        small.groupBy(key).agg(F.max(weight_col).alias("_sj_w")).orderBy(F.desc("_sj_w"), F.asc(key)).limit(hot_keys)
        .select(key, F.lit(True).alias("_sj_hot"))
    )
    hot_b = F.broadcast(hot)
    big_s = big.join(hot_b, key, "left").withColumn(
        "_sj_salt",
        F.when(F.col("_sj_hot"), F.pmod(F.xxhash64(spread_col), F.lit(buckets))).otherwise(F.lit(0).cast("bigint")),
    ).drop("_sj_hot")
    small_s = small.join(hot_b, key, "left").withColumn(
        "_sj_salt",
        F.explode(
            F.when(F.col("_sj_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint")))
            .otherwise(F.array(F.lit(0).cast("bigint")))
        ),
    ).drop("_sj_hot")
    return big_s.join(small_s, [key, "_sj_salt"], how).drop("_sj_salt")
