"""Session helpers: building a local session for tests and bench, and the
shared folders (checkpoint, scratch) that every job writes to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "invdex", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests, bench and examples. On a cluster the caller
    passes its own master and configuration; nothing here is cluster-specific."""
    b = (
        SparkSession.builder.master(master or os.environ.get("INVDEX_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.join.preferSortMergeJoin", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
        .config("spark.driver.memory", os.environ.get("INVDEX_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``invdex`` importable in Python workers (pandas UDFs,
    mapInPandas) with ``addPyFile``: the package is zipped once per
    application and distributed by Spark like any --py-files archive."""
    sc = spark.sparkContext
    if app_id(spark) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="invdex-pkg-"), "invdex.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app_id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must set this to a shared file system. Only on a ``local``
    master (tests, bench) is a fresh local folder made where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    else:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="invdex-ckpt-", dir=os.environ.get("INVDEX_TMP", "/tmp")))
    return sc.getCheckpointDir()


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (cache key for per-app state)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # pragma: no cover - conf not readable
        return spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the shared checkpoint directory, for
    written tables and streaming sources/sinks/checkpoints."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/invdex-scratch/{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: the
    rows are computed once, nothing stays cached, and a lost executor costs
    nothing that was written."""
    path = scratch_path(df.sparkSession, tag)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
