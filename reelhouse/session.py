"""Session construction and cluster-wide settings.

Everything that matters for correctness is pinned here: UTC session time zone,
ANSI mode, adaptive query execution (runtime broadcast conversion, partition
coalescing and skew-join splitting).  The checkpoint directory is *read* from
the session (``spark.checkpoint.dir``); a local one is only created when none is
configured and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every reelhouse job relies on.  They are session-level SQL confs, so
# they can also be applied to a session created elsewhere (see ``configure``).
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Runtime bloom filters let a selective dimension side prune the big side.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Parquet: keep predicate / aggregate pushdown on (defaults, pinned).
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def sizing(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024,
           max_waves: int = 20) -> dict[str, str]:
    """Shuffle and scan settings for a job reading about ``input_bytes`` on
    ``total_cores`` task slots.

    The shuffle gets one partition per ``partition_bytes`` of input (a shuffle
    rarely outgrows its input once columns are pruned), in whole waves of the
    cluster, at least two.  The number of shuffle blocks is map tasks times
    partitions, so both the shuffle and the scan are capped at ``max_waves``:
    beyond that, partitions and scan splits grow instead (the sort-based
    shuffle and aggregation spill to disk).  AQE starts from that partition
    count, coalesces the excess and splits skewed partitions.
    """
    cores = max(total_cores, 1)
    mb = 1024 * 1024
    waves = min(max(2, -(-input_bytes // (partition_bytes * cores))), max_waves)
    n = waves * cores
    split = max(128 * mb, -(-input_bytes // (cores * max_waves * mb)) * mb)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_CONF` to an existing session and return it."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "reelhouse",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the reelhouse settings.

    On a cluster ``master`` stays ``None`` (taken from spark-submit) and
    ``shuffle_partitions`` should be sized so one partition is ~128-256 MB of
    shuffle data; AQE coalesces the excess at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    # Checkpoints of row numbering are deleted once their frames are garbage,
    # and written compressed (they hold a whole table; the default is raw rows).
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    b = b.config("spark.checkpoint.compress", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SQL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only if unset.

    Order: an already active ``SparkContext`` checkpoint dir, then the
    ``spark.checkpoint.dir`` setting of the session.  Only a *local* master may
    fall back to a fresh temporary folder; on a cluster a missing setting is an
    error, because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="reelhouse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared, reliable folder "
        "(e.g. an HDFS or object-store path) before running reelhouse jobs"
    )
