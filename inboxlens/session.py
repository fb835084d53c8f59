"""Session settings the plans are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, and turn a shuffled join into a broadcast join only when the
# materialised side is measured under the threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # Planning-time sizes come from compressed file sizes; scale them so the
    # broadcast threshold is checked against something closer to the size
    # of the decoded rows (Parquet typically compresses 3x or more).
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    # Let a join reuse a side already hash-partitioned on a subset of its
    # keys: the small side is shuffled to match instead of the large one
    # being shuffled again.  All keys used here are high-cardinality ids, so
    # this does not concentrate rows.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "inboxlens", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benchmarks (no web UI)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app) \
        .config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false") \
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions)) \
        .config("spark.driver.memory", "8g")
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session has none (local tests) is ``default`` set."""
    current = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if default is None:
        raise RuntimeError("spark.checkpoint.dir is not set on this session")
    spark.sparkContext.setCheckpointDir(default)
    spark.conf.set("spark.checkpoint.dir", default)
    return default


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``.  Only a local
    session without that setting gets one of its own."""
    master = spark.sparkContext.master
    local = master.startswith("local") and not master.startswith("local-cluster")
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named or not local:
        return checkpoint_dir(spark).rstrip("/")
    return checkpoint_dir(spark, "file://" + tempfile.mkdtemp(prefix="inboxlens-"))
