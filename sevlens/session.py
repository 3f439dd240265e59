"""Session helpers.

Library code never builds its own session: every operator takes the caller's
``SparkSession`` (or a DataFrame).  ``build_session`` exists for tests, the
bench and local runs only.  ``scratch_path`` resolves the shared folder named by
``spark.checkpoint.dir`` so that written intermediate tables live where every
executor can read them; a private folder is created only when the setting is
unset (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job wants regardless of size: adaptive execution re-plans
# joins and coalesces / splits shuffle partitions at runtime from real sizes.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints of materialised aggregates are deleted once no plan references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "sevlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(CLUSTER_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="sevlens-ckpt-")   # local runs / tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/sevlens/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and read it from there.

    Used for small aggregated tables that several later steps read: the input
    is scanned once, the lineage is cut, and a lost executor costs a re-read of
    the checkpoint files, not a recomputation (never ``localCheckpoint``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_settings(input_bytes: int, total_cores: int,
                     split_bytes: int = 256 * 1024 * 1024,
                     shuffle_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Scan / shuffle sizing for a cluster run over ``input_bytes`` of Parquet.

    * File splits of ``split_bytes`` (100 TB -> ~400k scan tasks, each well inside
      executor memory for the projected columns).
    * An initial shuffle width that gives every core several tasks and keeps each
      shuffle partition near ``shuffle_bytes`` even before AQE coalesces it
      (AQE then merges small partitions and splits skewed ones at runtime).
    """
    initial = max(3 * total_cores, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_bytes),
        **CLUSTER_DEFAULTS,
    }
