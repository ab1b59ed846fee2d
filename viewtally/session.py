"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings every report is written for. On a cluster these normally
# come from spark-defaults; values already set there win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Bytes of a batch of rows that Spark hands to a Python worker; without it a batch is 10,000 rows, however long they are.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def build_session(app: str = "viewtally", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def bound_batches(spark: SparkSession) -> None:
    """Batches for Python end at ``BATCH_BYTES`` (and a row), unless the session has a bound of its own.

    Each task holds a batch in the executor's direct memory and again in its
    worker. It stays set for the session, as frames run later than they are made.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; make one only in local mode.

    A cluster without ``spark.checkpoint.dir`` is an error: a machine-local
    folder would be lost together with its executor.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="viewtally-checkpoint-")
    spark.sparkContext.setCheckpointDir(shared)
    return shared
