"""Session construction and the shared storage root for sinks and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job wants; a cluster launcher may override any of them.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint() files of intermediates are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "clickscope",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the launcher's session and leave its settings alone."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root; only when the session names none (tests) create one.

    ``spark.checkpoint.dir`` cannot be changed on a running session, so a missing folder is given to the
    SparkContext (``setCheckpointDir``) and read back from there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="clickscope-ckpt-"))
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder (cluster file system) for sink tables, stream checkpoints and lineage cuts.

    Taken from the session's ``spark.checkpoint.dir``; a session without one (a local test) gets its own.
    """
    return ensure_checkpoint_dir(spark).rstrip("/")


def materialize(df):
    """Cut lineage for an intermediate read several times: ``checkpoint()`` into the shared checkpoint folder
    (survives executor loss, unlike a cache or ``localCheckpoint``)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
