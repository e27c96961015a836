"""SparkSession helper.

Cluster settings (executor sizes, shuffle partitions, checkpoint folder)
belong to the deployment; this helper only pins the settings the
operators rely on for correct results (UTC session time zone) and turns
on adaptive execution.  It never overrides a value the cluster already set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library needs for correct and scalable plans.  They are
# applied only when the session does not already define them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpointed intermediates (shared derived tables) are transient:
    # delete their files once the plans that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "allelic",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on
    a cluster leave them ``None`` so spark-submit decides.
    """
    from pyspark import SparkConf
    cluster = SparkConf()  # spark-submit / spark-defaults.conf values
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        if not cluster.contains(k):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may return a session built elsewhere; the time zone is
    # a runtime SQL conf, so pin it here too (results depend on it).
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    ``spark.checkpoint.dir`` names it; failing that, the folder already set
    with ``setCheckpointDir``.  With neither, a local master gets a temporary
    folder (tests); any other master raises, because a folder of one machine
    is invisible to the other executors.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="allelic-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for lineage cuts and
    stream checkpoints (never a machine-local temp folder on a cluster)."""
    return os.path.join(checkpoint_dir(spark), name)
