"""Session helpers: a tuned local/cluster session and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tickerlake job wants.  Shuffle partitions are a default for
# local runs; on a cluster pass a value sized to ~128-256 MB per partition
# (AQE coalesces the rest at runtime).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE coalesces small shuffle partitions up to this size and splits skewed
    # ones above 5x the median; on a cluster start from a generous partition
    # count (e.g. input bytes / 128 MB) and let AQE shrink it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Explicit broadcasts are for sides of a fixed or checked size only;
    # keep the automatic threshold at Spark's conservative default.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickerlake", extra: dict | None = None) -> SparkSession:
    """Session with the library's settings.

    ``shuffle_partitions`` defaults to 8 only for a ``local[...]`` master; on
    a cluster the submitted configuration decides (size it to input bytes /
    ~128 MB and let AQE coalesce).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # runtime SQL settings that depend on where the session actually runs
    local = spark.sparkContext.master.startswith("local")
    if local:
        # small local inputs: keep several tasks per stage instead of one 1 MB partition
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", str(64 * 1024))
        if shuffle_partitions is None:
            shuffle_partitions = 8
    else:
        # cluster: coalesce to the advisory size, not to the smallest allowed partition
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    and the master is local (tests) a fresh scratch folder is created and
    registered.  A cluster without the setting is an error: a machine-local
    folder would not survive the loss of that machine.  Works for classic and
    Spark Connect sessions (the SparkContext is used only when available).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if conf_dir:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
    local = tempfile.mkdtemp(prefix="tickerlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(local)
    else:
        spark.conf.set("spark.checkpoint.dir", local)
    return local
