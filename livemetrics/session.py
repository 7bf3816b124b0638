"""Session helpers: a tuned local/cluster session and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (Spark 4 default): the code uses
# try_cast / try_divide where the reference relied on Hive's NULL-on-error rules.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only from measured sizes: static file-size estimates never trigger a
    # broadcast; AQE switches a join to broadcast once the real side is known to be small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "livemetrics", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the job defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; only when it is unset in local mode (tests) a scratch folder is
    created and registered.  On a cluster an unset folder is an error: a machine-local
    folder would not survive the loss of that machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: staging tables and stream "
                               "checkpoints must survive the loss of any machine")
        d = tempfile.mkdtemp(prefix="livemetrics-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
