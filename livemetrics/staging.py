"""Staging tables for intermediates read by several branches of one job.

Spark re-plans every branch that reads a shared DataFrame, and column pruning makes the
branches differ, so the exchange under them is not reused and the raw input is scanned
and shuffled once per branch.  A job therefore writes such an intermediate (always a
reduced grain: visits, merged broadcasts, filtered trades) once as Parquet under the
shared checkpoint folder named by ``spark.checkpoint.dir`` and reads it back: the
lineage is cut, an executor lost later does not recompute the upstream, and each branch
scans only the columns it needs.

Each stage gets its own folder (a rerun never reads a half-written one).  A job removes its
stage folders once its output is written (``stages_dropped_after``).
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from livemetrics.session import checkpoint_dir


_STAGED: dict[str, list[str]] = {}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to ``<spark.checkpoint.dir>/stage/<name>-<id>`` and return it read back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


@contextmanager
def stages_dropped_after(spark: SparkSession):
    """Remove the folders staged inside the ``with`` block when it ends (whether or not it
    failed), through their own file system.  The job's output must be written inside."""
    mine = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = len(mine)
    try:
        yield
    finally:
        jvm = spark._jvm
        for path in mine[before:]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        del mine[before:]
