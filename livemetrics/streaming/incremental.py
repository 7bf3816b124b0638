"""Keep day partitions current as raw log files arrive.

The reference handles late data by re-running whole days with an overwrite.  The same
contract as a stream: a file source on the raw log folder, and in ``foreachBatch`` the
output days reached by the new files are recomputed from the full input they read and their
partitions replaced (so a replayed batch after a failure gives the same table).  A late file
of day D also reaches the days that read D with an offset: the broadcasts of D-1 that look
ahead, the retention of D+1 and D+7 (``livemetrics.dependencies``).  Progress lives in the
checkpoint folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from livemetrics.dependencies import JobRun
from livemetrics.jobs import rerun_late
from livemetrics.session import checkpoint_dir
from livemetrics.sinks import overwrite_partitions
from livemetrics.sources.tables import on_days
from livemetrics.staging import stages_dropped_after

# Days filtered by literals at a time; a bulk reload of more of them goes slice by slice.
MAX_DAYS = 1000


def touched_days(batch: DataFrame, day_col: str, compact: bool = False) -> list[dt.date]:
    """The calendar days of a micro-batch: one value per day, however many rows."""
    fmt = "%Y%m%d" if compact else "%Y-%m-%d"
    days = batch.where(F.col(day_col).isNotNull()).select(F.col(day_col).cast("string")).distinct().collect()
    return sorted(dt.datetime.strptime(r[0], fmt).date() for r in days)


def _start(stream: DataFrame, per_batch, spark: SparkSession, name: str, trigger_once: bool) -> StreamingQuery:
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    return (w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")).start()


def rerun_touched_days(spark: SparkSession, raw_path: str, schema: StructType,
                       build: Callable[[DataFrame], DataFrame], out_path: str, name: str,
                       day_col: str = "day", trigger_once: bool = False,
                       offsets: Sequence[int] = (0,)) -> StreamingQuery:
    """Start a stream that recomputes, per micro-batch, the output days its files reach.

    ``build`` takes the input rows of all days those outputs read (all files, not only the
    new ones) and returns the output rows with a ``day`` column.  An output day D reads the
    days D + ``offsets``.
    """
    stream = spark.readStream.schema(schema).parquet(raw_path)
    shift = [dt.timedelta(days=o) for o in offsets]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        days = sorted({x - o for x in touched_days(batch, day_col) for o in shift})
        raw = spark.read.schema(schema).parquet(raw_path)
        for i in range(0, len(days), MAX_DAYS):
            part = days[i:i + MAX_DAYS]
            # as literals the days prune the raw folder's partitions, so history is not read
            rows = on_days(raw, sorted({d + o for d in part for o in shift}), day_col)
            with stages_dropped_after(spark):
                overwrite_partitions(build(rows), out_path, day_col=day_col, days=part)

    return _start(stream, per_batch, spark, name, trigger_once)


def rerun_jobs_on_late_files(spark: SparkSession, raw_path: str, schema: StructType, runs: Sequence[JobRun],
                             first, last: Callable[[], dt.date], name: str, day_col: str = "day",
                             compact: bool = False, trigger_once: bool = False) -> StreamingQuery:
    """Start a stream on one raw table that repeats every job of ``runs`` its new files reach, through the
    chain of jobs, for exactly the output days in ``[first, last()]`` (see ``jobs.rerun_late``)."""
    stream = spark.readStream.schema(schema).parquet(raw_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        days = touched_days(batch, day_col, compact)
        if days:
            rerun_late(spark, runs, {raw_path: days}, first, last())

    return _start(stream, per_batch, spark, name, trigger_once)
