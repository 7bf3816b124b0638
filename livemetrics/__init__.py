"""Batch analytics for a live-streaming service, written as Spark DataFrame jobs.

Layout:
  sources/    reads of day-partitioned logs and the stand-in mapping of the test tables
  functions/  column expressions (time parsing, safe arithmetic, predicates)
  operators/  DataFrame -> DataFrame building blocks (merge, attribution, pivots, audience...)
  plans/      the daily jobs assembled from operators (room flow, broadcast fact, reports)
  streaming/  incremental re-run of day partitions from a Structured Streaming source
  sinks       partition overwrite, report writes, JDBC export
  jobs        backfill over a day range
"""

from livemetrics.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
