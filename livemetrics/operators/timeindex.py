"""Summaries of readings over time intervals from an index of time blocks.

Joining every reading to every interval that covers it costs rows in proportion to the
readings per hour times the hours of the intervals.  Here readings are summarised once per key
and block of ``base_s * 4**level`` seconds, and an interval reads the few blocks that make up
its inside: at most six of a level, so O(log length) rows whatever the readings per hour.  Only
the two base buckets that hold its start and end are read reading by reading.

Summaries must merge with themselves: maxima, minima and sums of per-reading expressions.
Levels: ``LEVELS`` (a top block is 45 days at 60 seconds); a longer interval reads more top blocks.
A block of a higher level is one row per key after partial aggregation, so neither a busy key
nor a popular block gathers its readings in one task, and building the query runs no job.
"""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 9

#: name -> (aggregate that merges with itself, value of one reading)
Spec = Mapping[str, tuple[Callable[[Column], Column], Column]]


def _block(level: int, block: Column) -> Column:
    return F.struct(F.lit(level).alias("l"), block.cast("long").alias("b"))


def _merged(spec: Spec) -> list[Column]:
    return [agg(F.col(name)).alias(name) for name, (agg, _) in spec.items()]


def time_blocks(readings: DataFrame, key: Sequence[str], ts: str, spec: Spec, base_s: int = 60) -> DataFrame:
    """The index: one row per key and non-empty block ``_at`` (level, number) with the summaries."""
    bucket = F.floor(F.unix_seconds(F.col(ts)) / base_s)
    base = (readings.select(*key, bucket.alias("_b"), *[x.alias(name) for name, (_, x) in spec.items()])
            .where(F.col("_b").isNotNull()).groupBy(*key, "_b").agg(*_merged(spec)))
    levels = F.array(*[_block(k, F.shiftright("_b", 2 * k)) for k in range(LEVELS)])
    return base.withColumn("_at", F.explode(levels)).groupBy(*key, "_at").agg(*_merged(spec))


def cover(first: Column, end: Column) -> Column:
    """The blocks that make up the base buckets ``[first, end)``, each bucket in exactly one: array of
    (level, number).  At each level the blocks outside the next level's whole blocks are taken."""
    def lo(k):
        return -F.shiftright(-first, 2 * k)                       # rounded up

    def hi(k):
        return F.shiftright(end, 2 * k)                           # rounded down

    def blocks(k, a, b):
        return F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: _block(k, x))) \
                .otherwise(F.array().cast("array<struct<l:int,b:bigint>>"))

    parts = []
    for k in range(LEVELS - 1):
        up_lo, up_hi = lo(k + 1), hi(k + 1)
        parts.append(F.when(up_lo < up_hi, F.concat(blocks(k, lo(k), up_lo * 4), blocks(k, up_hi * 4, hi(k))))
                     .otherwise(blocks(k, lo(k), hi(k))))
    return F.concat(*parts, blocks(LEVELS - 1, lo(LEVELS - 1), hi(LEVELS - 1)))


def interval_summaries(intervals: DataFrame, readings: DataFrame, key: Sequence[str], start: str, end: str,
                       ts: str, spec: Spec, base_s: int = 60) -> DataFrame:
    """One row per distinct (key, start, end) with a reading in ``[start, end]``, ends included: the
    summaries of those readings.  Null keys or ends, and intervals that end before they start, hold none."""
    key, keep = list(key), [*key, start, end]
    iv = (intervals.select(*keep).where(F.col(start) <= F.col(end)).distinct()
          .withColumns({"_b0": F.floor(F.unix_seconds(F.col(start)) / base_s),
                        "_b1": F.floor(F.unix_seconds(F.col(end)) / base_s)}))
    inside = (iv.select(*keep, F.explode(cover(F.col("_b0") + 1, F.col("_b1"))).alias("_at"))
              .join(time_blocks(readings, key, ts, spec, base_s), [*key, "_at"]).select(*keep, *spec))
    single = readings.select(*key, F.floor(F.unix_seconds(F.col(ts)) / base_s).alias("_b"), F.col(ts).alias("_t"),
                             *[x.alias(name) for name, (_, x) in spec.items()])
    rim = (iv.withColumn("_b", F.explode(F.array_distinct(F.array("_b0", "_b1")))).join(single, [*key, "_b"])
           .where(F.col("_t").between(F.col(start), F.col(end))).select(*keep, *spec))
    return inside.unionByName(rim).groupBy(*keep).agg(*_merged(spec))
