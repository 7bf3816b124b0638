"""Online-count readings: dedupe (O1), code pivot (O2 / M3), PCU-ACU (O3), peak time."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.functions.numeric import avg_positive
from livemetrics.functions.timefn import parse_ts

# The period codes of the online-count log and what they add up to.
# 360 = outside viewers, 36 = inside viewers, 38 = inside viewers on encrypted streams.
ONLINE_CODES = {"outer_ol": (360,), "inner_ol": (36, 38), "encripted_ol": (38,)}
# The info codes of the daily room pv/uv log.
INFO_CODES = {"web_pv": (1,), "web_uv": (8,), "app_pv": (48,), "app_uv": (49,),
              "bullet_screen": (7,), "flower": (5,)}


def dedupe_readings(df: DataFrame, keys: Sequence[str] = ("day", "room_id", "category_id", "user_title", "period"),
                    value: str = "count", time: str = "time", group_raw_time: bool = False) -> DataFrame:
    """O1: one reading per (second, keys): the largest count.

    Times are emitted truncated to the second.  ``group_raw_time=True`` groups on the raw
    text instead, so two sub-second readings in one second stay two rows (as the job did).
    """
    if group_raw_time:
        g = df.groupBy(time, *keys).agg(F.max(value).alias(value))
        return g.select(parse_ts(time).alias(time), *keys, value)
    return (df.withColumn(time, parse_ts(time))
              .groupBy(time, *keys).agg(F.max(value).alias(value)))


def pivot_sum(df: DataFrame, keys: Sequence[str], code: str, value: str,
              mapping: Mapping[str, Sequence[int]]) -> DataFrame:
    """O2 / M3: conditional sums of ``value`` per output column, by code; unused codes dropped."""
    used = sorted({c for codes in mapping.values() for c in codes})
    aggs = [F.sum(F.when(F.col(code).isin(list(codes)), F.col(value)).otherwise(F.lit(0)))
            .cast("long").alias(name) for name, codes in mapping.items()]
    return df.where(F.col(code).isin(used)).groupBy(*keys).agg(*aggs)


def pivot_online(df: DataFrame, keys: Sequence[str] = ("day", "time", "room_id"), code: str = "period",
                 value: str = "count") -> DataFrame:
    """O2: outer / inner / encrypted concurrency per (time, room)."""
    return pivot_sum(df, keys, code, value, ONLINE_CODES)


PCU_ACU = {"outer_ol": ("pcu_out", "acu_out"), "inner_ol": ("pcu_in", "acu_in"),
           "encripted_ol": ("pcu_encrypted", "acu_encrypted")}


def peak_and_average(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple] = PCU_ACU,
                     time: str | None = None, peak_of: str = "inner_ol") -> DataFrame:
    """O3 (+O4): per keys, PCU = max, ACU = mean over samples > 0 (decimal(10,0), 0 if none).

    With ``time`` given, also the earliest time at which ``peak_of`` reaches its maximum
    (O4), computed in the same aggregation with ``min_by`` over (-value, time) instead of
    joining the readings back to their maximum.
    """
    aggs = []
    for m, (pcu, acu) in measures.items():
        aggs += [F.max(m).alias(pcu), avg_positive(m).alias(acu)]
    if time is not None:
        aggs.append(F.min_by(F.col(time), F.struct((-F.col(peak_of)).alias("v"), F.col(time).alias("t")))
                    .alias("peak_time"))
    return df.groupBy(*keys).agg(*aggs)


def peak_time(df: DataFrame, keys: Sequence[str], time: str = "time", value: str = "inner_ol") -> DataFrame:
    """Earliest time at which ``value`` equals its maximum within keys."""
    return df.groupBy(*keys).agg(
        F.max(value).alias("pcu_in"),
        F.min_by(F.col(time), F.struct((-F.col(value)).alias("v"), F.col(time).alias("t"))).alias("peak_time"))
