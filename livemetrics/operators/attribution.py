"""Attach events to the sessions of the same key whose [start, end] contains them.

A band join on time inside an equi join on the key.  Joining on the key alone makes a
busy room a single task that compares every event with every session of the room; here
both sides also carry a time bucket:

* a session is laid out over buckets of two widths: whole coarse buckets (a day) where it
  covers them, fine ones for the rest of its first and last day;
* an event falls in one fine and one coarse bucket.

The equi join runs on (key, width, bucket) with the inclusive band as a residual filter.
A session has at most one row per bucket and no fine bucket inside a coarse one it has, so
no pair is produced twice, and a session of any length - a corrupt end far in the future, a
stream of many days - costs one row per day.  Nothing is dropped, capped or switched by
size, and building the query runs no job.

A busy room spreads over its buckets, and AQE's skew-join splitting deals a busy partition to
several tasks.  ``salt`` further splits every (key, bucket) at a fixed cost: events are dealt into
``salt`` parts by hash and every session row is repeated for each, so it is for few sessions only.

Both sides are shuffled (a merge join).  Spark sizes the laid-out sessions by their input, before
the rows of the layout, and so would collect them on the driver and broadcast them when they are
many times the broadcast threshold.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE = 96                                  # fine buckets per coarse bucket


def _layout(b0: Column, b1: Column) -> Column:
    """Buckets of a session whose fine buckets are ``b0`` .. ``b1``: array of (width, bucket)."""
    c0, c1 = F.ceil(b0 / COARSE), F.floor((b1 + 1) / COARSE) - 1      # coarse buckets wholly inside
    whole = c1 >= c0
    fine = lambda a, b: F.when(b >= a, F.transform(
        F.sequence(a, b), lambda x: F.struct(F.lit(0).alias("w"), x.alias("b")))).otherwise(F.array())
    coarse = F.transform(F.sequence(c0, c1), lambda x: F.struct(F.lit(1).alias("w"), x.alias("b")))
    return F.when(whole, F.concat(fine(b0, c0 * COARSE - 1), coarse, fine((c1 + 1) * COARSE, b1))) \
            .otherwise(fine(b0, b1))


def attribute(sessions: DataFrame, events: DataFrame, key: Sequence[str], start: str, end: str,
              ts: str, bucket_s: int = 900, salt: int = 1) -> DataFrame:
    """Inner band join: one row per (session, event) with ``start <= ts <= end``.

    Output: all session columns, then the event columns except the key (the event key
    equals the session key).  Column names other than the key must not clash.
    """
    key = list(key)
    clash = (set(sessions.columns) & set(events.columns)) - set(key)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    b0 = F.floor(F.unix_seconds(F.col(start)) / bucket_s)
    b1 = F.floor(F.unix_seconds(F.col(end)) / bucket_s)
    s = (sessions.where(F.col(start) <= F.col(end)).withColumn("_at", F.explode(_layout(b0, b1)))
                 .withColumn("_w", F.col("_at.w")).withColumn("_bk", F.col("_at.b")).drop("_at"))
    fine = F.floor(F.unix_seconds(F.col(ts)) / bucket_s)
    e = events.select(*[F.col(k).alias(f"_ek_{k}") for k in key],
                      *[c for c in events.columns if c not in key],
                      F.explode(F.array(F.struct(F.lit(0).alias("w"), fine.alias("b")),
                                        F.struct(F.lit(1).alias("w"), F.floor(fine / COARSE).alias("b")))).alias("_eat"))
    cond = [s[k] == e[f"_ek_{k}"] for k in key] + [s["_w"] == e["_eat"]["w"], s["_bk"] == e["_eat"]["b"]]
    drop = ["_w", "_bk", "_eat", *[f"_ek_{k}" for k in key]]
    if salt > 1:
        s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        e = e.withColumn("_esalt", F.pmod(F.xxhash64(*[c for c in events.columns if c not in key]), F.lit(salt)).cast("int"))
        cond = [s[k] == e[f"_ek_{k}"] for k in key] + [
            s["_w"] == e["_eat"]["w"], s["_bk"] == e["_eat"]["b"], s["_salt"] == e["_esalt"]]
        drop += ["_salt", "_esalt"]
    cond.append(e[ts].between(s[start], s[end]))
    return s.hint("merge").join(e, cond, "inner").drop(*drop)
