"""Audience metrics over a page-view track (P1 counters, P2 bounce, P3 retention, P7 sources).

Every operator takes the grouping ``keys`` (normally ``day`` plus channel columns), so one
call computes all days of a range at once.  Distinct counts are done in two aggregation
steps (first to the user grain, then to the key grain) instead of several
``count(DISTINCT ..)`` in one ``Aggregate``: each step aggregates partially before its
shuffle, so a huge channel or a bot-like user never lands whole on one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livemetrics.functions.numeric import round_half_up, safe_div
from livemetrics.functions.predicates import Source


def visits(track: DataFrame, keys: Sequence[str], user: str = "uuid", session: str = "session_id_in_day",
           seq: str = "seq_no_in_session", stay: str = "page_stay", is_new: Column | None = None,
           extra: Sequence[str] = ()) -> DataFrame:
    """Reduce the raw track to one row per (keys, user, session, *extra): the single
    shuffle of the raw rows that counters, bounce, retention (and with ``extra=["ip"]``
    the IP count) are all computed from.  ``is_new`` is a boolean column expression."""
    new = (is_new if is_new is not None else F.col("is_new") == 1)
    return (track.groupBy(*keys, user, session, *extra)
                 .agg(F.count(F.lit(1)).alias("_pv"),
                      F.sum(stay).alias("_stay"),
                      F.max(seq).alias("_max_seq"),
                      F.max(F.when(new, 1).otherwise(0)).alias("_new")))


def user_grain(v: DataFrame, keys: Sequence[str], user: str = "uuid") -> DataFrame:
    """One row per (keys, user) from ``visits``; shared by the counters and retention."""
    return (v.groupBy(*keys, user)
             .agg(F.sum("_pv").alias("_pv"), F.sum("_stay").alias("_stay"), F.max("_new").alias("_new")))


def audience(u: DataFrame, keys: Sequence[str], user: str = "uuid") -> DataFrame:
    """P1 counters from ``user_grain``: pv, uv, new users, stay seconds, frequent users, ratio."""
    a = (u.groupBy(*keys)
         .agg(F.count(F.col(user)).alias("uv"),
              F.count(F.when(F.col("_new") == 1, F.col(user))).alias("new_user_cnt"),
              F.sum("_pv").cast("long").alias("pv"),
              F.sum("_stay").alias("stay_seconds")))
    return (a.withColumn("frequent_user_cnt", F.col("uv") - F.col("new_user_cnt"))
             .withColumn("frequent_user_ratio",
                         round_half_up(safe_div(F.col("uv") - F.col("new_user_cnt"), F.col("uv")), 4)))


def distinct_count(df: DataFrame, keys: Sequence[str], col: str, alias: str) -> DataFrame:
    """count(DISTINCT col) per keys as dedupe-then-count (two partial aggregations)."""
    return (df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
              .groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)))


def bounce_rate(v: DataFrame, keys: Sequence[str], session_keys: Sequence[str]) -> DataFrame:
    """Share of sessions whose highest sequence number is 1.

    The highest sequence number is taken over the whole session (``session_keys``, e.g.
    day, user, session id), not per channel: a session that crossed two channels is
    judged on all its views in both.  The window runs on the visit grain, where a
    session has one row per channel it touched.
    """
    grain = list(dict.fromkeys([*keys, *session_keys]))
    per_session = v.groupBy(*grain).agg(F.max("_max_seq").alias("_max_seq"))
    w = Window.partitionBy(*session_keys)
    s = per_session.select(*grain, F.max("_max_seq").over(w).alias("_smax"))
    return (s.groupBy(*keys)
             .agg(round_half_up(safe_div(F.count_if(F.col("_smax") == 1), F.count(F.lit(1))), 4)
                  .alias("bounce_rate")))


def activity_bitmaps(u: DataFrame, keys: Sequence[str], user: str = "uuid", day: str = "day") -> DataFrame:
    """Per user, group and block of 32 days: ``active``, a 64-bit map of the active days of the block
    and of the 32 days after it, and ``new``, the days of the block on which the user was new.

    One aggregation by ``bit_or``: a day sets its bit in its own block and, 32 places up, in the block
    before, so every later day up to 32 days ahead is read from the same word by a shift.
    """
    others = [k for k in keys if k != day]
    number = F.unix_date(F.col(day))
    block, place = F.floor(number / 32), F.pmod(number, F.lit(32))
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))
    words = F.array(
        F.struct(block.alias("_block"), bit(place).alias("_active"),
                 F.when(F.col("_new") == 1, bit(place)).otherwise(F.lit(0).cast("long")).alias("_fresh")),
        F.struct((block - 1).alias("_block"), bit(place + 32).alias("_active"), F.lit(0).cast("long").alias("_fresh")))
    return (u.select(*others, user, F.inline(words)).groupBy(*others, user, "_block")
             .agg(F.bit_or("_active").alias("active"), F.bit_or("_fresh").alias("new")))


def retention_rates(u: DataFrame, keys: Sequence[str], lags: dict[str, int], user: str = "uuid",
                    day: str = "day") -> DataFrame:
    """P3 for several lags in one pass: new users of day D-n that are active again on D, over all new
    users of D-n, for every ``lags`` entry (column -> n, at most 32 days).

    ``u`` is the ``user_grain`` frame.  Result keyed by the report day D (``day``) and the other
    ``keys``; a rate without a cohort is NULL.  Users with a NULL id drop out of both counts, and a
    NULL group key finds nobody again, as in a join.
    """
    if any(not 1 <= n <= 32 for n in lags.values()):
        raise ValueError("a lag is 1 to 32 days")
    others = [k for k in keys if k != day]
    maps = activity_bitmaps(u, keys, user, day).where("new <> 0")
    cohort = maps.select(*others, F.col(user).isNotNull().alias("_known"), "_block", "active", "new",
                         F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_i"))
    cohort = cohort.where(F.expr("(shiftright(new, _i) & 1) = 1"))
    can_return = F.col("_known")
    for c in others:
        can_return = can_return & F.col(c).isNotNull()
    seen = {name: can_return & F.expr(f"(shiftright(active, _i + {n}) & 1) = 1") for name, n in lags.items()}
    counts = cohort.groupBy(*others, "_block", "_i").agg(
        F.count_if("_known").alias("_cohort"), *[F.count_if(c).alias(f"_{name}") for name, c in seen.items()])
    first = F.date_from_unix_date((F.col("_block") * 32 + F.col("_i")).cast("int"))
    rows = F.array(*[F.struct(F.date_add(first, n).alias(day), *[
        (round_half_up(safe_div(F.col(f"_{x}"), F.col("_cohort")), 4) if x == name else F.lit(None).cast("double")).alias(x)
        for x in lags]) for name, n in lags.items()])
    out = counts.select(*others, F.inline(rows))
    return out.groupBy(day, *others).agg(*[F.max(x).alias(x) for x in lags])


def retention(u: DataFrame, keys: Sequence[str], n: int, user: str = "uuid", day: str = "day",
              alias: str | None = None) -> DataFrame:
    """P3 for one lag (see ``retention_rates``)."""
    return retention_rates(u, keys, {alias or f"{n}_day_retention_rate": n}, user, day)


def label_sources(df: DataFrame, sources: Sequence[Source], out: str = "type") -> DataFrame:
    """One scan, one output row per matched source (a row can match several)."""
    any_match = None
    for s in sources:
        any_match = s.condition if any_match is None else (any_match | s.condition)
    labels = F.array(*[F.when(s.condition, F.lit(s.name)) for s in sources])
    return (df.where(any_match)
              .withColumn(out, F.explode(F.filter(labels, lambda x: x.isNotNull()))))


def fan_in(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Metrics of several frames (one row per key each, disjoint metric columns) side by side, for
    the keys of the first frame; NULL keys match each other.

    A union and one grouping instead of a chain of null-safe joins: grouping treats NULL keys
    as equal by itself, so there is one exchange of already reduced rows however many frames.
    """
    cols = [c for f in frames for c in f.columns if c not in keys]
    u = None
    for i, f in enumerate(frames):
        f = f.withColumn("_left", F.lit(i == 0))
        u = f if u is None else u.unionByName(f, allowMissingColumns=True)
    return (u.groupBy(*keys).agg(F.max("_left").alias("_left"), *[F.max(c).alias(c) for c in cols])
             .where("_left").drop("_left"))
