"""Audience reports: channel report (P4), traffic-source report (P5), users by category.

All three are set-based over days: ``day`` is a grouping key, so a backfill of a range is a
single job (and a single day is just a one-day input).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemetrics.functions.numeric import round_half_up, text_key
from livemetrics.functions.predicates import Source
from livemetrics.staging import stage
from livemetrics.operators.audience import (
    audience, bounce_rate, distinct_count, fan_in, label_sources, retention_rates, user_grain, visits,
)

# Fixed values of the channel report: the label of each page-view type.
CHANNEL_LABELS = {1: "内嵌", 2: "跳转"}

# Fixed values of the reports: the retention columns and their lags in days.
RETENTION = {"1_day_retention_rate": 1, "7_days_retention_rate": 7}

CHANNEL_COLUMNS = ["date", "channel_name", "ip", "uv", "pv", "stay_hours", "new_user_cnt",
                   "frequent_user_cnt", "frequent_user_ratio", "bounce_rate",
                   "1_day_retention_rate", "7_days_retention_rate"]


def _fmt_day(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def channel_report(track: DataFrame, day: str = "day", pv_type: str = "pv_type",
                   site_type: str = "site_type", user: str = "uuid", ip: str = "ip",
                   pv_types: Sequence[int] = (1, 2), is_new: Column | None = None) -> DataFrame:
    """Per day and channel (pv_type, site_type).  Missing bounce / retention stay NULL.

    ``is_new`` defaults to "first login on the same day" as in the channel job.
    """
    t = track.where(F.col(pv_type).isin(list(pv_types)))
    new = is_new if is_new is not None else (F.to_date(F.col("first_login_time")) == F.col(day))
    keys = [day, pv_type, site_type]
    # One shuffle of the raw track (to the visit grain, IP kept as a dimension); every
    # metric below is computed from that reduced frame.
    v = stage(visits(t, keys, user=user, is_new=new, extra=[ip]), "channel_visits")
    u = user_grain(v, keys, user=user)
    t1 = [audience(u, keys, user=user), distinct_count(v, keys, ip, "ip")]
    t2 = bounce_rate(v, keys, session_keys=[day, user, "session_id_in_day"])
    t3 = retention_rates(u, keys, RETENTION, user=user, day=day)
    j = fan_in([*t1, t2, t3], keys)
    label = F.when(F.col(pv_type) == 1, F.lit(CHANNEL_LABELS[1])).otherwise(F.lit(CHANNEL_LABELS[2]))
    return j.select(
        _fmt_day(day).alias("date"),
        F.concat(label, F.lit("_"), F.col(site_type)).alias("channel_name"),
        F.coalesce(F.col("ip"), F.lit(0)).cast("long").alias("ip"),
        "uv", "pv",
        round_half_up(F.col("stay_seconds") / 3600, 2).alias("stay_hours"),
        "new_user_cnt", "frequent_user_cnt", "frequent_user_ratio", "bounce_rate",
        "1_day_retention_rate", "7_days_retention_rate",
    )


SOURCE_COLUMNS = ["date", "create_time", "uv", "new_user_cnt", "frequent_user_cnt",
                  "frequent_user_ratio", "ip", "stay_seconds", "bounce_rate",
                  "1_day_retention_rate", "7_days_retention_rate"]


def source_reports(track: DataFrame, page_views: DataFrame, sources: Sequence[Source], load_time,
                   days: DataFrame | None = None, day: str = "day", user: str = "uuid",
                   ip: str = "ip", with_bounce: bool = True) -> DataFrame:
    """P5 for any number of traffic sources in one pass: one row per source (``type``) and day.

    The unique visitors, new users, stay, bounce and retention come from the track; the
    IP count from the raw page views.  ``days`` (one column ``day``) are the report days:
    each has a row per source, metrics without data being 0.  By default they are the days
    present in the track or the page views.  ``load_time`` is the load stamp written to
    ``create_time``.
    """
    keys = [day, "type"]
    # Rows of no source are dropped at the scan; what is shuffled is the sources' own traffic.
    t = label_sources(track, sources, out="type")
    v = stage(visits(t, keys, user=user, is_new=F.col("is_new") == 1), "source_visits")
    u = user_grain(v, keys, user=user)
    a = audience(u, keys, user=user)
    ips = distinct_count(label_sources(page_views, sources, out="type"), keys, ip, "ip")
    kept = retention_rates(u, keys, RETENTION, user=user, day=day)
    if days is None:
        days = track.select(day).unionByName(page_views.select(day)).distinct()
    spine = days.withColumn("type", F.explode(F.array(*[F.lit(s.name) for s in sources])))
    parts = [spine, a, ips, kept]
    cols = ["uv", "new_user_cnt", "frequent_user_cnt", "ip", "stay_seconds"]
    if with_bounce:
        parts.append(bounce_rate(v, keys, session_keys=["type", day, user, "session_id_in_day"]))
    j = fan_in(parts, keys)
    out = ["type", _fmt_day(day).alias("date"), F.lit(str(load_time)).alias("create_time")]
    out += [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cols[:3]]
    out += [F.coalesce(F.col("frequent_user_ratio"), F.lit(0.0)).alias("frequent_user_ratio")]
    out += [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cols[3:]]
    rates = (["bounce_rate"] if with_bounce else []) + ["1_day_retention_rate", "7_days_retention_rate"]
    out += [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in rates]
    return j.select(*out)


def source_report(track: DataFrame, page_views: DataFrame, source: Source, load_time,
                  days: DataFrame | None = None, **kw) -> DataFrame:
    """P5 for one source: one row per report day (see ``source_reports``)."""
    return source_reports(track, page_views, [source], load_time, days=days, **kw).drop("type")


def category_users(page_views: DataFrame, rooms: DataFrame, categories: DataFrame,
                   sources: Sequence[Source], load_time, day: str = "day", room: str = "sbt",
                   user: str = "uuid", min_room_len: int = 2) -> DataFrame:
    """Page views and unique viewers per day, source and room category.

    A view matching two sources counts for both; a view whose room has no category is
    kept under a NULL category.  The room key is text in the log and numeric in the
    dimension; text that is not a number matches nothing.
    """
    pv = page_views.where(F.length(F.col(room)) >= min_room_len)
    labelled = label_sources(pv, sources, out="type").select(
        day, "type", user, text_key(room).alias("_room"))
    # Pre-aggregate to (day, source, room, viewer) before the dimension join: a room with a
    # third of all views reaches the join as one partial row per viewer.
    per_room = labelled.groupBy(day, "type", "_room", user).agg(F.count(F.lit(1)).alias("_pv"))
    r = rooms.select(F.col("room_id").alias("_room"), F.col("category_id").alias("_cat"))
    c = categories.select(F.col("id").alias("cid"), F.col("domain").alias("cdomain"), "name")
    # Views without a numeric room match nothing: they go round the join, so their NULL key
    # is not one shuffle partition.  A room's category is looked up before the views meet it.
    rc = r.join(c, F.col("_cat") == F.col("cid"), "inner").select("_room", "cid", "cdomain", "name")
    known = per_room.where(F.col("_room").isNotNull()).join(rc, "_room", "left")
    none = per_room.where(F.col("_room").isNull())
    j = known.unionByName(none.withColumns({x: F.lit(None).cast(rc.schema[x].dataType) for x in ("cid", "cdomain", "name")}))
    keys = [day, "type", "cid", "cdomain", "name"]
    # Views per viewer and category, then per key: a viewer of two rooms of one category
    # counts once; NULL category keys group together as in SQL GROUP BY.
    res = (j.groupBy(*keys, user).agg(F.sum("_pv").alias("_pv"))
            .groupBy(*keys).agg(F.sum("_pv").cast("long").alias("pv"), F.count(user).alias("uv")))
    return res.select(_fmt_day(day).alias("date"), F.lit(str(load_time)).alias("create_time"),
                      "type", "cid", "cdomain", "name", "pv", "uv")
