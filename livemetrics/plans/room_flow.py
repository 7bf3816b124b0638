"""Room jobs: broadcast cleaning (ods play time), online counts, daily room flow (M7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from livemetrics.functions.numeric import text_key, text_long
from livemetrics.functions.timefn import fmt_day, fmt_ts, parse_compact_day, repair_interval, tag_replay
from livemetrics.operators import online
from livemetrics.operators.room import (
    effective_play, room_broadcast, room_revenue, room_subscriptions, watch_metrics,
)
from livemetrics.operators.sessions import merge_adjacent
from livemetrics.plans.dims import room_dims

PLAY_TIME_COLUMNS = ["day", "room_id", "domain", "begin_time", "end_time", "max_viewer",
                     "accumulative_viewer_total", "execute_times", "begin_flower_count",
                     "end_flower_count", "from_qq", "live_permission", "live_source_type",
                     "live_stream_type", "game_id", "game_name", "play_title", "is_live"]


def clean_broadcasts(raw: DataFrame, max_gap_s: int = 300, bucket_s: int = 3600,
                     day_wrap: bool = False, compat: bool = False,
                     collapse_title_spaces: bool = False) -> DataFrame:
    """ods play-time ETL: repair times (S2), tag replays (S3), merge segments per room-day.

    Output keeps TIMESTAMP times; the 18 columns of the contract in their order.
    ``compat=True`` reproduces the original merge script (see ``merge_adjacent``);
    ``collapse_title_spaces=True`` trims titles and collapses runs of whitespace to one
    space, as the script's text protocol did.
    """
    r = raw.where(F.col("room_id").isNotNull() & F.col("day").isNotNull())
    if collapse_title_spaces:
        r = r.withColumn("play_title", F.regexp_replace(F.trim(F.col("play_title")), r"\s+", " "))
    # Keys are non-null from here on; say so in the schema (coalesce is a no-op on the
    # values) so the merge joins on plain equality and keeps its partitioning.
    day_fill = dt.date(1970, 1, 1) if isinstance(r.schema["day"].dataType, DateType) else "1970-01-01"
    r = (r.withColumn("room_id", F.coalesce(F.col("room_id"), F.lit(0).cast("long")))
          .withColumn("day", F.coalesce(F.col("day"), F.lit(day_fill))))
    r = repair_interval(r, "begin_time", "end_time")
    r = (r.withColumn("is_live", tag_replay("play_title"))
          .withColumn("begin_flower_count", F.coalesce(text_long("begin_flower_count"), F.lit(0)))
          .withColumn("end_flower_count", F.coalesce(text_long("end_flower_count"), F.lit(0))))
    m = merge_adjacent(
        r, key=["day", "room_id"], label="play_title", start="begin_time", end="end_time",
        max_gap_s=max_gap_s, sums=["accumulative_viewer_total", "execute_times"],
        maxs=["max_viewer", "end_flower_count"], mins=["begin_flower_count"],
        firsts=["domain", "from_qq", "live_permission", "live_source_type", "live_stream_type",
                "game_id", "game_name", "is_live"],
        order_extra=["game_id"], bucket_s=bucket_s, day_wrap=day_wrap, compat=compat)
    return m.select(*PLAY_TIME_COLUMNS)


def room_online_count(readings: DataFrame) -> DataFrame:
    """dw_room_online_count: dedupe raw readings (O1) and pivot the period codes (O2)."""
    return online.pivot_online(online.dedupe_readings(readings))


FLOW_COLUMNS = ["date", "room_id", "domain", "user_id", "user_group", "category_id", "category_name",
                "category_domain", "web_pv", "web_uv", "app_pv", "app_uv", "bullet_screen_num",
                "flower_num", "peak_time", "pcu_out", "pcu_in", "pcu_encrypted", "acu_out", "acu_in",
                "acu_encrypted", "total_price", "total_item_num", "total_paying_user_num",
                "daily_subscription_num", "total_subscription_num", "vv", "valid_vv", "awt",
                "play_minutes", "is_broadcast", "play_duration", "vv_device", "valid_vv_device"]


def daily_room_flow(pv_uv: DataFrame, online_counts: DataFrame, trades: DataFrame, subs: DataFrame,
                    subs_total: DataFrame, player_log: DataFrame, broadcasts_raw: DataFrame,
                    rooms: DataFrame, categories: DataFrame, acu_default: int = 1,
                    compat_inverted: bool = False) -> DataFrame:
    """M7: one row per room and day present in the pv/uv log, every metric fanned in.

    Each side is aggregated to (day, room_id) before the joins, so all joins are
    one-to-one on the key.  Rooms without concurrency get PCU 0 and ACU ``acu_default``
    (1, as the job wrote); other missing metrics are 0, peak time stays NULL.
    """
    k = ["day", "room_id"]
    k1 = online.pivot_sum(pv_uv, k, "info_type", "count", online.INFO_CODES)
    k2 = online.peak_and_average(online_counts, k, time="time")
    k4 = room_revenue(trades, k)
    k5 = room_subscriptions(subs, k)
    plays = effective_play(player_log).select(
        parse_compact_day("date").alias("day"), text_key(F.trim("roomid")).alias("room_id"),
        "deviceid", "play_duration")
    k6 = watch_metrics(plays, k)
    k7 = room_broadcast(broadcasts_raw, k, compat=compat_inverted)
    k8 = subs_total.select("day", "room_id", F.col("count").alias("total_subscription_num"))
    j = (k1.join(k2, k, "left").join(k4, k, "left").join(k5, k, "left").join(k6, k, "left")
           .join(k7, k, "left").join(k8, k, "left"))
    j = j.join(room_dims(rooms, categories), "room_id", "left")
    z = lambda c, d=0: F.coalesce(F.col(c), F.lit(d))
    return j.select(
        fmt_day("day").alias("date"), "room_id", F.col("rdomain").alias("domain"), "user_id", F.col("user_title").alias("user_group"),
        F.col("cid").alias("category_id"), F.col("cname").alias("category_name"),
        F.col("cdomain").alias("category_domain"),
        "web_pv", "web_uv", "app_pv", "app_uv", F.col("bullet_screen").alias("bullet_screen_num"),
        F.col("flower").alias("flower_num"), fmt_ts("peak_time").alias("peak_time"),
        z("pcu_out").alias("pcu_out"), z("pcu_in").alias("pcu_in"), z("pcu_encrypted").alias("pcu_encrypted"),
        z("acu_out", acu_default).alias("acu_out"), z("acu_in", acu_default).alias("acu_in"),
        z("acu_encrypted", acu_default).alias("acu_encrypted"),
        z("total_price", 0.0).alias("total_price"), z("total_item_num").alias("total_item_num"),
        z("total_paying_user_num").alias("total_paying_user_num"),
        z("daily_subscription").alias("daily_subscription_num"),
        z("total_subscription_num").alias("total_subscription_num"),
        z("vv").alias("vv"), z("valid_vv").alias("valid_vv"), z("awt").alias("awt"),
        z("play_minutes", 0.0).alias("play_minutes"),
        F.when(F.col("play_minutes").isNull(), 0).otherwise(1).alias("is_broadcast"),
        z("play_duration").alias("play_duration"), z("vv_device").alias("vv_device"),
        z("valid_vv_device").alias("valid_vv_device"))
