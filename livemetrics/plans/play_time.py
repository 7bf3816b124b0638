"""Broadcast fact (I2-I6): per merged broadcast, the page views, concurrency, peak time,
revenue and watch metrics that fall inside it, plus the room's day metrics and dims.

Set-based: all broadcasts of all input days at once.  Events are attributed by time
alone, so a broadcast running past midnight collects the next day's events without a
two-day read per day.  Metrics are computed once per distinct interval (room, begin,
end) and joined back, so two broadcasts sharing an interval do not double anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemetrics.functions.predicates import valid_trades
from livemetrics.functions.timefn import (
    duration_minutes, fmt_day, fmt_ts, parse_epoch_ms, parse_epoch_s, parse_ts,
)
from livemetrics.operators import online
from livemetrics.operators.attribution import attribute
from livemetrics.functions.numeric import decimal0, round_half_up, safe_div, text_key
from livemetrics.operators.timeindex import interval_summaries
from livemetrics.operators.room import VALID_PLAY_MS, effective_play, room_revenue, watch_metrics
from livemetrics.plans.dims import room_dims
from livemetrics.staging import stage

IV = ["room_id", "begin_time", "end_time"]
SESSION_COLS = ["room_id", "domain", "begin_time", "end_time", "max_viewer", "accumulative_viewer_total",
                "from_qq", "live_permission", "live_source_type", "live_stream_type", "game_id",
                "game_name", "play_title", "is_live"]
# Fixed value: only first sends of a page view count as a view.
FIRST_SEND = 1
# A reading as one number that orders by count, then by earlier time: seconds fit 33 bits.
SECONDS = 1 << 33


def peak_code(count: Column, ts: Column) -> Column:
    return count * F.lit(SECONDS) + (F.lit(SECONDS - 1) - F.unix_seconds(ts))


def peak_code_time(code: Column) -> Column:
    return F.timestamp_seconds(F.lit(SECONDS - 1) - F.pmod(code, F.lit(SECONDS)))


def session_page_views(iv: DataFrame, page_views: DataFrame, bucket_s: int = 900) -> DataFrame:
    """Pv (views with send_count = 1) and uv (distinct viewers) per interval."""
    pv = page_views.where(F.col("send_count") == FIRST_SEND).select(
        text_key("sbt").alias("room_id"), parse_epoch_s("s_timestamp").alias("_ts"), "uuid")
    pairs = attribute(iv, pv, ["room_id"], "begin_time", "end_time", "_ts", bucket_s=bucket_s)
    per_user = pairs.groupBy(*IV, "uuid").agg(F.count(F.lit(1)).alias("_n"))
    return per_user.groupBy(*IV).agg(F.sum("_n").cast("long").alias("pv"), F.count("uuid").alias("uv"))


def session_concurrency(iv: DataFrame, online_counts: DataFrame, base_s: int = 60) -> DataFrame:
    """I3 + O5: PCU / ACU over the readings inside the interval and the earliest in-window
    time at the in-window inner maximum, from an index of time blocks: a broadcast reads a number of
    rows that grows with the logarithm of its length, not with its readings."""
    spec = {"_peak": (F.max, F.struct(F.col("inner_ol").alias("v"), (-F.unix_micros("_ts")).alias("t")))}
    for m in online.PCU_ACU:
        spec |= {f"_max_{m}": (F.max, F.col(m)), f"_sum_{m}": (F.sum, F.col(m)),
                 f"_pos_{m}": (F.sum, F.when(F.col(m) > 0, 1).otherwise(0))}
    oc = online_counts.select("room_id", F.col("time").alias("_ts"), *online.PCU_ACU)
    s = interval_summaries(iv, oc, ["room_id"], "begin_time", "end_time", "_ts", spec, base_s)
    out = [c for m, (pcu, acu) in online.PCU_ACU.items()
           for c in (F.col(f"_max_{m}").alias(pcu),
                     F.coalesce(decimal0(safe_div(F.col(f"_sum_{m}"), F.col(f"_pos_{m}"))), F.lit(0).cast("bigint")).alias(acu))]
    return s.select(*IV, *out, F.timestamp_micros(-F.col("_peak.t")).alias("peak_time"))


def session_revenue(iv: DataFrame, trades: DataFrame, bucket_s: int = 900) -> DataFrame:
    """I4: revenue of valid trades made inside the interval."""
    tr = trades.where(valid_trades()).select(
        "room_id", parse_ts("tr_date").alias("_ts"), "price", "item_num", "operator_id",
        "trade_status", "product_name", "item_id")
    pairs = attribute(iv, tr, ["room_id"], "begin_time", "end_time", "_ts", bucket_s=bucket_s)
    return room_revenue(pairs, IV)


def session_watch(iv: DataFrame, player_log: DataFrame, bucket_s: int = 900) -> DataFrame:
    """Watch metrics of plays that started inside the interval."""
    pl = effective_play(player_log).select(
        text_key(F.trim("roomid")).alias("room_id"), parse_epoch_ms("createtime").alias("_ts"),
        "deviceid", "play_duration")
    pairs = attribute(iv, pl, ["room_id"], "begin_time", "end_time", "_ts", bucket_s=bucket_s)
    return watch_metrics(pairs, IV)


PLAY_TIME_COLUMNS = [
    "date", "room_id", "user_id", "user_group", "category_id", "category_name", "category_domain",
    "domain", "begin_time", "end_time", "play_minutes", "max_viewer", "accumulative_viewer_total",
    "from_qq", "live_permission", "live_source_type", "live_stream_type", "game_id", "game_name",
    "play_title", "is_live", "web_pv", "web_uv", "app_pv", "app_uv", "pcu_out", "pcu_in",
    "pcu_encrypted", "acu_out", "acu_in", "acu_encrypted", "peak_time", "total_price",
    "total_item_num", "total_paying_user_num", "awt", "vv", "valid_vv", "play_duration", "vv_device",
    "valid_vv_device", "bullet_screen_num"]


def _tagged_events(page_views: DataFrame, online_counts: DataFrame, trades: DataFrame,
                   player_log: DataFrame) -> DataFrame:
    """The four event logs as one frame: room, time, log tag ``_t``, the id counted
    distinctly for that log ``_id`` (viewer, payer, device), and the log's measures."""
    pv = page_views.where(F.col("send_count") == FIRST_SEND).select(
        text_key("sbt").alias("room_id"), parse_epoch_s("s_timestamp").alias("_ts"),
        F.lit("pv").alias("_t"), F.col("uuid").cast("string").alias("_id"))
    oc = online_counts.select("room_id", F.col("time").alias("_ts"), F.lit("oc").alias("_t"),
                              F.lit(None).cast("string").alias("_id"), "outer_ol", "inner_ol", "encripted_ol")
    tr = trades.where(valid_trades()).select(
        "room_id", parse_ts("tr_date").alias("_ts"), F.lit("tr").alias("_t"),
        F.col("operator_id").cast("string").alias("_id"), "price", "item_num")
    pl = effective_play(player_log).select(
        text_key(F.trim("roomid")).alias("room_id"), parse_epoch_ms("createtime").alias("_ts"),
        F.lit("pl").alias("_t"), F.col("deviceid").cast("string").alias("_id"), "play_duration")
    return (pv.unionByName(oc, allowMissingColumns=True).unionByName(tr, allowMissingColumns=True)
              .unionByName(pl, allowMissingColumns=True))


def broadcast_metrics(iv: DataFrame, events: DataFrame, bucket_s: int = 900) -> DataFrame:
    """I2-I5 and O5 in one pass: a single band join of the tagged logs to the intervals,
    then two conditional aggregations - to (interval, log, id), then to the interval.
    Distinct viewers, payers and devices are the non-null ids of the second step."""
    pairs = attribute(iv, events, ["room_id"], "begin_time", "end_time", "_ts", bucket_s=bucket_s)
    pd = F.col("play_duration")
    g1 = pairs.groupBy(*IV, "_t", "_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(peak_code(F.col("inner_ol"), F.col("_ts"))).alias("_peak"),
        *[a for m in ("outer_ol", "inner_ol", "encripted_ol")
          for a in (F.max(m).alias(f"_max_{m}"), F.sum(m).alias(f"_sum_{m}"), F.count_if(F.col(m) > 0).alias(f"_pos_{m}"))],
        F.sum("price").alias("_price"), F.sum("item_num").alias("_items"),
        F.sum(pd).alias("_all"), F.sum(F.when(pd > 0, pd).otherwise(0)).alias("_posplay"),
        F.count_if(pd > 0).alias("_vv"), F.count_if(pd >= VALID_PLAY_MS).alias("_valid"))
    t = F.col("_t")
    has_id = F.col("_id").isNotNull()
    on = lambda tag, c: F.when(t == tag, c)
    vv_device = F.count_if((t == "pl") & has_id & (F.col("_vv") > 0))
    aggs = [F.sum(on("pv", F.col("_n"))).cast("long").alias("pv"),
            F.count_if((t == "pv") & has_id).alias("uv")]
    for m, (pcu, acu) in online.PCU_ACU.items():
        aggs += [F.max(on("oc", F.col(f"_max_{m}"))).alias(pcu),
                 decimal0(safe_div(F.sum(on("oc", F.col(f"_sum_{m}"))), F.sum(on("oc", F.col(f"_pos_{m}")))))
                 .alias(acu)]
    aggs += [round_half_up(F.sum(on("tr", F.col("_price"))), 2).alias("total_price"),
             F.sum(on("tr", F.col("_items"))).cast("int").alias("total_item_num"),
             F.count_if((t == "tr") & has_id).alias("total_paying_user_num"),
             decimal0(safe_div(F.sum(on("pl", F.col("_all"))), vv_device) / 1000 / 60).alias("awt"),
             F.sum(on("pl", F.col("_vv"))).cast("long").alias("vv"),
             F.sum(on("pl", F.col("_valid"))).cast("long").alias("valid_vv"),
             decimal0(F.sum(on("pl", F.col("_posplay"))) / 1000 / 60).alias("play_duration"),
             vv_device.alias("vv_device"),
             F.count_if((t == "pl") & has_id & (F.col("_valid") > 0)).alias("valid_vv_device")]
    # The earliest time at the highest inner count is the largest packed reading: a plain
    # maximum, so the aggregation stays hash-based and the pairs are read once.
    metrics = g1.groupBy(*IV).agg(F.max(on("oc", F.col("_peak"))).alias("_peak"), *aggs)
    return metrics.withColumn("peak_time", peak_code_time(F.col("_peak"))).drop("_peak")


def room_play_time(sessions: DataFrame, page_views: DataFrame, online_counts: DataFrame,
                   trades: DataFrame, player_log: DataFrame, pv_uv: DataFrame, rooms: DataFrame,
                   categories: DataFrame, bucket_s: int = 900) -> DataFrame:
    """The broadcast fact table (42 columns).

    ``sessions`` is the cleaned broadcast table (``clean_broadcasts``) with TIMESTAMP
    times and its ``day``; ``online_counts`` the per-(time, room) pivot.  Missing metrics
    are 0 except ``peak_time``.  ``bullet_screen_num`` is 0 by definition of the table.
    The four event logs go through one band join (``broadcast_metrics``).
    """
    # The broadcasts are read by two branches: stage them once (they are a small table next
    # to the event logs, and in production the cleaned broadcast table is already stored).
    s = stage(sessions.select("day", *SESSION_COLS).distinct(), "broadcasts")
    iv = s.select(*IV).distinct()
    metrics = broadcast_metrics(iv, _tagged_events(page_views, online_counts, trades, player_log), bucket_s)
    t6 = online.pivot_sum(pv_uv, ["day", "room_id"], "info_type", "count", online.INFO_CODES) \
        .select("day", "room_id", "app_pv", "app_uv")
    j = (s.join(metrics, IV, "left")
          .join(t6, ["day", "room_id"], "left")
          .join(room_dims(rooms, categories), "room_id", "left"))
    z = lambda c, d=0: F.coalesce(F.col(c), F.lit(d)).alias(c)
    return j.select(
        fmt_day("day").alias("date"), "room_id", "user_id", F.col("user_title").alias("user_group"),
        F.col("cid").alias("category_id"), F.col("cname").alias("category_name"),
        F.col("cdomain").alias("category_domain"), F.col("domain"),
        fmt_ts("begin_time").alias("begin_time"), fmt_ts("end_time").alias("end_time"),
        duration_minutes("begin_time", "end_time").alias("play_minutes"),
        "max_viewer", "accumulative_viewer_total", "from_qq", "live_permission", "live_source_type",
        "live_stream_type", "game_id", "game_name", "play_title", "is_live",
        F.coalesce(F.col("pv"), F.lit(0).cast("long")).alias("web_pv"),
        F.coalesce(F.col("uv"), F.lit(0).cast("long")).alias("web_uv"),
        z("app_pv"), z("app_uv"), z("pcu_out"), z("pcu_in"), z("pcu_encrypted"),
        z("acu_out"), z("acu_in"), z("acu_encrypted"),
        fmt_ts("peak_time").alias("peak_time"),
        z("total_price", 0.0), z("total_item_num"), z("total_paying_user_num"),
        z("awt"), z("vv"), z("valid_vv"), z("play_duration"), z("vv_device"), z("valid_vv_device"),
        F.lit(0).alias("bullet_screen_num"))
