"""

Every query reads the test tables of ``sf_dir`` whole, recast as the streaming site's logs
by ``livemetrics.sources.standins`` (the mapping is listed there and in the README).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries as oq
from livemetrics.functions.numeric import text_key, tier
from livemetrics.functions.predicates import Source, valid_trades
from livemetrics.functions.timefn import duration_minutes, fmt_day, fmt_ts, repair_interval, tag_replay
from livemetrics.operators import audience as aud
from livemetrics.operators import online, spend
from livemetrics.operators.room import (
    effective_play, room_broadcast, room_revenue, room_subscriptions, watch_metrics,
)
from livemetrics.plans import play_time, reports, room_flow, user_profile
from livemetrics.plans.dims import room_dims
from livemetrics.sources import standins as si
from livemetrics.staging import stage

try:                                       # the training-data subpackage is optional
    import corpus_pipeline
    from livemetrics.llm import queries as llm
except ModuleNotFoundError as e:           # it is not there; whatever it lacks itself is an error
    if e.name != "corpus_pipeline" and not (e.name or "").startswith("livemetrics.llm"):
        raise
    llm = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"


def sources() -> dict[str, Source]:
    """Traffic sources of the stand-in reports (regexes over the stand-in urls / tracking ids)."""
    return {
        "blog": Source.referrer_and_landing("blog", r"blog\.", "/en/"),
        "direct": Source.empty_or_referrer_and_landing("direct", r"^https://m\.", r"example\.com"),
        "tracked": Source.tracking_id("tracked", r"^(click|purchase)-1"),
    }


def _prep(spark: SparkSession) -> None:
    # Text and epoch times of the stand-in logs are UTC wall-clock times.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def q_channel_report(spark: SparkSession, d: str) -> DataFrame:
    _prep(spark)
    return reports.channel_report(si.pv_track(spark, d))


def _source_report(name: str, with_bounce: bool = True):
    def q(spark: SparkSession, d: str) -> DataFrame:
        _prep(spark)
        return reports.source_report(si.pv_track(spark, d), si.page_view(spark, d), sources()[name],
                                     load_time=oq.LOAD_TIME, with_bounce=with_bounce)
    return q


def q_category_users(spark: SparkSession, d: str) -> DataFrame:
    _prep(spark)
    return reports.category_users(si.page_view(spark, d), si.dim_room(spark, d), si.dim_category(spark, d),
                                  list(sources().values()), load_time=oq.LOAD_TIME)


BROADCAST_GAP_S = 21600  # stand-in segments are hours apart; merge within 6 h


def _fmt(df: DataFrame, days=("day",), times=()) -> DataFrame:
    for c in days:
        df = df.withColumn(c, fmt_day(c))
    for c in times:
        df = df.withColumn(c, fmt_ts(c))
    return df


def q_clean_broadcasts(spark, d):
    _prep(spark)
    m = room_flow.clean_broadcasts(si.broadcasts_raw(spark, d), max_gap_s=BROADCAST_GAP_S)
    return _fmt(m, times=("begin_time", "end_time"))


def q_clean_broadcasts_compat(spark, d):
    _prep(spark)
    m = room_flow.clean_broadcasts(si.broadcasts_raw(spark, d), max_gap_s=BROADCAST_GAP_S, compat=True)
    return _fmt(m, times=("begin_time", "end_time"))


def q_dedupe_readings(spark, d):
    _prep(spark)
    return _fmt(online.dedupe_readings(si.online_raw(spark, d)), times=("time",))


def q_room_online_count(spark, d):
    _prep(spark)
    return _fmt(room_flow.room_online_count(si.online_raw(spark, d)), times=("time",))


def q_room_concurrency(spark, d):
    _prep(spark)
    oc = room_flow.room_online_count(si.online_raw(spark, d))
    return _fmt(online.peak_and_average(oc, ["day", "room_id"], time="time"), times=("peak_time",))


def q_room_watch(spark, d):
    _prep(spark)
    plays = effective_play(si.player_log(spark, d)).select(
        F.try_to_date("date", "yyyyMMdd").alias("day"), text_key(F.trim("roomid")).alias("room_id"),
        "deviceid", "play_duration")
    return _fmt(watch_metrics(plays, ["day", "room_id"]))


def q_room_pv_uv(spark, d):
    _prep(spark)
    return _fmt(online.pivot_sum(si.room_pv_uv(spark, d), ["day", "room_id"], "info_type", "count",
                                 online.INFO_CODES))


def q_room_revenue_orders(spark, d):
    _prep(spark)
    return _fmt(room_revenue(si.trades_orders(spark, d), ["day", "room_id"]))


def q_room_broadcast(spark, d):
    _prep(spark)
    return _fmt(room_broadcast(si.broadcasts_raw(spark, d), ["day", "room_id"]))


def q_daily_room_flow(spark, d):
    _prep(spark)
    return room_flow.daily_room_flow(
        si.room_pv_uv(spark, d), room_flow.room_online_count(si.online_raw(spark, d)),
        si.trades_events(spark, d), si.subscription(spark, d), si.subscription_total(spark, d),
        si.player_log(spark, d), si.broadcasts_raw(spark, d), si.dim_room(spark, d), si.dim_category(spark, d))


def q_room_play_time(spark, d):
    _prep(spark)
    sessions = room_flow.clean_broadcasts(si.broadcasts_raw(spark, d), max_gap_s=BROADCAST_GAP_S)
    return play_time.room_play_time(
        sessions, si.page_view(spark, d), room_flow.room_online_count(si.online_raw(spark, d)),
        si.trades_events(spark, d), si.player_log(spark, d), si.room_pv_uv(spark, d),
        si.dim_room(spark, d), si.dim_category(spark, d))


def q_user_transaction(spark, d):
    _prep(spark)
    return user_profile.user_transaction(si.trades_orders(spark, d), oq.REPORT_DAY, oq.HISTORY_START)


def q_user_transaction_range(spark, d):
    _prep(spark)
    grain = user_profile.trade_grain(si.trades_orders(spark, d), oq.REPORT_DAY, oq.HISTORY_START)
    return user_profile.user_transaction_range(grain, oq.RANGE_START, oq.REPORT_DAY)


def q_rolling_spend_daily(spark, d):
    _prep(spark)
    t = si.trades_orders(spark, d).where(valid_trades())
    r = spend.rolling_spend_daily(spend.daily_totals(t))
    out = ["user_id", fmt_day("day").alias("day")]
    for c, p in (("day_total", "day_prange"), ("week_total", "week_prange"), ("month_total", "month_prange")):
        out += [c, tier(c).alias(p)]
    return r.select(*out)


def _channel_visits(spark, d):
    track = si.pv_track(spark, d).where(F.col("pv_type").isin(1, 2))
    keys = ["day", "pv_type", "site_type"]
    new = F.to_date("first_login_time") == F.col("day")
    return keys, aud.visits(track, keys, is_new=new, extra=["ip"])


def q_audience(spark, d):
    _prep(spark)
    keys, v = _channel_visits(spark, d)
    a = aud.fan_in([aud.audience(aud.user_grain(v, keys), keys), aud.distinct_count(v, keys, "ip", "ip")], keys)
    return _fmt(a.select(*keys, F.coalesce("ip", F.lit(0)).cast("long").alias("ip"), "uv", "pv",
                         F.col("stay_seconds").cast("long").alias("stay_seconds"), "new_user_cnt",
                         "frequent_user_cnt", "frequent_user_ratio"))


def q_bounce(spark, d):
    _prep(spark)
    keys, v = _channel_visits(spark, d)
    return _fmt(aud.bounce_rate(v, keys, ["day", "uuid", "session_id_in_day"]))


def q_retention(spark, d):
    _prep(spark)
    keys, v = _channel_visits(spark, d)
    u = aud.user_grain(v, keys)
    parts = [aud.retention(u, keys, n, alias="retention_rate").withColumn("n", F.lit(n)) for n in (1, 7)]
    return _fmt(parts[0].unionByName(parts[1])).select(*keys, "n", "retention_rate")


def _intervals(spark, d):
    """Distinct broadcast intervals (in production the cleaned broadcast table is stored)."""
    s = room_flow.clean_broadcasts(si.broadcasts_raw(spark, d), max_gap_s=BROADCAST_GAP_S)
    return s.select(*play_time.IV).distinct()


def _fmt_iv(df):
    return _fmt(df, days=(), times=("begin_time", "end_time"))


def q_session_page_views(spark, d):
    _prep(spark)
    iv = stage(_intervals(spark, d), "intervals")     # read by the attribution and the join back
    t1 = play_time.session_page_views(iv, si.page_view(spark, d))
    out = iv.join(t1, play_time.IV, "left").select(
        *play_time.IV, F.coalesce("pv", F.lit(0)).cast("long").alias("pv"),
        F.coalesce("uv", F.lit(0)).cast("long").alias("uv"))
    return _fmt_iv(out)


def q_session_concurrency(spark, d):
    _prep(spark)
    oc = room_flow.room_online_count(si.online_raw(spark, d))
    return _fmt(play_time.session_concurrency(_intervals(spark, d), oc), days=(),
                times=("begin_time", "end_time", "peak_time"))


def q_session_revenue(spark, d):
    _prep(spark)
    return _fmt_iv(play_time.session_revenue(_intervals(spark, d), si.trades_events(spark, d)))


def q_session_watch(spark, d):
    _prep(spark)
    return _fmt_iv(play_time.session_watch(_intervals(spark, d), si.player_log(spark, d)))


def _valid_orders(spark, d):
    return si.trades_orders(spark, d).where(valid_trades())


def q_extreme_days(spark, d):
    _prep(spark)
    e = spend.extreme_days(spend.daily_totals(_valid_orders(spark, d)))
    return _fmt(e, days=("most_spent_day", "first_spent_day", "last_spent_day"))


def q_top5_items(spark, d):
    _prep(spark)
    return spend.top_k_string(_valid_orders(spark, d), "user_id", "item_id", "item_num", alias="top5_item")


def q_top5_rooms(spark, d):
    _prep(spark)
    return spend.top_k_string(_valid_orders(spark, d), "user_id", "room_id", "price", alias="top5_room",
                              value_format=lambda c: F.round(c, 2))


def q_room_subscriptions(spark, d):
    _prep(spark)
    k = ["day", "room_id"]
    daily = room_subscriptions(si.subscription(spark, d), k)
    tot = si.subscription_total(spark, d)
    out = tot.join(daily, k, "left").select(
        *k, F.coalesce("daily_subscription", F.lit(0)).alias("daily_subscription_num"),
        F.col("count").alias("total_subscription_num"))
    return _fmt(out)


def q_repaired_intervals(spark, d):
    _prep(spark)
    raw = si.broadcasts_raw(spark, d).where(F.col("room_id").isNotNull())
    r = repair_interval(raw, "begin_time", "end_time")
    out = r.select("day", "room_id", "game_id", "begin_time", "end_time", tag_replay("play_title").alias("is_live"),
                   duration_minutes("begin_time", "end_time").alias("play_minutes"))
    return _fmt(out, times=("begin_time", "end_time"))


def q_rolling_spend(spark, d):
    _prep(spark)
    r = spend.rolling_spend(_valid_orders(spark, d), oq.REPORT_DAY)
    out = ["user_id"]
    for c, p in (("day_total", "day_prange"), ("week_total", "week_prange"), ("month_total", "month_prange")):
        out += [c, tier(c).alias(p)]
    return r.select(*out)


def q_effective_play(spark, d):
    _prep(spark)
    p = effective_play(si.player_log(spark, d))
    return p.select("date", text_key(F.trim("roomid")).alias("room_id"), "deviceid", "createtime",
                    "play_duration")


def q_source_views(spark, d):
    _prep(spark)
    lab = aud.label_sources(si.page_view(spark, d), list(sources().values()), out="type")
    per_viewer = lab.groupBy("day", "type", "uuid").agg(F.count(F.lit(1)).alias("_n"))
    out = per_viewer.groupBy("day", "type").agg(F.sum("_n").cast("long").alias("pv"), F.count("uuid").alias("uv"))
    return _fmt(out)


def q_room_dims(spark, d):
    _prep(spark)
    return room_dims(si.dim_room(spark, d), si.dim_category(spark, d))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily channel report over every day of the sf0.001 tables."""
    return q_channel_report(spark, SMOKE_DIR)


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The site's own jobs and operators (without the optional subpackage)."""
    return {
        "p4_channel_report": q_channel_report,
        "p5_source_report_blog": _source_report("blog"),
        "p5_source_report_direct": _source_report("direct"),
        "p5_source_report_tracked": _source_report("tracked", with_bounce=False),
        "p7_category_users": q_category_users,
        "s1_clean_broadcasts": q_clean_broadcasts,
        "o1_dedupe_readings": q_dedupe_readings,
        "o2_room_online_count": q_room_online_count,
        "o3_o4_room_concurrency": q_room_concurrency,
        "m2_room_watch": q_room_watch,
        "m3_room_pv_uv": q_room_pv_uv,
        "m4_room_revenue": q_room_revenue_orders,
        "m6_room_broadcast": q_room_broadcast,
        "m7_daily_room_flow": q_daily_room_flow,
        "i6_room_play_time": q_room_play_time,
        "u5_user_transaction": q_user_transaction,
        "u5_user_transaction_range": q_user_transaction_range,
        "u1_rolling_spend_daily": q_rolling_spend_daily,
        "p1_audience": q_audience,
        "p2_bounce_rate": q_bounce,
        "p3_retention": q_retention,
        "i2_session_page_views": q_session_page_views,
        "i3_o5_session_concurrency": q_session_concurrency,
        "i4_session_revenue": q_session_revenue,
        "i5_session_watch": q_session_watch,
        "u3_extreme_days": q_extreme_days,
        "u4_top5_items": q_top5_items,
        "u4_top5_rooms": q_top5_rooms,
        "m5_room_subscriptions": q_room_subscriptions,
        "s2_s3_s4_repaired_intervals": q_repaired_intervals,
        "u1_u2_rolling_spend": q_rolling_spend,
        "m1_effective_play": q_effective_play,
        "d1_room_dims": q_room_dims,
        "s1_clean_broadcasts_compat": q_clean_broadcasts_compat,
        "p6_source_views": q_source_views,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return own_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def own_oracle_sql() -> dict[str, str]:
    return {
        "p4_channel_report": oq.channel_report(),
        "p5_source_report_blog": oq.source_report("blog"),
        "p5_source_report_direct": oq.source_report("direct"),
        "p5_source_report_tracked": oq.source_report("tracked", with_bounce=False),
        "p7_category_users": oq.category_users(),
        "s1_clean_broadcasts": oq.clean_broadcasts(),
        "o1_dedupe_readings": oq.dedupe_readings(),
        "o2_room_online_count": oq.room_online_count(),
        "o3_o4_room_concurrency": oq.room_concurrency(),
        "m2_room_watch": oq.room_watch(),
        "m3_room_pv_uv": oq.room_pv_uv(),
        "m4_room_revenue": oq.room_revenue_orders(),
        "m6_room_broadcast": oq.room_broadcast(),
        "m7_daily_room_flow": oq.daily_room_flow(),
        "i6_room_play_time": oq.room_play_time(),
        "u5_user_transaction": oq.user_transaction(),
        "u5_user_transaction_range": oq.user_transaction_range(),
        "u1_rolling_spend_daily": oq.rolling_spend_daily(),
        "p1_audience": oq.audience_counters(),
        "p2_bounce_rate": oq.bounce(),
        "p3_retention": oq.retention_rates(),
        "i2_session_page_views": oq.session_page_views(),
        "i3_o5_session_concurrency": oq.session_concurrency(),
        "i4_session_revenue": oq.session_revenue(),
        "i5_session_watch": oq.session_watch(),
        "u3_extreme_days": oq.extreme_days(),
        "u4_top5_items": oq.top5("item"),
        "u4_top5_rooms": oq.top5("room"),
        "m5_room_subscriptions": oq.room_subscriptions(),
        "s2_s3_s4_repaired_intervals": oq.repaired_intervals(),
        "u1_u2_rolling_spend": oq.rolling_spend_report_day(),
        "m1_effective_play": oq.effective_play(),
        "d1_room_dims": oq.room_dims(),
        "s1_clean_broadcasts_compat": oq.clean_broadcasts_compat(),
        "p6_source_views": oq.source_views(),
    }


def oracle_sql() -> dict[str, str]:
    more = llm.oracle_sql() if llm else {}
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        more = more | {"pipeline": corpus_pipeline.ORACLE_SQL}
    return own_oracle_sql() | more
