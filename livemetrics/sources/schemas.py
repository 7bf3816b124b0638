"""Schemas of the raw inputs (types inferred from use) and of the report tables."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _s(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


S, L, I, D = StringType(), LongType(), IntegerType(), DoubleType()

PLAY_TIME_RAW = _s(("day", S), ("room_id", L), ("domain", S), ("begin_time", S), ("end_time", S),
                   ("max_viewer", L), ("accumulative_viewer_total", L), ("execute_times", L),
                   ("begin_flower_count", S), ("end_flower_count", S), ("from_qq", S),
                   ("live_permission", S), ("live_source_type", S), ("live_stream_type", S),
                   ("game_id", S), ("game_name", S), ("play_title", S))
ONLINE_RAW = _s(("day", S), ("time", S), ("room_id", L), ("category_id", L), ("user_title", S),
                ("period", I), ("count", L))
ROOM_PV_UV = _s(("day", S), ("room_id", L), ("info_type", I), ("count", L))
TRADE = _s(("day", S), ("tr_date", S), ("room_id", L), ("user_id", L), ("operator_id", L),
           ("item_id", L), ("item_num", L), ("price", D), ("trade_status", I), ("product_name", S))
SUBSCRIPTION = _s(("day", S), ("room_id", L), ("actived", I))
SUBSCRIPTION_TOTAL = _s(("day", S), ("room_id", L), ("count", L))
PAGE_VIEW = _s(("day", S), ("s_timestamp", S), ("sbt", S), ("uuid", S), ("send_count", I), ("ip", S),
               ("source_url", S), ("url", S), ("tid", S))
PLAYER_LOG = _s(("date", S), ("roomid", S), ("deviceid", S), ("ip", S), ("ostype", S),
                ("playduration", S), ("stuckduration", S), ("createtime", S))
PV_TRACK = _s(("day", S), ("pv_type", I), ("site_type", S), ("uuid", S), ("ip", S),
              ("first_login_time", S), ("page_stay", L), ("session_id_in_day", L),
              ("seq_no_in_session", L), ("source_url", S), ("url", S), ("tid", S), ("is_new", I))
DIM_ROOM = _s(("room_id", L), ("domain", S), ("user_id", L), ("user_title", S), ("category_id", L))
DIM_CATEGORY = _s(("id", L), ("name", S), ("domain", S))


def _commented(cols):
    fields = []
    for name, typ, comment in cols:
        md = {"comment": comment} if comment else {}
        fields.append(StructField(name, typ, True, metadata=md))
    return StructType(fields)


# Report tables with typed columns and comments.
SOURCE_REPORT = _commented([
    ("date", S, None), ("create_time", S, None), ("uv", L, None),
    ("new_user_cnt", L, "new users"), ("frequent_user_cnt", L, "returning users"),
    ("frequent_user_ratio", D, "returning-user share"), ("ip", L, None),
    ("stay_seconds", L, "time on site"), ("bounce_rate", D, "bounce rate"),
    ("1_day_retention_rate", D, "next-day retention"), ("7_days_retention_rate", D, "7-day retention"),
])
CATEGORY_REPORT = _commented([
    ("date", S, None), ("create_time", S, None), ("type", S, "source"), ("cid", L, "category id"),
    ("cdomain", S, "category domain"), ("name", S, "category name"), ("pv", L, None),
    ("uv", L, "users"),
])
