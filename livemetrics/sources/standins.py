"""The test tables recast as the streaming site's logs.

The driver's tables are not streaming-site logs, so each role is derived from them with
plain DataFrame expressions (no sampling, no row caps; every row of the source table
feeds the role).  ``k`` is the integer in ``events.props``.

| Role                 | Derived from                                                        |
|----------------------|---------------------------------------------------------------------|
| broadcast segments   | every event: room = user_id, title = event_type, begin = ts,        |
|                      | end = ts + value minutes (k=0: open end, k=1: end before begin)     |
| online readings      | every event: hourly tick, room = user_id, period code by type       |
| room pv/uv codes     | every event: info code by type, count = k                           |
| page-view track      | every event: uuid = user_id, channel = (k<50 ? 1 : 2, event_type),  |
|                      | landing url = pages.url of page k, referrer = previous url in the   |
|                      | hour session, first login = user's first event                      |
| raw page views       | every event: room = user_id (k=13: no number, 14/15: with fraction), |
|                      | viewer = "v"+k                                                      |
| player log           | every event: play = value minutes, stuck = k seconds (k=0: NaN)     |
| gift trades          | purchase events (per room / session), orders x lineitem (per user)  |
| subscriptions        | signup events, active when k < 80                                   |
| room / category dims | customer / nation                                                   |
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EPOCH_TEXT = "1970-01-01 00:00:00"


_READERS: dict = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a DataFrame, opened once per Spark application (file listing and
    Parquet footers are read once, not by every role derived from it)."""
    path = f"{sf_dir}/{name}.parquet"
    k = (spark.sparkContext.applicationId, path)
    if k not in _READERS:
        _READERS[k] = spark.read.parquet(path)
    return _READERS[k]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("ts").cast("date").alias("day"),
    )


def _epoch_s(ts):
    return F.timestamp_diff("SECOND", F.lit(EPOCH_TEXT).cast("timestamp_ntz"), ts)


def _epoch_ms(ts):
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_TEXT).cast("timestamp_ntz"), ts)


def _fmt(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def broadcasts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw broadcast segments (ods_report_play_time), times as text."""
    e = events(spark, sf_dir)
    begin = F.date_trunc("second", F.col("ts"))
    end = (F.when(F.col("k") == 0, F.lit("0001-01-01 00:00:00"))
           .when(F.col("k") == 1, _fmt(F.timestamp_add("SECOND", F.lit(-60), begin)))
           .otherwise(_fmt(F.timestamp_add("SECOND", F.floor(F.col("value") * 60), begin))))
    title = F.when(F.col("k") >= 90, F.concat(F.lit("重播"), F.col("event_type"))).otherwise(F.col("event_type"))
    return e.select(
        "day",
        F.col("user_id").alias("room_id"),
        F.lit("live").alias("domain"),
        _fmt(begin).alias("begin_time"),
        end.alias("end_time"),
        F.col("k").cast("long").alias("max_viewer"),
        F.floor("value").alias("accumulative_viewer_total"),
        F.lit(1).cast("long").alias("execute_times"),
        F.col("k").cast("string").alias("begin_flower_count"),
        F.when(F.col("k") == 2, F.lit("x")).otherwise((F.col("k") * 2).cast("string")).alias("end_flower_count"),
        F.lit("0").alias("from_qq"),
        F.lit("1").alias("live_permission"),
        F.lit("obs").alias("live_source_type"),
        F.lit("rtmp").alias("live_stream_type"),
        F.col("event_id").cast("string").alias("game_id"),
        F.col("event_type").alias("game_name"),
        title.alias("play_title"),
    )


PERIOD_BY_TYPE = {"view": 360, "click": 36, "purchase": 38, "signup": 360, "error": 39}
INFO_BY_TYPE = {"view": 1, "click": 8, "purchase": 48, "signup": 49, "error": 7}
FLOWER = 5                                   # error events with an odd k


def _code(mapping: dict):
    expr = None
    for t, c in mapping.items():
        expr = F.when(F.col("event_type") == t, c) if expr is None else expr.when(F.col("event_type") == t, c)
    return expr


def online_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online-count readings at hourly ticks, some with a fraction of a second
    (ods_report_room_online_count)."""
    e = events(spark, sf_dir)
    return e.select(
        "day",
        F.concat(_fmt(F.date_trunc("hour", "ts")),
                 F.when(F.col("k") % 7 == 0, F.lit(".250")).otherwise(F.lit(""))).alias("time"),
        F.col("user_id").alias("room_id"),
        F.floor(F.col("k") / 25).alias("category_id"),
        F.lit("host").alias("user_title"),
        _code(PERIOD_BY_TYPE).alias("period"),
        F.col("k").cast("long").alias("count"),
    )


def room_pv_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    code = F.when((F.col("event_type") == "error") & (F.col("k") % 2 == 1), FLOWER).otherwise(_code(INFO_BY_TYPE))
    return e.select("day", F.col("user_id").alias("room_id"), code.alias("info_type"),
                    F.col("k").cast("long").alias("count"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a landing url (page k), an hourly session and the previous url."""
    e = events(spark, sf_dir)
    pages = _read(spark, sf_dir, "pages").select(F.col("page_id"), "url")
    j = e.join(pages, e.k == pages.page_id, "left").drop("page_id")
    w = Window.partitionBy("user_id", "day", "hr").orderBy("ts", "event_id")
    return (j.withColumn("hr", F.hour("ts"))
             .withColumn("seq", F.row_number().over(w))
             .withColumn("source_url", F.when(F.col("seq") == 1, F.lit("")).otherwise(F.lag("url").over(w)))
             .withColumn("tid", F.concat(F.col("event_type"), F.lit("-"), F.col("k").cast("string")))
             .withColumn("ip", F.concat(F.lit("10.0.0."), F.col("k").cast("string"))))


def pv_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view track (dw_user_pv_track)."""
    j = _enriched(spark, sf_dir)
    first = events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("first_login_time"))
    t = j.join(first, "user_id")
    return t.select(
        "day",
        F.when(F.col("k") < 50, 1).otherwise(2).alias("pv_type"),
        F.col("event_type").alias("site_type"),
        F.col("user_id").cast("string").alias("uuid"),
        "ip",
        F.col("first_login_time"),
        F.floor(F.col("value") * 60).alias("page_stay"),
        F.col("hr").cast("long").alias("session_id_in_day"),
        F.col("seq").cast("long").alias("seq_no_in_session"),
        "source_url", "url", "tid",
        F.when(F.col("first_login_time").cast("date") == F.col("day"), 1).otherwise(0).alias("is_new"),
    )


def page_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw page views (ods_web_log_page_view)."""
    j = _enriched(spark, sf_dir)
    return j.select(
        "day",
        _epoch_s(F.col("ts")).cast("string").alias("s_timestamp"),
        F.when(F.col("k") == 13, F.lit("lobby")).when(F.col("k") == 14, F.concat(F.col("user_id").cast("string"), F.lit(".0")))
         .when(F.col("k") == 15, F.concat(F.col("user_id").cast("string"), F.lit(".5")))
         .otherwise(F.col("user_id").cast("string")).alias("sbt"),
        F.concat(F.lit("v"), F.col("k").cast("string")).alias("uuid"),
        F.when(F.col("value") >= 100, 2).otherwise(1).alias("send_count"),
        "ip", "source_url", "url", "tid",
    )


def player_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play records; some times are written with a fraction, as some clients do."""
    e = events(spark, sf_dir)
    fraction = lambda digit, text: F.when(F.col("k") % 10 == digit, F.lit(text)).otherwise(F.lit(""))
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("date"),
        F.lpad(F.col("user_id").cast("string"), 6, " ").alias("roomid"),
        F.concat(F.lit("d"), F.col("k").cast("string")).alias("deviceid"),
        F.concat(F.lit("10.0.0."), F.col("k").cast("string")).alias("ip"),
        F.when(F.col("event_type") == "view", "PC").when(F.col("event_type") == "click", "PCweb")
         .otherwise("android").alias("ostype"),
        F.concat(F.floor(F.col("value") * 60000).cast("string"), fraction(3, ".0"), fraction(7, ".9")).alias("playduration"),
        F.when(F.col("k") == 0, F.lit("NaN"))
         .otherwise(F.concat((F.col("k") * 1000).cast("string"), fraction(4, ".5"))).alias("stuckduration"),
        _epoch_ms(F.col("ts")).cast("string").alias("createtime"),
    )


def trades_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gift trades from purchase events (room = user_id), used per room and per broadcast."""
    e = events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return e.select(
        "day",
        _fmt(F.date_trunc("second", "ts")).alias("tr_date"),
        F.col("user_id").alias("room_id"),
        F.col("k").cast("long").alias("user_id"),
        F.col("k").cast("long").alias("operator_id"),
        F.col("k").cast("long").alias("item_id"),
        F.lit(1).cast("long").alias("item_num"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        F.when(F.col("k") >= 95, 0).otherwise(1).alias("trade_status"),
        F.when(F.col("k").between(90, 94), F.lit("other")).otherwise(F.lit("platform")).alias("product_name"),
    )


def trades_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gift trades from lineitem x orders (user = customer, room = supplier, item = part)."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                  "l_extendedprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_orderdate").cast("date").alias("day"),
        _fmt("o_orderdate").alias("tr_date"),
        F.col("l_suppkey").alias("room_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_custkey").alias("operator_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("long").alias("item_num"),
        # more than two decimals, so that ranking by the rounded sum would show
        (F.col("l_extendedprice").cast("decimal(18,2)")
         + F.col("l_linenumber").cast("decimal(4,0)") * F.lit(Decimal("0.0011"))).alias("price"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("trade_status"),
        F.lit("platform").alias("product_name"),
    )


def subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where(F.col("event_type") == "signup")
    return e.select("day", F.col("user_id").alias("room_id"),
                    F.when(F.col("k") < 80, 1).otherwise(0).alias("actived"))


def subscription_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running subscriber count per room and day (a daily snapshot table)."""
    daily = (subscription(spark, sf_dir).groupBy("day", "room_id")
             .agg(F.sum("actived").alias("n")))
    w = Window.partitionBy("room_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("day", "room_id", F.sum("n").over(w).cast("long").alias("count"))


def dim_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("room_id"), F.col("c_mktsegment").alias("domain"),
                    F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_title"),
                    F.col("c_nationkey").cast("long").alias("category_id"))


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"),
                    F.concat(F.lit("region-"), F.col("n_regionkey").cast("string")).alias("domain"))
