"""What the band join of a broadcast to its events moves: laid-out broadcasts are never collected
and broadcast, and no broadcast is repeated beyond its own time buckets."""

import datetime as dt

from pyspark.sql import functions as F

from livemetrics.operators.attribution import attribute
from livemetrics.plans import play_time

T = dt.datetime
LOG = "date string, roomid string, deviceid string, ip string, ostype string, playduration string, " \
      "stuckduration string, createtime string"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_laid_out_sessions_are_not_broadcast(spark, tmp_path):
    """Few bytes of sessions, each of 95 rows once laid out: their estimated size is that of the file."""
    spark.range(2000).select((F.col("id") % 50).alias("room_id"), F.lit(T(2024, 1, 1, 0, 5)).alias("s"),
                             F.lit(T(2024, 1, 1, 23, 40)).alias("e")).write.parquet(f"{tmp_path}/s")
    spark.range(2000).select((F.col("id") % 50).alias("room_id"), (F.lit(T(2024, 1, 1)) + F.make_interval(
        mins=F.col("id") % 1440)).alias("ts"), F.repeat(F.lit("x"), 5000).alias("pad")).write.parquet(f"{tmp_path}/e")
    j = attribute(spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/e"), ["room_id"], "s", "e", "ts")
    p = _plan(j)
    assert "BroadcastExchange" not in p and "SortMergeJoin" in p
    assert j.agg(F.count(F.lit(1))).first()[0] > 0


def _joined(make):
    """The row of ``make()`` and the band join it made."""
    seen, joined = [], play_time.attribute

    def watched(*a, **k):
        seen.append(joined(*a, **k))
        return seen[-1]

    play_time.attribute = watched
    try:
        return make().first(), seen[0]._jdf.queryExecution().optimizedPlan().toString()
    finally:
        play_time.attribute = joined


def _interval(spark):
    return spark.createDataFrame([(7, T(2024, 1, 1, 10, 1), T(2024, 1, 1, 10, 50))], "room_id long, begin_time timestamp, end_time timestamp")


def test_a_broadcast_costs_one_row_per_bucket(spark):
    ms = str(int((T(2024, 1, 1, 10, 30) - T(1970, 1, 1)).total_seconds() * 1000))
    log = spark.createDataFrame([("20240101", "7", "d", "", "PC", "60000", "0", ms)], LOG)
    r, p = _joined(lambda: play_time.session_watch(_interval(spark), log))
    assert (r.vv, r.vv_device, r.play_duration) == (1, 1, 1)
    assert p.count("Generate explode") == 2                 # buckets of the broadcast, widths of the event


def test_revenue_costs_one_row_per_bucket(spark):
    trades = spark.createDataFrame([("2024-01-01 10:01:00", 7, 1, 3, 2, 10.5, 1, "platform"), ("2024-01-01 10:50:01", 7, 1, 3, 1, 1.0, 1, "platform")],
                                   "tr_date string, room_id long, operator_id long, item_id long, item_num long, price double, "
                                   "trade_status int, product_name string")
    r, p = _joined(lambda: play_time.session_revenue(_interval(spark), trades))
    assert (r.total_price, r.total_item_num, r.total_paying_user_num) == (10.5, 2, 1)
    assert p.count("Generate explode") == 2
