"""M1-M7: player log cleaning, watch metrics, broadcast minutes, room flow defaults."""

import datetime as dt

from pyspark.sql import functions as F

from livemetrics.operators.room import effective_play, room_broadcast, room_revenue, watch_metrics
from livemetrics.plans.room_flow import daily_room_flow

LOG = "date string, roomid string, deviceid string, ip string, ostype string, playduration string, " \
      "stuckduration string, createtime string"


def test_effective_play_and_watch(spark):
    log = spark.createDataFrame([
        ("20240101", " 7 ", "a", "", "PC-1", "15000", "5000", "0"),      # PC: stall ignored -> 15000
        ("20240101", "7", "b", "", "ios", "15000", "1", "0"),            # 14999
        ("20240101", "7", "c", "", "ios", "0", "0", "0"),                # 0: not a view
        ("20240101", "7", "d", "", "ios", "1000", "NaN", "0"),           # NaN stall: dropped
        ("20240101", "7", "e", "", "ios", "1000", "3000", "0"),          # negative effective play
        ("20240101", "7", "f", "", "ios", "86400000", "0", "0"),         # upper bound kept
        ("20240101", "7", "g", "", "ios", "86400001", "0", "0"),         # over a day: dropped
    ], LOG)
    p = effective_play(log)
    got = {r.deviceid: r.play_duration for r in p.collect()}
    assert got == {"a": 15000, "b": 14999, "c": 0, "e": -2000, "f": 86400000}
    kept = {r.deviceid: r.play_duration for r in effective_play(log, keep_nan=True).collect()}
    assert kept["d"] == 1000
    w = watch_metrics(p.withColumn("room_id", F.trim("roomid").cast("long")), ["room_id"]).first()
    assert (w.vv, w.valid_vv, w.vv_device, w.valid_vv_device) == (3, 2, 3, 2)
    # play_duration: positive plays only; awt: all plays over devices with a positive play
    assert w.play_duration == round((15000 + 14999 + 86400000) / 1000 / 60)
    assert w.awt == round((15000 + 14999 + 0 - 2000 + 86400000) / 3 / 1000 / 60)


def test_room_broadcast_inverted_only(spark):
    raw = spark.createDataFrame([("2024-01-01", 1, "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
                                 ("2024-01-01", 2, "2024-01-01 10:00:00", "2024-01-01 10:00:30"),
                                 ("2024-01-01", 3, "2024-01-01 23:59:00", "0001-01-01 00:00:00")],
                                "day string, room_id long, begin_time string, end_time string")
    got = {r.room_id: r.play_minutes for r in room_broadcast(raw, ["day", "room_id"]).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 0.98}
    old = {r.room_id: r.play_minutes for r in room_broadcast(raw, ["day", "room_id"], compat=True).collect()}
    assert old == {1: None, 2: 0.5, 3: 0.98}             # open end is not an inverted segment


def test_revenue_filters(spark):
    t = spark.createDataFrame([
        (1, 10, 1, 1, 2, 1.005, "platform"), (1, 11, 1, 2, 1, 2.0, "platform"),
        (1, 10, 0, 3, 1, 9.0, "platform"), (1, 10, 1, 0, 1, 9.0, "platform"), (1, 10, 1, 3, 1, 9.0, "other"),
        (0, 10, 1, 3, 1, 9.0, "platform"),
    ], "room_id long, operator_id long, trade_status int, item_id long, item_num long, price double, product_name string")
    r = room_revenue(t.withColumn("price", F.col("price").cast("decimal(18,3)")), ["room_id"]).collect()
    assert [(x.room_id, x.total_price, x.total_item_num, x.total_paying_user_num) for x in r] == [(1, 3.01, 3, 2)]


def test_room_flow_defaults(spark):
    d = dt.date(2024, 1, 1)
    pv = spark.createDataFrame([(d, 1, 1, 10), (d, 2, 48, 3)], "day date, room_id long, info_type int, count long")
    oc = spark.createDataFrame([(d, dt.datetime(2024, 1, 1, 10), 1, 0, 0, 0)],
                               "day date, time timestamp, room_id long, outer_ol long, inner_ol long, encripted_ol long")
    empty_tr = spark.createDataFrame([], "day date, tr_date string, room_id long, user_id long, operator_id long, "
                                         "item_id long, item_num long, price decimal(18,2), trade_status int, product_name string")
    subs = spark.createDataFrame([], "day date, room_id long, actived int")
    tot = spark.createDataFrame([], "day date, room_id long, count long")
    log = spark.createDataFrame([], LOG)
    braw = spark.createDataFrame([(d, 1, "2024-01-01 10:00:00", "2024-01-01 09:00:00")],
                                 "day date, room_id long, begin_time string, end_time string")
    rooms = spark.createDataFrame([(1, "dom", 100, "grp", 5)],
                                  "room_id long, domain string, user_id long, user_title string, category_id long")
    cats = spark.createDataFrame([(5, "cat", "cd")], "id long, name string, domain string")
    out = {r.room_id: r for r in daily_room_flow(pv, oc, empty_tr, subs, tot, log, braw, rooms, cats).collect()}
    assert set(out) == {1, 2}
    a, b = out[1], out[2]
    assert (a.category_name, a.acu_in, a.pcu_in, a.is_broadcast, a.play_minutes) == ("cat", 0, 0, 1, 0.0)
    assert (b.domain, b.category_id, b.acu_in, b.acu_out, b.app_pv, b.is_broadcast) == (None, None, 1, 1, 3, 0)


def test_play_times_with_fractions(spark):
    rows = [("123.0", "0"), ("16000.5", "1000.9"), ("-0.5", "0"), ("5000", "NaN"), ("abc", "0"), (None, "0"), ("7", "-1.0")]
    log = spark.createDataFrame([(p, s, "android") for p, s in rows], "playduration string, stuckduration string, ostype string")
    assert sorted(r.play_duration for r in effective_play(log).collect()) == [0, 123, 15000]
    assert sorted(r.play_duration for r in effective_play(log, keep_nan=True).collect()) == [0, 123, 5000, 15000]


def test_text_keys(spark):
    from livemetrics.functions.numeric import text_key, text_long
    df = spark.createDataFrame([("7",), ("7.0",), (" 7 ",), ("7.5",), ("-3.9",), ("x",), (None,), ("1e3",), ("99999999999999999999",)], "c string")
    assert [r[0] for r in df.select(text_key("c")).collect()] == [7, 7, 7, None, None, None, None, 1000, None]
    assert [r[0] for r in df.select(text_long("c")).collect()] == [7, 7, 7, 7, -3, None, None, 1000, None]
