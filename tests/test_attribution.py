"""I1 band join: boundaries, overlaps, midnight, empty sessions, bucketed == plain."""

import datetime as dt
import random

from pyspark.sql import functions as F

from livemetrics.operators.attribution import attribute

T = dt.datetime


def sessions(spark, data):
    return spark.createDataFrame(data, "room_id long, sid string, s timestamp, e timestamp")


def events(spark, data):
    return spark.createDataFrame(data, "room_id long, eid long, ts timestamp")


def test_boundaries_overlap_midnight(spark):
    s = sessions(spark, [
        (1, "A", T(2024, 1, 1, 10), T(2024, 1, 1, 11)),
        (1, "B", T(2024, 1, 1, 10, 30), T(2024, 1, 1, 12)),      # overlaps A
        (2, "C", T(2024, 1, 1, 23), T(2024, 1, 2, 1)),           # over midnight
        (3, "D", T(2024, 1, 1, 10), T(2024, 1, 1, 11)),          # no events
    ])
    e = events(spark, [
        (1, 1, T(2024, 1, 1, 10)), (1, 2, T(2024, 1, 1, 11)),    # exactly at begin / end of A
        (1, 3, T(2024, 1, 1, 10, 45)),                           # in A and B
        (1, 4, T(2024, 1, 1, 12, 0, 1)),                         # after B
        (2, 5, T(2024, 1, 2, 0, 30)),
    ])
    pairs = sorted((r.sid, r.eid) for r in attribute(s, e, ["room_id"], "s", "e", "ts", bucket_s=600).collect())
    assert pairs == [("A", 1), ("A", 2), ("A", 3), ("B", 2), ("B", 3), ("C", 5)]


def test_bucketed_matches_plain_join(spark):
    rnd = random.Random(3)
    base = T(2024, 1, 1)
    sd = []
    for i in range(200):
        st = base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
        sd.append((rnd.randint(1, 4), f"s{i}", st, st + dt.timedelta(seconds=rnd.choice([0, 60, 3600, 40000]))))
    ed = [(rnd.randint(1, 4), i, base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))) for i in range(3000)]
    s, e = sessions(spark, sd), events(spark, ed)
    plain = s.join(e.withColumnRenamed("room_id", "r2"),
                   (s.room_id == F.col("r2")) & F.col("ts").between(s.s, s.e)).select("sid", "eid")
    want = sorted(tuple(r) for r in plain.collect())
    for bucket_s, salt in ((900, 1), (60, 1), (3600, 4), (7, 2)):      # 7 s: coarse buckets of 11 minutes
        got = sorted((r.sid, r.eid) for r in
                     attribute(s, e, ["room_id"], "s", "e", "ts", bucket_s=bucket_s, salt=salt).collect())
        assert got == want, (bucket_s, salt)


def test_long_session_in_the_same_join(spark):
    s = sessions(spark, [(1, "L", T(2024, 1, 1), T(2030, 1, 1)), (1, "S", T(2024, 1, 1), T(2024, 1, 1, 1))])
    e = events(spark, [(1, 1, T(2024, 1, 1, 0, 30)), (1, 2, T(2029, 6, 1))])
    j = attribute(s, e, ["room_id"], "s", "e", "ts")
    assert sorted((r.sid, r.eid) for r in j.collect()) == [("L", 1), ("L", 2), ("S", 1)]
    assert j._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1      # one band join


def test_session_layout_rows(spark):
    """A session costs one row per whole day and at most two days of fine buckets."""
    from livemetrics.operators.attribution import COARSE, _layout
    df = spark.createDataFrame([(0, 0), (3, 95), (0, 95), (5, 96 * 400 + 7), (95, 96), (-200, -1)], "a long, b long")
    for r in df.select("a", "b", _layout(F.col("a"), F.col("b")).alias("x")).collect():
        assert len(r.x) <= (r.b - r.a) // COARSE + 2 * COARSE
        covered = sorted(k for w, n in r.x for k in ([n] if w == 0 else range(n * COARSE, (n + 1) * COARSE)))
        assert covered == list(range(r.a, r.b + 1))


def test_session_page_views_edges(spark):
    from livemetrics.plans.play_time import session_page_views
    iv = sessions(spark, [(7, "A", T(2024, 1, 1, 10), T(2024, 1, 1, 11))]).select(
        "room_id", F.col("s").alias("begin_time"), F.col("e").alias("end_time"))
    epoch = lambda t: str(int((t - T(1970, 1, 1)).total_seconds()))
    pv = spark.createDataFrame([
        ("7", epoch(T(2024, 1, 1, 10)), "u1", 1),       # at begin
        ("7", epoch(T(2024, 1, 1, 10, 5)), "u1", 1),    # same viewer again
        ("7", epoch(T(2024, 1, 1, 10, 6)), "u2", 2),    # second send: not a view
        ("x7", epoch(T(2024, 1, 1, 10, 7)), "u3", 1),   # non-numeric room: matches nothing
        ("7", epoch(T(2024, 1, 1, 11)), "u4", 1),       # at end
    ], "sbt string, s_timestamp string, uuid string, send_count int")
    r = session_page_views(iv, pv).first()
    assert (r.pv, r.uv) == (3, 2)


def test_shared_interval_not_double_counted(spark):
    """Two broadcasts with the same (room, begin, end) but different titles each get the
    interval's metrics once."""
    from livemetrics.plans.play_time import room_play_time
    d = dt.date(2024, 1, 1)
    b, e = T(2024, 1, 1, 10), T(2024, 1, 1, 11)
    cols = ("day date, room_id long, domain string, begin_time timestamp, end_time timestamp, max_viewer long, "
            "accumulative_viewer_total long, from_qq string, live_permission string, live_source_type string, "
            "live_stream_type string, game_id string, game_name string, play_title string, is_live string")
    sessions = spark.createDataFrame([(d, 7, "x", b, e, 1, 1, "0", "1", "s", "t", "g", "G", "A", "live"),
                                      (d, 7, "x", b, e, 1, 1, "0", "1", "s", "t", "g", "G", "B", "live")], cols)
    epoch = str(int((T(2024, 1, 1, 10, 30) - T(1970, 1, 1)).total_seconds()))
    pv = spark.createDataFrame([("7", epoch, "u1", 1)], "sbt string, s_timestamp string, uuid string, send_count int")
    oc = spark.createDataFrame([(d, T(2024, 1, 1, 10, 30), 7, 5, 8, 2)],
                               "day date, time timestamp, room_id long, outer_ol long, inner_ol long, encripted_ol long")
    tr = spark.createDataFrame([(d, "2024-01-01 10:40:00", 7, 1, 9, 3, 2, 10.5, 1, "platform")],
                               "day date, tr_date string, room_id long, user_id long, operator_id long, item_id long, "
                               "item_num long, price double, trade_status int, product_name string")
    log = spark.createDataFrame([], "date string, roomid string, deviceid string, ip string, ostype string, "
                                    "playduration string, stuckduration string, createtime string")
    pvuv = spark.createDataFrame([], "day date, room_id long, info_type int, count long")
    rooms = spark.createDataFrame([], "room_id long, domain string, user_id long, user_title string, category_id long")
    cats = spark.createDataFrame([], "id long, name string, domain string")
    out = room_play_time(sessions, pv, oc, tr, log, pvuv, rooms, cats).collect()
    assert sorted(r.play_title for r in out) == ["A", "B"]
    for r in out:
        assert (r.web_pv, r.web_uv, r.pcu_in, r.acu_in, r.total_price, r.total_item_num) == (1, 1, 8, 8, 10.5, 2)
        assert r.peak_time == "2024-01-01 10:30:00"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sess=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 20000), st.integers(0, 9000)), min_size=1, max_size=15),
       evs=st.lists(st.tuples(st.integers(1, 3), st.integers(0, 30000)), min_size=0, max_size=40),
       bucket_s=st.sampled_from([7, 60, 900, 3600]), salt=st.sampled_from([1, 3]))
def test_property_band_join(spark, sess, evs, bucket_s, salt):
    base = T(2024, 1, 1)
    sd = [(r, f"s{i}", base + dt.timedelta(seconds=a), base + dt.timedelta(seconds=a + d))
          for i, (r, a, d) in enumerate(sess)]
    ed = [(r, i, base + dt.timedelta(seconds=x)) for i, (r, x) in enumerate(evs)]
    want = sorted((s[1], e[1]) for s in sd for e in ed if s[0] == e[0] and s[2] <= e[2] <= s[3])
    got = sorted((r.sid, r.eid) for r in attribute(sessions(spark, sd), events(spark, ed), ["room_id"], "s", "e",
                                                  "ts", bucket_s=bucket_s, salt=salt).collect())
    assert got == want
