"""Dedupe, pivot, PCU/ACU and peak time."""

import datetime as dt

from livemetrics.operators import online

T = dt.datetime


def test_dedupe_sub_second(spark):
    df = spark.createDataFrame([
        ("2024-01-01", "2024-01-01 10:00:00.100", 1, 1, "h", 36, 5),
        ("2024-01-01", "2024-01-01 10:00:00.900", 1, 1, "h", 36, 9),
    ], "day string, time string, room_id long, category_id long, user_title string, period int, count long")
    out = online.dedupe_readings(df).collect()
    assert [(r.time, r["count"]) for r in out] == [(T(2024, 1, 1, 10), 9)]
    raw = online.dedupe_readings(df, group_raw_time=True).collect()
    assert sorted(r["count"] for r in raw) == [5, 9]


def test_pivot_codes(spark):
    df = spark.createDataFrame([(1, 36, 2), (1, 38, 3), (1, 360, 7), (1, 99, 100)],
                               "room_id long, period int, count long")
    r = online.pivot_online(df, keys=["room_id"]).first()
    assert (r.outer_ol, r.inner_ol, r.encripted_ol) == (7, 5, 3)


def test_pcu_acu_and_peak(spark):
    df = spark.createDataFrame([
        (1, T(2024, 1, 1, 10), 0, 0, 0), (1, T(2024, 1, 1, 11), 0, 0, 0),          # all-zero room
        (2, T(2024, 1, 1, 10), 4, 6, 0), (2, T(2024, 1, 1, 11), 0, 9, 0),
        (2, T(2024, 1, 1, 9), 5, 9, 1), (2, T(2024, 1, 1, 12), 0, 0, 0),            # tied peak at 9:00/11:00
    ], "room_id long, time timestamp, outer_ol long, inner_ol long, encripted_ol long")
    got = {r.room_id: r for r in online.peak_and_average(df, ["room_id"], time="time").collect()}
    z = got[1]
    assert (z.pcu_in, z.acu_in, z.acu_out, z.peak_time) == (0, 0, 0, T(2024, 1, 1, 10))
    b = got[2]
    assert (b.pcu_in, b.pcu_out, b.pcu_encrypted) == (9, 5, 1)
    assert b.acu_in == 8            # (6+9+9)/3 samples > 0
    assert b.acu_out == 5           # (4+5)/2 = 4.5 -> half-up 5
    assert b.peak_time == T(2024, 1, 1, 9)
