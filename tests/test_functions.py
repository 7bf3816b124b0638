"""S2 repair, S3 replay flag, S4 duration, U2 tiers, safe arithmetic."""

import datetime as dt

from pyspark.sql import functions as F

from livemetrics.functions import (
    decimal0, duration_minutes, repair_interval, round_half_up, safe_div, tag_replay, tier,
)


def test_repair_interval(spark):
    df = spark.createDataFrame([
        (1, "2024-01-01 10:00:00", "0001-01-01 00:00:00"),
        (2, "2024-01-01 10:00:00", "2024-01-01 09:00:00"),
        (3, "2024-01-01 10:00:00.900", "2024-01-01 11:00:00.400"),
        (4, "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
    ], "id int, b string, e string")
    got = {r.id: (r.b, r.e) for r in repair_interval(df, "b", "e").collect()}
    t = dt.datetime
    assert got[1] == (t(2024, 1, 1, 10), t(2024, 1, 1, 23, 59, 59))
    assert got[2] == (t(2024, 1, 1, 10), t(2024, 1, 1, 10))
    assert got[3] == (t(2024, 1, 1, 10), t(2024, 1, 1, 11))
    assert got[4] == (t(2024, 1, 1, 10), t(2024, 1, 1, 10))


def test_tag_replay(spark):
    df = spark.createDataFrame([(1, "重播: 决赛"), (2, "今晚决赛重播"), (3, None), (4, "【重播】")],
                               "id int, t string")
    got = {r.id: r.f for r in df.select("id", tag_replay("t").alias("f")).collect()}
    assert got == {1: "replay", 2: "live", 3: "live", 4: "replay"}


def test_duration_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10, 1, 1))], "b timestamp, e timestamp")
    assert df.select(duration_minutes("b", "e").alias("m")).first().m == 1.02


def test_tiers_and_rounding(spark):
    vals = [None, 0.0, 500.0, 500.01, 5000.0, 5000.01, 50000.0, 50000.01]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(tier("x").alias("t")).collect()]
    assert got == ["p0", "p0", "p0", "p1", "p1", "p2", "p2", "p3"]
    r = spark.range(1).select(round_half_up(F.lit(1.005), 2).alias("a"), decimal0(F.lit(2.5)).alias("b"),
                              safe_div(F.lit(1), F.lit(0)).alias("c")).first()
    assert (r.a, r.b, r.c) == (1.01, 3, None)
