"""Interval summaries from the block index against the band join and row by row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from livemetrics.operators import online
from livemetrics.operators.attribution import attribute
from livemetrics.operators.timeindex import LEVELS, cover, interval_summaries, time_blocks
from livemetrics.plans.play_time import IV, session_concurrency

T0 = dt.datetime(2024, 1, 1)
READINGS = "room_id long, time timestamp, outer_ol long, inner_ol long, encripted_ol long"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_cover_holds_every_bucket_once(spark):
    rng = random.Random(5)
    pairs = [(a, a + n) for n in (-3, 0, 1, 3, 4, 5, 63, 64, 65, 1023, 5000) for a in (0, 1, 7, 64, -5, -4096)]
    pairs += [(a, a + rng.randrange(20_000)) for a in (rng.randrange(-9000, 9000) for _ in range(60))]
    pairs.append((1, 3 * 4 ** LEVELS))
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", cover(F.col("a"), F.col("b")).alias("c"))
    for r in df.collect():
        spans = sorted((x.b * 4 ** x.l, (x.b + 1) * 4 ** x.l) for x in r.c)
        if r.a >= r.b:
            assert not spans
            continue
        assert spans[0][0] == r.a and spans[-1][1] == r.b
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 6 * LEVELS + 12


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(11)
    readings = [(rng.choice([1, 1, 1, 2, None]), at(rng.randrange(-200_000, 900_000) + rng.choice([0, 0, 0.25])),
                 rng.randrange(5), rng.randrange(4), rng.choice([0, 3])) for _ in range(1500)]
    readings += readings[:40] + [(1, None, 1, 1, 1), (2, at(60), 9, 9, 9), (2, at(120), 9, 9, 9)]
    iv = []
    for _ in range(120):
        a = rng.randrange(-200_000, 900_000)
        iv.append((rng.choice([1, 2, 3, None]), at(a), at(a + rng.choice([0, 1, 59, 60, 3600, 90_000, 700_000, -5]))))
    iv += [(2, at(60), at(120)), (2, at(60), at(60)), (1, None, at(5)), (1, at(5), None), iv[0], (1, at(-10**7), at(4 * 10**8))]
    return (spark.createDataFrame(iv, "room_id long, begin_time timestamp, end_time timestamp"),
            spark.createDataFrame(readings, READINGS))


def test_concurrency_matches_the_band_join(frames):
    iv, oc = frames
    pairs = attribute(iv.distinct(), oc.withColumnRenamed("time", "_ts"), ["room_id"], "begin_time", "end_time", "_ts")
    want = online.peak_and_average(pairs, IV, time="_ts")
    got = session_concurrency(iv, oc).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert session_concurrency(iv.limit(0), oc).count() == 0 and session_concurrency(iv, oc.limit(0)).count() == 0


def test_base_width_does_not_change_the_result(frames):
    iv, oc = frames
    wanted = sorted(map(repr, session_concurrency(iv, oc, base_s=60).collect()))
    assert sorted(map(repr, session_concurrency(iv, oc, base_s=7).collect())) == wanted
    assert sorted(map(repr, session_concurrency(iv, oc, base_s=3600).collect())) == wanted


def test_rows_read_do_not_grow_with_the_readings(spark):
    """Ten times the readings of a broadcast of ten days leave the blocks it reads as they are."""
    iv = spark.createDataFrame([(1, at(30), at(864_000))], "room_id long, begin_time timestamp, end_time timestamp")
    spec = {"n": (F.sum, F.lit(1)), "top": (F.max, F.col("x"))}
    read = []
    for step in (60, 6):
        oc = spark.range(0, 900_000, step).select(F.lit(1).cast("long").alias("room_id"), (F.col("id") % 977).alias("x"),
                                                  F.timestamp_seconds(F.col("id") + int(T0.replace(tzinfo=dt.timezone.utc).timestamp())).alias("t"))
        one = interval_summaries(iv, oc, ["room_id"], "begin_time", "end_time", "t", spec).first()
        assert (one.n, one.top) == (len([t for t in range(0, 900_000, step) if 30 <= t <= 864_000]), 976)
        blocks = time_blocks(oc, ["room_id"], "t", spec)
        b = lambda c: F.floor(F.unix_seconds(c) / 60)
        need = iv.select("room_id", F.explode(cover(b(F.col("begin_time")) + 1, b(F.col("end_time")))).alias("_at"))
        read.append(need.join(blocks, ["room_id", "_at"]).count())
    assert read[0] == read[1] <= 6 * LEVELS
