"""Late rows: exactly the output days they reach are rewritten, in batch and in the stream."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from livemetrics.dependencies import READS, JobRun, affected_days, in_order
from livemetrics.jobs import rerun_late, run_job
from livemetrics.plans import reports
from livemetrics.sinks import overwrite_partitions
from livemetrics.sources import standins as si
from livemetrics.streaming.incremental import rerun_jobs_on_late_files

SF = "/root/testdata/sf0.001"
D = dt.date


def day(n):
    return D(2024, 1, n)


def test_offsets_are_followed_backwards_and_through_the_chain():
    etl = JobRun("ods_play_time", {"play_time_raw": "/raw/play"}, "/ods/play")
    fact = JobRun("dw_room_play_time", {"play_time_etl": "/ods/play", "page_view": "/raw/pv", "trade": "/raw/trade",
                                        "dim_room": "/dim/room"}, "/dw/fact")
    chan = JobRun("rpt_channel_analysis", {"pv_track": "/raw/track"}, "/rpt/chan")
    user = JobRun("dw_user_transaction", {"trade": "/raw/trade/"}, "/dw/user")
    runs = [user, fact, chan, etl]
    assert [r.job for r in in_order(runs)].index("ods_play_time") < [r.job for r in in_order(runs)].index("dw_room_play_time")

    def hit(**changed):
        got = affected_days(runs, {f"/raw/{k}": v for k, v in changed.items()}, day(3), day(20))
        return {r.job: days for r, days in got}

    assert hit(pv=[day(10)]) == {"dw_room_play_time": [day(9), day(10)]}          # D and the broadcasts of D-1
    assert hit(track=[day(10)]) == {"rpt_channel_analysis": [day(10), day(11), day(17)]}
    assert hit(track=[day(15)]) == {"rpt_channel_analysis": [day(15), day(16)]}   # day 22 is still to come
    assert hit(play=[day(10)]) == {"ods_play_time": [day(10)], "dw_room_play_time": [day(10)]}
    assert hit(trade=[day(18)]) == {"dw_room_play_time": [day(17), day(18)], "dw_user_transaction": [day(18), day(19), day(20)]}
    assert hit(trade=[day(1)])["dw_user_transaction"] == [day(n) for n in range(3, 21)]
    assert hit(pv=[day(1)]) == {} and hit() == {}
    with pytest.raises(ValueError):
        in_order([JobRun("ods_play_time", {"play_time_raw": "/a"}, "/b"), JobRun("ods_online_count", {"online_raw": "/b"}, "/a")])


def test_every_job_states_its_reads():
    from livemetrics.jobs import main
    with pytest.raises(SystemExit):
        main(["no_such_job", "--out", "x"])
    assert "dw_user_transaction" in READS and all(READS.values())


def _mtimes(root):
    parts = [(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]
    return {d.split("=")[-1]: (f, os.path.getmtime(os.path.join(d, f))) for d, f in sorted(parts)}


def _track(spark, root):
    """Write the track without its last row of 10 January; return that late row's frame."""
    track = si.pv_track(spark, SF).withColumn("day", F.date_format("day", "yyyy-MM-dd"))
    late = track.where("day = '2024-01-10' AND pv_type = 1").orderBy("uuid").limit(1)
    late = spark.createDataFrame(late.collect(), track.schema)
    path = f"{root}/track"
    overwrite_partitions(track, path)
    return path, late.drop("year", "month")


def test_a_late_day_rewrites_exactly_the_days_it_reaches(spark):
    root = tempfile.mkdtemp(prefix="lm-late-")
    path, late = _track(spark, root)
    out = f"{root}/rpt"
    runs = [JobRun("rpt_channel_analysis", {"pv_track": path}, out)]
    run_job(spark, "rpt_channel_analysis", {"pv_track": path}, "2024-01-08", "2024-01-20", out)
    before = _mtimes(out)
    whole = spark.read.parquet(path).drop("year", "month").where("day = '2024-01-10'")
    overwrite_partitions(whole.unionByName(late), path, days=[day(10)])
    done = rerun_late(spark, runs, {path: [day(10)]}, "2024-01-08", "2024-01-19")
    assert done == [("rpt_channel_analysis", [day(10), day(11), day(17)])]
    after = _mtimes(out)
    assert {d for d in after if after[d] != before[d]} == {"2024-01-10", "2024-01-11", "2024-01-17"}
    stored = spark.read.parquet(path).withColumn("day", F.to_date("day")).drop("year", "month")
    want = reports.channel_report(stored).where(F.col("date").between("2024-01-08", "2024-01-19"))
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_the_stream_repeats_the_jobs_a_late_file_reaches(spark):
    root = tempfile.mkdtemp(prefix="lm-late2-")
    path, late = _track(spark, root)
    out = f"{root}/rpt"
    run_job(spark, "rpt_channel_analysis", {"pv_track": path}, "2024-01-08", "2024-01-20", out)
    stored = spark.read.parquet(path)
    runs = [JobRun("rpt_channel_analysis", {"pv_track": path}, out)]
    start = lambda: rerun_jobs_on_late_files(
        spark, path, stored.schema, runs, "2024-01-08", lambda: day(19), name="late", trigger_once=True)
    start().awaitTermination(120)            # the first run sees every file that is there
    before = _mtimes(out)
    (late.withColumn("year", F.lit("2024")).withColumn("month", F.lit("2024-01"))
         .write.mode("append").partitionBy("year", "month", "day").parquet(path))
    start().awaitTermination(120)
    after = _mtimes(out)
    assert {d for d in after if after[d] != before[d]} == {"2024-01-10", "2024-01-11", "2024-01-17"}
    want = reports.channel_report(spark.read.parquet(path).withColumn("day", F.to_date("day")).drop("year", "month")) \
        .where(F.col("date").between("2024-01-08", "2024-01-19"))
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
