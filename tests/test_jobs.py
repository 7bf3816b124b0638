"""The stored-table jobs end to end: stand-in logs written as day-partitioned tables, each
job run over a day range, outputs compared with the in-memory plans."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from livemetrics.jobs import input_days, parse_options, run_job, run_user_transaction
from livemetrics.plans import reports, room_flow
from livemetrics.sinks import overwrite_partitions
from livemetrics.sources import standins as si

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="lm-jobs-")
    built = {
        "play_time_raw": si.broadcasts_raw(spark, SF), "online_raw": si.online_raw(spark, SF),
        "room_pv_uv": si.room_pv_uv(spark, SF), "trade": si.trades_events(spark, SF),
        "subscription": si.subscription(spark, SF), "subscription_total": si.subscription_total(spark, SF),
        "page_view": si.page_view(spark, SF), "pv_track": si.pv_track(spark, SF),
    }
    paths = {}
    for name, df in built.items():
        paths[name] = f"{root}/{name}"
        overwrite_partitions(df.withColumn("day", F.date_format("day", "yyyy-MM-dd")), paths[name])
    paths["player_log"] = f"{root}/player_log"
    si.player_log(spark, SF).write.parquet(paths["player_log"])
    for name, df in (("dim_room", si.dim_room(spark, SF)), ("dim_category", si.dim_category(spark, SF))):
        paths[name] = f"{root}/{name}"
        df.write.parquet(paths[name])
    paths["trade_orders"] = f"{root}/trade_orders"
    overwrite_partitions(si.trades_orders(spark, SF).withColumn("day", F.date_format("day", "yyyy-MM-dd")),
                         paths["trade_orders"])
    return paths


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ods_and_dw_jobs(spark, tables):
    out = tempfile.mkdtemp(prefix="lm-ods-")
    run_job(spark, "ods_play_time", tables, "2024-01-01", "2024-02-01", out, max_gap_s=se.BROADCAST_GAP_S)
    got = spark.read.parquet(out)
    want = room_flow.clean_broadcasts(si.broadcasts_raw(spark, SF), max_gap_s=se.BROADCAST_GAP_S)
    assert got.count() == want.count() > 0
    tables = dict(tables, play_time_etl=out)

    oc_out = tempfile.mkdtemp(prefix="lm-oc-")
    run_job(spark, "ods_online_count", tables, "2024-01-01", "2024-02-01", oc_out)
    oc2 = tempfile.mkdtemp(prefix="lm-oc2-")
    run_job(spark, "dw_room_online_count", dict(tables, online_count=oc_out), "2024-01-01", "2024-02-01", oc2)
    assert spark.read.parquet(oc2).count() == se.q_room_online_count(spark, SF).count()

    flow = tempfile.mkdtemp(prefix="lm-flow-")
    run_job(spark, "dw_daily_room_flow", tables, "2024-01-05", "2024-01-08", flow)
    want = se.q_daily_room_flow(spark, SF).where(F.col("date").between("2024-01-05", "2024-01-07"))
    cols = want.columns
    assert _rows(spark.read.parquet(flow).select(*cols)) == _rows(want)

    fact = tempfile.mkdtemp(prefix="lm-fact-")
    run_job(spark, "dw_room_play_time", dict(tables, online_count=oc2), "2024-01-10", "2024-01-12", fact)
    want = se.q_room_play_time(spark, SF).where(F.col("date").between("2024-01-10", "2024-01-11"))
    assert _rows(spark.read.parquet(fact).select(*want.columns)) == _rows(want)


def test_report_jobs(spark, tables):
    out = tempfile.mkdtemp(prefix="lm-rpt-")
    run_job(spark, "rpt_channel_analysis", tables, "2024-01-09", "2024-01-12", out)
    want = reports.channel_report(si.pv_track(spark, SF)).where(F.col("date").between("2024-01-09", "2024-01-11"))
    assert _rows(spark.read.parquet(out).select(*want.columns)) == _rows(want)
    src = se.sources()["blog"]
    out2 = tempfile.mkdtemp(prefix="lm-src-")
    run_job(spark, "rpt_source", tables, "2024-01-09", "2024-01-12", out2, sources=[src], load_time=0)
    want2 = reports.source_report(si.pv_track(spark, SF), si.page_view(spark, SF), src, load_time=0) \
        .where(F.col("date").between("2024-01-09", "2024-01-11"))
    assert _rows(spark.read.parquet(out2).select(*want2.columns)) == _rows(want2) and want2.count() == 3


def test_source_report_of_a_day_without_track(spark, tables):
    """Page views but no track rows on the day: the row is written, with the IP count."""
    src = se.sources()["direct"]
    hits = si.page_view(spark, SF).where(src.condition).select(F.date_format("day", "yyyy-MM-dd").alias("d"), "ip").distinct()
    day, ips = max((r.d, r.n) for r in hits.groupBy("d").agg(F.count("ip").alias("n")).collect())
    rest = tempfile.mkdtemp(prefix="lm-track-")
    overwrite_partitions(spark.read.parquet(tables["pv_track"]).where(F.col("day") < "2024-01-02").drop("year", "month"), rest)
    out = tempfile.mkdtemp(prefix="lm-src0-")
    run_job(spark, "rpt_source", dict(tables, pv_track=rest), day, dt.date.fromisoformat(day) + dt.timedelta(days=1), out,
            sources=[src], load_time=0)
    (r,) = spark.read.parquet(out).collect()
    assert (r.date, r.uv, r.new_user_cnt, r.ip) == (day, 0, 0, ips) and ips > 0


def test_jobs_leave_no_stage_folder(spark, tables):
    root = os.path.join(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "stage")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    run_job(spark, "rpt_channel_analysis", tables, "2024-01-09", "2024-01-10", tempfile.mkdtemp(prefix="lm-st-"))
    assert set(os.listdir(root)) <= before


def test_one_day_retention_reads_three_days():
    d = dt.date(2024, 1, 9)
    assert input_days("rpt_channel_analysis", [d]) == [dt.date(2024, 1, 2), dt.date(2024, 1, 8), d]
    assert parse_options(["max_gap_s=600", "compat=true", "x=a=b"]) == {"max_gap_s": 600, "compat": True, "x": "a=b"}


def test_user_transaction_job(spark, tables):
    out = tempfile.mkdtemp(prefix="lm-ut-")
    run_user_transaction(spark, dict(tables, trade=tables["trade_orders"]), "2001-07-31", "2001-08-02", out,
                         history_start="1995-01-01")
    got = spark.read.parquet(out)
    assert sorted(r.date for r in got.select("date").distinct().collect()) == ["2001-07-31", "2001-08-01"]
    want = se.q_user_transaction(spark, SF)
    assert _rows(got.where(F.col("date") == "2001-08-01").select(*want.columns)) == _rows(want)


def test_category_job(spark, tables):
    out = tempfile.mkdtemp(prefix="lm-cat-")
    srcs = list(se.sources().values())
    run_job(spark, "rpt_user_cnt_by_category", tables, "2024-01-03", "2024-01-06", out, sources=srcs, load_time=7)
    want = reports.category_users(si.page_view(spark, SF), si.dim_room(spark, SF), si.dim_category(spark, SF),
                                  srcs, load_time=7).where(F.col("date").between("2024-01-03", "2024-01-05"))
    assert _rows(spark.read.parquet(out).select(*want.columns)) == _rows(want)
