"""Run a job over a day range.

The jobs are set-based (``day`` is a grouping key everywhere), so a backfill is one Spark
job over the range with a dynamic partition overwrite, not a loop that launches one job per
day.  ``days_between`` and ``default_day`` cover the launcher side.
"""

from __future__ import annotations

import argparse
import datetime as dt
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livemetrics.dependencies import READS, JobRun, affected_days
from livemetrics.functions.predicates import Source
from livemetrics.functions.numeric import money
from livemetrics.sinks import overwrite_partitions, write_report
from livemetrics.sources.tables import on_days
from livemetrics.staging import stages_dropped_after


def default_day(today: dt.date | None = None) -> dt.date:
    """The day a daily run processes by default: yesterday."""
    return (today or dt.date.today()) - dt.timedelta(days=1)


def days_between(start, end) -> list[dt.date]:
    """Half-open ``[start, end)`` list of days."""
    a, b = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    return [a + dt.timedelta(days=i) for i in range((b - a).days)]


def backfill(build: Callable[[dt.date, dt.date], DataFrame], start, end, path: str,
             day_col: str = "day", lookahead_days: int = 0) -> None:
    """Build the output of ``[start, end)`` in one job and overwrite those partitions.

    ``build(first, last)`` returns the job's output for inputs read over
    ``[first, last + lookahead_days]`` (e.g. one day of look-ahead for broadcasts that run
    past midnight); only rows of the requested days are written.
    """
    days = days_between(start, end)
    if not days:
        return
    first, last = days[0], days[-1]
    out = build(first, last + dt.timedelta(days=lookahead_days))
    overwrite_partitions(out, path, day_col=day_col, days=days)


# --- the daily jobs over stored tables -----------------------------------------------------
#
# Each job reads the tables it needs (paths given by the caller), limited to the days it
# needs with a partition filter on the raw ``day`` column, runs the set-based plan for the
# whole range and writes the requested days with a dynamic partition overwrite.

# The days of each table a job reads for an output day are in ``dependencies.READS``.


def input_days(job: str, days: list[dt.date], table: str | None = None) -> list[dt.date]:
    """The days ``job`` reads of ``table`` (of any table) for the requested ``days``."""
    reads = READS[job]
    offsets = set(reads[table]) if table else {n for o in reads.values() for n in o}
    return sorted({d + dt.timedelta(days=n) for d in days for n in offsets})


def _read(spark: SparkSession, tables: dict, name: str) -> DataFrame:
    """A stored table; amounts become decimals, so sums do not depend on task order."""
    df = spark.read.parquet(tables[name])
    return df.withColumn("price", money("price")) if "price" in df.columns else df


def _days(spark: SparkSession, tables: dict, name: str, days: list[dt.date], day_col: str = "day") -> DataFrame:
    if name == "player_log":                 # keyed by a compact yyyyMMdd text day
        return on_days(_read(spark, tables, name), days, "date", compact=True)
    return on_days(_read(spark, tables, name), days, day_col).withColumn(day_col, F.to_date(F.col(day_col)))


def build_job(spark: SparkSession, job: str, tables: dict, days: list[dt.date],
              sources: list[Source] | None = None, load_time=None, **kw) -> DataFrame:
    """The output of ``job`` for the requested ``days`` (it may hold rows of other days too)."""
    from livemetrics.operators import online
    from livemetrics.plans import play_time, reports, room_flow

    def t(stored: str) -> DataFrame:
        return _days(spark, tables, stored, input_days(job, days, stored))

    if job == "ods_play_time":
        return room_flow.clean_broadcasts(t("play_time_raw"), **kw)
    if job == "ods_online_count":
        return online.dedupe_readings(t("online_raw"), **kw)
    if job == "dw_room_online_count":
        return online.pivot_online(t("online_count"))
    if job == "dw_daily_room_flow":
        oc = room_flow.room_online_count(t("online_raw"))
        return room_flow.daily_room_flow(
            t("room_pv_uv"), oc, t("trade"), t("subscription"), t("subscription_total"),
            t("player_log"), t("play_time_raw"),
            spark.read.parquet(tables["dim_room"]), spark.read.parquet(tables["dim_category"]), **kw)
    if job == "dw_room_play_time":
        # only the requested days' broadcasts are attributed; the look-ahead day adds events
        sessions = t("play_time_etl").withColumn("begin_time", F.to_timestamp("begin_time")) \
                                     .withColumn("end_time", F.to_timestamp("end_time"))
        oc = t("online_count").withColumn("time", F.to_timestamp("time"))
        return play_time.room_play_time(
            sessions, t("page_view"), oc, t("trade"), t("player_log"), t("room_pv_uv"),
            spark.read.parquet(tables["dim_room"]), spark.read.parquet(tables["dim_category"]), **kw)
    if job == "rpt_channel_analysis":
        return reports.channel_report(t("pv_track"), **kw)
    if job == "rpt_source":
        (src,) = sources
        spine = spark.createDataFrame([(d,) for d in days], "day date")
        return reports.source_report(t("pv_track"), t("page_view"), src, load_time=load_time, days=spine, **kw)
    if job == "rpt_user_cnt_by_category":
        return reports.category_users(t("page_view"), spark.read.parquet(tables["dim_room"]),
                                      spark.read.parquet(tables["dim_category"]), sources or [],
                                      load_time=load_time, **kw)
    raise ValueError(f"unknown job {job}")


REPORT_JOBS = {"rpt_source", "rpt_user_cnt_by_category"}
DAY_COLUMN = {"rpt_channel_analysis": "date", "rpt_source": "date", "rpt_user_cnt_by_category": "date",
              "dw_daily_room_flow": "date", "dw_room_play_time": "date"}


def run_job(spark: SparkSession, job: str, tables: dict, start, end, out: str,
            sources: list[Source] | None = None, load_time=None, mode: str = "overwrite_days", **kw) -> None:
    """Run ``job`` for the days ``[start, end)`` and replace those partitions of ``out``, also
    where a day has no rows.  ``mode="append"`` appends report rows instead."""
    run_days(spark, job, tables, days_between(start, end), out, sources=sources, load_time=load_time, mode=mode, **kw)


def run_days(spark: SparkSession, job: str, tables: dict, days: list[dt.date], out: str,
             sources: list[Source] | None = None, load_time=None, mode: str = "overwrite_days", **kw) -> None:
    """``run_job`` for any days, consecutive or not, as one Spark job."""
    if not days:
        return
    if job == "dw_user_transaction":
        _run_user_transaction(spark, tables, sorted(days), out, **kw)
        return
    with stages_dropped_after(spark):
        df = build_job(spark, job, tables, days, sources=sources, load_time=load_time, **kw)
        col = DAY_COLUMN.get(job, "day")
        if job in REPORT_JOBS:
            write_report(df, out, mode=mode, day_col=col, days=days)
        else:
            overwrite_partitions(df, out, day_col=col, days=days)


def rerun_late(spark: SparkSession, runs: Sequence[JobRun], changed: Mapping, first, last) -> list[tuple[str, list[dt.date]]]:
    """Late rows arrived for the ``changed`` days (path of a table -> days): repeat every job of
    ``runs`` for exactly the output days in ``[first, last]`` that they reach, through the chain of
    jobs, and return what was rewritten.  ``last`` is the last day the outputs hold: days beyond
    it are still to come and will read the late rows anyway."""
    first, last = dt.date.fromisoformat(str(first)), dt.date.fromisoformat(str(last))
    todo = affected_days(runs, changed, first, last)
    for r, days in todo:
        run_days(spark, r.job, dict(r.tables), days, r.out, **r.options)
    return [(r.job, days) for r, days in todo]


def run_user_transaction(spark: SparkSession, tables: dict, start, end, out: str,
                         history_start: str = "2015-06-01") -> None:
    """U5 for every report day of ``[start, end)``."""
    days = days_between(start, end)
    if days:
        _run_user_transaction(spark, tables, days, out, history_start)


def _run_user_transaction(spark: SparkSession, tables: dict, days: list[dt.date], out: str,
                          history_start: str = "2015-06-01") -> None:
    """The trade history is read and reduced once to (user, day, item, room); the profiles of all
    report days come from one plan over that grain, whatever their number."""
    from livemetrics.plans.user_profile import trade_grain, user_transaction_range
    first, last = days[0], days[-1]
    history = days_between(history_start, last + dt.timedelta(days=1))
    with stages_dropped_after(spark):
        grain = trade_grain(_days(spark, tables, "trade", history), last, history_start)
        overwrite_partitions(user_transaction_range(grain, first, last), out, day_col="date", days=days)


def parse_source(spec: str) -> Source:
    """``name:tid:re`` (tracking id), ``name:empty|ref_re:landing_re`` (empty or matching
    referrer) or ``name:ref_re:landing_re`` (matching referrer)."""
    name, kind, rest = spec.split(":", 2)
    if kind == "tid":
        return Source.tracking_id(name, rest)
    if kind.startswith("empty|"):
        return Source.empty_or_referrer_and_landing(name, kind.split("|", 1)[1], rest)
    return Source.referrer_and_landing(name, kind, rest)


def parse_options(specs: list[str]) -> dict:
    """``name=value`` pairs; true/false and whole numbers become booleans and integers."""
    out = {}
    for spec in specs:
        name, value = spec.split("=", 1)
        low = value.lower()
        out[name] = low == "true" if low in ("true", "false") else int(value) if value.lstrip("-").isdigit() else value
    return out


def main(argv=None) -> None:
    """``python -m livemetrics.jobs JOB --start D --end D --out PATH --table name=path ...``

    ``--end`` is exclusive; without ``--start`` the job runs for yesterday (B7).  Traffic
    sources for the report jobs are given as ``--source name:referrer_re:landing_re``,
    ``--source name:empty|referrer_re:landing_re`` or ``--source name:tid:tid_re``.
    """
    ap = argparse.ArgumentParser(prog="livemetrics.jobs")
    ap.add_argument("job", choices=sorted(READS))
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--out", required=True)
    ap.add_argument("--table", action="append", default=[], help="name=path")
    ap.add_argument("--source", action="append", default=[])
    ap.add_argument("--load-time", default=None)
    ap.add_argument("--time-zone", default="UTC", help="zone of the logs' text times (epochs are compared with them)")
    ap.add_argument("--mode", choices=["overwrite_days", "append"], default="overwrite_days", help="report writes")
    ap.add_argument("--history-start", default="2015-06-01", help="first trade day of the user profile")
    ap.add_argument("--option", action="append", default=[],
                    help="name=value passed to the job's plan, e.g. max_gap_s=600, compat=true, with_bounce=false")
    a = ap.parse_args(argv)
    start = dt.date.fromisoformat(a.start) if a.start else default_day()
    end = dt.date.fromisoformat(a.end) if a.end else start + dt.timedelta(days=1)
    tables = dict(x.split("=", 1) for x in a.table)
    srcs = [parse_source(spec) for spec in a.source]
    from livemetrics.session import get_spark
    spark = get_spark(app_name=f"livemetrics-{a.job}", extra={"spark.sql.session.timeZone": a.time_zone})
    if a.job == "dw_user_transaction":
        run_user_transaction(spark, tables, start, end, a.out, history_start=a.history_start)
    else:
        import time
        run_job(spark, a.job, tables, start, end, a.out, sources=srcs or None, mode=a.mode,
                load_time=a.load_time or int(time.time()), **parse_options(a.option))


if __name__ == "__main__":
    main()
