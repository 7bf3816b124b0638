"""B1/B2 idempotent writes, B6 backfill, streaming re-run of touched days."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from livemetrics.jobs import backfill, days_between, default_day
from livemetrics.sinks import PartitionReplace, overwrite_partitions, read_committed, write_report
from livemetrics.streaming.incremental import rerun_touched_days


def test_overwrite_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="lm-sink-")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, v long")
    overwrite_partitions(a, out)
    overwrite_partitions(a, out)
    b = spark.createDataFrame([("2024-01-02", 5)], "day string, v long")
    overwrite_partitions(b, out)                       # replaces only 2024-01-02
    got = sorted((r.day, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 1), ("2024-01-02", 5)]
    assert os.path.isdir(os.path.join(out, "year=2024", "month=2024-01", "day=2024-01-01"))


def test_requested_days_are_replaced_also_by_nothing(spark):
    out = tempfile.mkdtemp(prefix="lm-sink0-")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "day string, v long")
    overwrite_partitions(a, out)
    b = spark.createDataFrame([("2024-01-03", 9), ("2024-01-07", 7)], "day string, v long")
    overwrite_partitions(b, out, days=["2024-01-02", "2024-01-03", "2024-01-04"])
    got = sorted((r.day, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("2024-01-01", 1), ("2024-01-03", 9)]      # 02 emptied, 07 not asked for
    overwrite_partitions(b.limit(0), out, days=["2024-01-01", "2024-01-03"])
    assert not [f for _, _, files in os.walk(out) for f in files if f.startswith("part-")]


def test_one_day_is_written_by_many_tasks(spark):
    out = tempfile.mkdtemp(prefix="lm-sink1-")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        overwrite_partitions(spark.range(0, 400_000, 1, 12).select(F.lit("2024-01-01").alias("day"), F.rand(3).alias("x")), out,
                             days=["2024-01-01"])
    finally:
        spark.conf.set(key, old)
    files = [f for _, _, names in os.walk(out) for f in names if f.startswith("part-") and f.endswith(".parquet")]
    assert len(files) > 4 and spark.read.parquet(out).count() == 400_000


def test_stream_reads_only_touched_days(spark):
    raw, out = tempfile.mkdtemp(prefix="lm-raw2-"), tempfile.mkdtemp(prefix="lm-out2-")
    from pyspark.sql.types import StructType
    schema = "room_id long, day string"
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], schema).write.mode("append").partitionBy("day").parquet(raw)
    plans = []

    def build(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.groupBy("day").agg(F.count("room_id").alias("n"))

    for _ in range(2):
        rerun_touched_days(spark, raw, StructType.fromDDL(schema), build, out, name="t2", trigger_once=True).awaitTermination(120)
        spark.createDataFrame([(3, "2024-01-02")], schema).write.mode("append").partitionBy("day").parquet(raw)
    assert "PartitionFilters: [isnotnull(day" in plans[-1] and "= 2024-01-02)" in plans[-1] and "2024-01-01" not in plans[-1]
    assert sorted((r.day, r.n) for r in spark.read.parquet(out).collect()) == [("2024-01-01", 1), ("2024-01-02", 2)]


def _days(spark, out):
    return sorted((r.day, r.v) for r in spark.read.parquet(out).collect())


def test_a_crash_before_the_manifest_changes_nothing(spark):
    out = tempfile.mkdtemp(prefix="lm-atom-")
    a = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "day string, v long")
    overwrite_partitions(a, out)
    t = PartitionReplace(spark, out)
    from livemetrics.sinks import with_partitions
    t.stage(with_partitions(spark.createDataFrame([("2024-01-01", 9)], "day string, v long")), ["year", "month", "day"])
    assert _days(spark, out) == [("2024-01-01", 1), ("2024-01-02", 2)]       # staged rows are no data
    assert _days(spark, out) == sorted((r.day, r.v) for r in read_committed(spark, out).collect())
    assert not os.path.isdir(os.path.join(out, "_staging"))


def test_a_crash_between_the_moves_is_finished(spark, monkeypatch):
    """Three days asked for: one gets new rows, one is emptied, one is new.  The writer dies after
    each number of file system steps; the next reader sees the whole commit or none of it."""
    import pytest

    from livemetrics import sinks
    new = spark.createDataFrame([("2024-01-01", 9), ("2024-01-03", 7)], "day string, v long")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    old_rows, new_rows = [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-04", 4)], [("2024-01-01", 9), ("2024-01-03", 7), ("2024-01-04", 4)]

    class Dying:
        """A file system that fails after a number of changes."""
        def __init__(self, fs, steps):
            self._fs, self._left = fs, steps

        def __getattr__(self, name):
            f = getattr(self._fs, name)
            if name not in ("delete", "rename", "mkdirs"):
                return f

            def step(*a):
                if self._left == 0:
                    raise RuntimeError("killed")
                self._left -= 1
                return f(*a)
            return step

    seen = set()
    for steps in range(12):
        out = tempfile.mkdtemp(prefix="lm-kill-")
        overwrite_partitions(spark.createDataFrame(old_rows, "day string, v long"), out)
        real = sinks.PartitionReplace.__init__

        def dying(self, spark, path, steps=steps):
            real(self, spark, path)
            self._fs = Dying(self._fs, steps)

        monkeypatch.setattr(sinks.PartitionReplace, "__init__", dying)
        try:
            overwrite_partitions(new, out, days=days)
            killed = False
        except RuntimeError:
            killed = True
        monkeypatch.setattr(sinks.PartitionReplace, "__init__", real)
        got = sorted((r.day, r.v) for r in read_committed(spark, out).collect())
        assert got in (old_rows, new_rows) and (killed or got == new_rows)
        assert not [f for _, _, names in os.walk(os.path.join(out, "_commits")) for f in names if f.endswith(".json")]
        seen.add((killed, got == new_rows))
    assert seen == {(True, False), (True, True), (False, True)}
    with pytest.raises(ValueError):
        overwrite_partitions(new, out, days=["no day"])


def test_a_rerun_of_a_report_without_rows_leaves_none(spark):
    out = tempfile.mkdtemp(prefix="lm-rpt0-")
    r = spark.createDataFrame([("2024-01-01", 3), ("2024-01-02", 4)], "date string, uv long")
    write_report(r, out, days=["2024-01-01", "2024-01-02"])
    write_report(r.where("uv > 9"), out, days=["2024-01-01"])
    assert [(x.date, x.uv) for x in spark.read.parquet(out).collect()] == [("2024-01-02", 4)]


def test_report_overwrite_and_append(spark):
    out = tempfile.mkdtemp(prefix="lm-rpt-")
    r = spark.createDataFrame([("2024-01-01", 3)], "date string, uv long")
    write_report(r, out)
    write_report(r, out)
    assert spark.read.parquet(out).count() == 1
    write_report(r, out, mode="append")
    assert spark.read.parquet(out).count() == 2


def test_backfill_and_days():
    assert days_between("2024-01-30", "2024-02-02") == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert default_day(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


def test_backfill_writes_range(spark):
    out = tempfile.mkdtemp(prefix="lm-bf-")
    src = spark.createDataFrame([(f"2024-01-0{i}", i) for i in range(1, 6)], "day string, v long")

    def build(first, last):
        return src.where(F.to_date("day").between(F.lit(first), F.lit(last)))

    backfill(build, "2024-01-02", "2024-01-04", out, lookahead_days=1)
    assert sorted(r.day for r in spark.read.parquet(out).collect()) == ["2024-01-02", "2024-01-03"]


def test_stream_reruns_touched_days(spark):
    raw = tempfile.mkdtemp(prefix="lm-raw-")
    out = tempfile.mkdtemp(prefix="lm-out-")
    schema = "day string, room_id long, count long"
    spark.createDataFrame([("2024-01-01", 1, 2), ("2024-01-01", 1, 3)], schema).write.mode("append").parquet(raw)

    def build(df):
        return df.groupBy("day", "room_id").agg(F.sum("count").alias("total"))

    from pyspark.sql.types import StructType
    st = StructType.fromDDL(schema)
    q = rerun_touched_days(spark, raw, st, build, out, name="t1", trigger_once=True)
    q.awaitTermination(120)
    spark.createDataFrame([("2024-01-01", 1, 10)], schema).write.mode("append").parquet(raw)   # late row
    q = rerun_touched_days(spark, raw, st, build, out, name="t1", trigger_once=True)
    q.awaitTermination(120)
    got = [(r.day, r.total) for r in spark.read.parquet(out).collect()]
    assert got == [("2024-01-01", 15)]


def test_create_report_table(spark):
    from livemetrics.sinks import create_table
    from livemetrics.sources.schemas import SOURCE_REPORT
    name = "lm_test_source_report"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, SOURCE_REPORT, comment="source report")
    create_table(spark, name, SOURCE_REPORT)                     # exists: no-op
    cols = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert cols["new_user_cnt"] == "new users" and "7_days_retention_rate" in cols
    spark.sql(f"DROP TABLE {name}")


def test_parse_source_specs(spark):
    from livemetrics.jobs import parse_source
    df = spark.createDataFrame([("", "https://x/land?a", "t-1"), ("https://ref.example/", "/land", "u-2"),
                                (None, "/land", "400-3")], "source_url string, url string, tid string")
    hits = lambda spec: [bool(r[0]) for r in df.select(parse_source(spec).condition).collect()]
    assert parse_source("a:tid:^400").name == "a" and hits("a:tid:^400") == [False, False, True]
    assert hits(r"b:empty|ref\.example:land") == [True, True, False]       # NULL referrer is not empty
    assert hits(r"c:ref\.example:land") == [False, True, False]
