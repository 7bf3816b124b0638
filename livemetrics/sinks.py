"""Writes: day-partition overwrite (B1), report writes (B2/B3), JDBC export."""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION_COLS = ["year", "month", "day"]


def with_partitions(df: DataFrame, day_col: str = "day") -> DataFrame:
    """Add ``year`` (yyyy), ``month`` (yyyy-MM) and ``day`` (yyyy-MM-dd) text partition
    columns derived from the data's own day, so a row never lands under another month."""
    d = F.to_date(F.col(day_col))
    return (df.withColumn("year", F.date_format(d, "yyyy"))
              .withColumn("month", F.date_format(d, "yyyy-MM"))
              .withColumn("day", F.date_format(d, "yyyy-MM-dd")))


class PartitionReplace:
    """Replace partition folders of a Parquet tree so that a crash leaves either the old days or a
    commit that can be finished.

    The rows are written to a staging folder inside the table (names that start with ``_`` are no
    data for Spark's readers).  Then a manifest appears by one rename: it lists every folder to
    replace and whether there are new rows for it.  From then on the commit is decided; applying it
    moves folder by folder and can be repeated: ``recover`` finishes every commit it finds, and every
    later write or ``read_committed`` calls it first.  Without a manifest a staging folder is garbage of a
    crashed write and changes nothing.  One writer per table at a time, as with any overwrite.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._root = spark, path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._new("/".join([self._root, *names]))

    def stage(self, df: DataFrame, cols: Sequence[str], fmt: str = "parquet") -> str:
        """Write the rows under a new commit id."""
        commit = uuid.uuid4().hex
        df.write.partitionBy(*cols).format(fmt).save(f"{self._root}/_staging/{commit}")
        return commit

    def decide(self, commit: str, depth: int, asked: Sequence[str] | None) -> None:
        """Publish the manifest.  ``asked`` are the folders to replace, also by nothing; by default
        exactly those that have staged rows."""
        base = f"{self._root}/_staging/{commit}"
        found = self._fs.globStatus(self._new(base + "/*" * depth)) or []
        have = {"/".join(x.getPath().toString().split("/")[-depth:]) for x in found if x.isDirectory()}
        replace = {f: f in have for f in (sorted(have) if asked is None else asked)}
        draft = self._at("_commits", f".{commit}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(replace).encode()))
        out.close()
        self._fs.rename(draft, self._at("_commits", f"{commit}.json"))

    def apply(self, commit: str) -> None:
        """Put the decided folders in place; any part of it may have been done before."""
        manifest = self._at("_commits", f"{commit}.json")
        stream = self._fs.open(manifest)
        text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        for folder, has_rows in json.loads(text).items():
            staged, target = self._at("_staging", commit, folder), self._at(folder)
            if self._fs.exists(staged):
                self._fs.delete(target, True)
                self._fs.mkdirs(target.getParent())
                if not self._fs.rename(staged, target):
                    raise OSError(f"cannot move {staged} to {target}")
            elif not has_rows:
                self._fs.delete(target, True)
        self._fs.delete(manifest, False)
        self._fs.delete(self._at("_staging", commit), True)

    def recover(self) -> int:
        """Finish the decided commits and drop undecided staging folders; the number finished."""
        done = self._fs.globStatus(self._at("_commits", "*.json")) or []
        for x in sorted(done, key=lambda x: x.getModificationTime()):
            self.apply(x.getPath().getName().removesuffix(".json"))
        if self._fs.exists(self._at("_staging")):
            self._fs.delete(self._at("_staging"), True)
        return len(done)

    def replace(self, df: DataFrame, cols: Sequence[str], asked: Sequence[str] | None, fmt: str = "parquet") -> None:
        self.recover()
        commit = self.stage(df, cols, fmt)
        self.decide(commit, len(cols), asked)
        self.apply(commit)


def read_committed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table after finishing what a crashed writer had decided."""
    PartitionReplace(spark, path).recover()
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.parquet(path)


def _spread(df: DataFrame, *cols: str) -> DataFrame:
    """Cluster rows by partition column, splitting a large partition over many tasks: a
    REBALANCE exchange, whose oversized partitions AQE divides by the advisory size, at most
    into one piece per upstream task."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


def _dates(days: Sequence) -> list[dt.date]:
    return [d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in days]


def overwrite_partitions(df: DataFrame, path: str, day_col: str = "day", fmt: str = "parquet",
                         days: Sequence | None = None) -> None:
    """B1: replace day partitions; other days are untouched (see ``PartitionReplace``).

    ``days`` are the days the caller asked for: each of them is replaced, also by nothing, as
    ``INSERT OVERWRITE .. PARTITION (day)`` does, and rows of other days are not written.
    Without ``days`` exactly the days present in ``df`` are replaced.  A day is spread over as
    many tasks as its size asks for.
    """
    out, asked = with_partitions(df, day_col), None
    if days is not None:
        days = _dates(days)
        out = out.where(F.col("day").isin([d.isoformat() for d in days]))
        asked = [f"year={d:%Y}/month={d:%Y-%m}/day={d:%Y-%m-%d}" for d in days]
    PartitionReplace(df.sparkSession, path).replace(_spread(out, "day"), PARTITION_COLS, asked, fmt)


def write_report(df: DataFrame, path: str, mode: str = "overwrite_days", day_col: str = "date",
                 days: Sequence | None = None) -> None:
    """B2: report tables.  Default replaces the report days (a rerun does not duplicate a
    day), with ``days`` exactly those, also by nothing; ``mode="append"`` appends as the original
    reports did."""
    out, asked = df.withColumn("report_day", F.col(day_col).cast("string")), None
    if days is not None:
        text = [d.isoformat() for d in _dates(days)]
        out, asked = out.where(F.col("report_day").isin(text)), [f"report_day={d}" for d in text]
    if mode == "append":
        PartitionReplace(df.sparkSession, path).recover()
        out.repartition("report_day").write.mode("append").partitionBy("report_day").parquet(path)
        return
    PartitionReplace(df.sparkSession, path).replace(_spread(out, "report_day"), ["report_day"], asked)


def create_table(spark: SparkSession, name: str, schema: StructType, comment: str | None = None) -> None:
    """Create a catalog table with typed, commented columns if it does not exist."""
    if spark.catalog.tableExists(name):
        return
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{f.metadata['comment']}'" if f.metadata.get("comment") else "")
        for f in schema.fields)
    c = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{c}")


def export_jdbc(df: DataFrame, url: str, table: str, day: str | None = None, day_col: str = "date",
                user_env: str = "REPORT_DB_USER", password_env: str = "REPORT_DB_PASSWORD",
                num_partitions: int = 8, batch_size: int = 10_000, extra: dict | None = None) -> None:
    """Append one report day (or the whole frame) to a database table over JDBC.

    Credentials are read from the caller's environment, never from code.  The write is
    limited to ``num_partitions`` concurrent connections.
    """
    if day is not None:
        df = df.where(F.col(day_col) == F.lit(day))
    # repartition, not coalesce: the last stage keeps its own parallelism, only the writers are few
    w = (df.repartition(num_partitions).write.format("jdbc").mode("append")
           .option("url", url).option("dbtable", table).option("batchsize", batch_size))
    user, pwd = os.environ.get(user_env), os.environ.get(password_env)
    if user:
        w = w.option("user", user)
    if pwd:
        w = w.option("password", pwd)
    for k, v in (extra or {}).items():
        w = w.option(k, v)
    w.save()
