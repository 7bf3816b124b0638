"""Day-partitioned scans.

Tables are partitioned by ``year/month/day`` strings.  Every scan filters on the raw
partition column with literals so Spark prunes partitions and pushes the rest of the
predicate into the Parquet reader; no function is ever applied to the partition column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a Parquet table; pass the schema to skip inference on wide partitioned trees."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def _day(day) -> str:
    return day.isoformat() if isinstance(day, (dt.date, dt.datetime)) else str(day)


def day_scan(df: DataFrame, day, col: str = "day") -> DataFrame:
    """A1: one day partition."""
    return df.where(F.col(col) == F.lit(_day(day)))


def day_range(df: DataFrame, start, end, col: str = "day") -> DataFrame:
    """A2: inclusive day range."""
    return df.where(F.col(col).between(F.lit(_day(start)), F.lit(_day(end))))


def lagged_day(df: DataFrame, day, n: int, col: str = "day") -> DataFrame:
    """A3: the day ``n`` days before ``day`` (D-1, D-7).  The literal is computed in
    Python so the predicate stays a plain partition filter."""
    d = dt.date.fromisoformat(_day(day)) - dt.timedelta(days=n)
    return df.where(F.col(col) == F.lit(d.isoformat()))


def compact_day_scan(df: DataFrame, day, col: str = "date") -> DataFrame:
    """A4: logs keyed by a compact ``yyyyMMdd`` text day; compare the raw column with the
    re-formatted literal instead of re-formatting the column (keeps pushdown)."""
    return df.where(F.col(col) == F.lit(_day(day).replace("-", "")))


def on_days(df: DataFrame, days: list[dt.date], col: str = "day", compact: bool = False) -> DataFrame:
    """A1-A4 for any days by a literal filter on the raw column: one day, a range where the days are
    consecutive, a list otherwise (a one-day retention report reads three days, not eight)."""
    days = sorted(days)
    if compact and len(days) == 1:
        return compact_day_scan(df, days[0], col)
    if len(days) == 1:
        return day_scan(df, days[0], col)
    text = [d.strftime("%Y%m%d") if compact else d.isoformat() for d in days]
    if (days[-1] - days[0]).days == len(days) - 1:
        return day_range(df, text[0], text[-1], col)
    return df.where(F.col(col).isin(text))


def valid_rooms(df: DataFrame, col: str = "room_id") -> DataFrame:
    """A5: dimension rows with a usable room id."""
    return df.where(F.col(col) > 0)
