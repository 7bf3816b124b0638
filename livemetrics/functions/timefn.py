"""Time parsing and the per-row interval rules (S2 repair, S3 replay flag, S4 duration).

Raw logs carry times as text (``yyyy-MM-dd HH:mm:ss[.fff]``), epoch seconds or epoch
milliseconds; they are parsed once into TIMESTAMP in the session time zone, as Hive's
``from_unixtime`` / ``unix_timestamp`` do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livemetrics.functions.numeric import _c

TS_FMT = "yyyy-MM-dd HH:mm:ss"
DAY_FMT = "yyyy-MM-dd"
# Fixed values of the broadcast log format: an unfinished broadcast has this end
# time, and a replay carries this marker within the first characters of its title.
OPEN_END_PREFIX = "0001-01-01"
REPLAY_MARKER = "重播"


def parse_ts(x) -> Column:
    """Text to TIMESTAMP truncated to the second (fractions dropped, bad text -> NULL)."""
    return F.date_trunc("second", F.try_to_timestamp(_c(x)))


def parse_epoch_s(x) -> Column:
    """Epoch seconds (text or number) to TIMESTAMP."""
    return F.timestamp_seconds(F.floor(_c(x).try_cast("double")))


def parse_epoch_ms(x) -> Column:
    """Epoch milliseconds to TIMESTAMP truncated to the second (``floor(ms/1000)``)."""
    return F.timestamp_seconds(F.floor(_c(x).try_cast("double") / 1000))


def parse_compact_day(x) -> Column:
    """``yyyyMMdd`` text to DATE."""
    return F.try_to_timestamp(_c(x), F.lit("yyyyMMdd")).cast("date")


def epoch_seconds(x) -> Column:
    return F.unix_seconds(_c(x))


def fmt_ts(x) -> Column:
    return F.date_format(_c(x), TS_FMT)


def fmt_day(x) -> Column:
    return F.date_format(_c(x), DAY_FMT)


def repaired_end(start_text, end_text) -> Column:
    """S2 end rule on raw text: open end -> 23:59:59 of the start day; end before start
    -> start; otherwise the end, all truncated to the second."""
    b = parse_ts(start_text)
    e = parse_ts(end_text)
    day_end = F.try_to_timestamp(F.concat_ws(" ", F.to_date(b).cast("string"), F.lit("23:59:59")))
    return (F.when(_c(end_text).startswith(OPEN_END_PREFIX), day_end)
            .when(e < b, b)
            .otherwise(e))


def repair_interval(df: DataFrame, start: str, end: str, out_start: str | None = None,
                    out_end: str | None = None) -> DataFrame:
    """Parse a raw ``[start, end]`` text interval into repaired timestamps."""
    out_start = out_start or start
    out_end = out_end or end
    return (df.withColumn("__end", repaired_end(start, end))
              .withColumn(out_start, parse_ts(start))
              .withColumn(out_end, F.col("__end"))
              .drop("__end"))


def tag_replay(title, marker: str = REPLAY_MARKER, width: int = 4,
               yes: str = "replay", no: str = "live") -> Column:
    """S3: ``yes`` if the first ``width`` characters of the title contain the marker."""
    hit = F.substring(_c(title), 1, width).contains(marker)
    return F.when(hit, yes).otherwise(no)


def duration_minutes(start, end, digits: int = 2) -> Column:
    """(end - start) in minutes, rounded half-up to ``digits``."""
    secs = F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))
    return F.round(secs.cast("decimal(20,0)") / 60, digits).cast("double")
