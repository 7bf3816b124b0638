"""Room-level operators: player-log cleaning and watch metrics (M1, M2), revenue (M4),
subscriptions (M5) and broadcast minutes (M6)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livemetrics.functions.numeric import decimal0, round_half_up, safe_div, text_long
from livemetrics.functions.predicates import valid_trades
from livemetrics.functions.timefn import OPEN_END_PREFIX, parse_ts, repaired_end

# Fixed values of the player log: a play is valid from 15 s, and a single record cannot
# exceed one day; PC clients report play time net of stalls already.
VALID_PLAY_MS = 15_000
MAX_PLAY_MS = 86_400_000
PC_PREFIX = "PC"


def effective_play(log: DataFrame, play: str = "playduration", stuck: str = "stuckduration",
                   os: str = "ostype", out: str = "play_duration", keep_nan: bool = False) -> DataFrame:
    """M1: keep records with 0 <= play <= one day and a non-negative stall time; effective
    play = play on PC clients, play - stall elsewhere.  A stall of ``NaN`` is dropped
    (the original filter did so); ``keep_nan=True`` counts it as 0 instead.  Both times are
    number text and may carry a fraction."""
    p, s = text_long(play), text_long(stuck)
    is_nan = F.col(stuck) == "NaN"
    ok_stuck = (s >= 0) | is_nan if keep_nan else (s >= 0)
    eff = (F.when(F.substring(F.col(os), 1, 2) == PC_PREFIX, p)
            .otherwise(p - F.when(is_nan, F.lit(0)).otherwise(s)))
    return log.where(p.between(0, MAX_PLAY_MS) & ok_stuck).withColumn(out, eff)


def watch_metrics(df: DataFrame, keys: Sequence[str], play: str = "play_duration",
                  device: str = "deviceid") -> DataFrame:
    """M2: vv, valid_vv, vv_device, valid_vv_device, play_duration (min), awt (min).

    awt = sum of all effective plays (negative ones too) / devices with a positive play;
    play_duration sums positive plays only.  Distinct devices are counted by grouping to
    the device first, so the shuffle carries one partial row per device and key.
    """
    p = F.col(play)
    per_dev = (df.groupBy(*keys, device)
                 .agg(F.sum(p).alias("_all"),
                      F.sum(F.when(p > 0, p).otherwise(0)).alias("_pos"),
                      F.count_if(p > 0).alias("_vv"),
                      F.count_if(p >= VALID_PLAY_MS).alias("_valid")))
    dev_ok = F.col(device).isNotNull()
    g = (per_dev.groupBy(*keys)
                .agg(F.sum("_all").alias("_all"), F.sum("_pos").alias("_pos"),
                     F.sum("_vv").alias("vv"), F.sum("_valid").alias("valid_vv"),
                     F.count_if(dev_ok & (F.col("_vv") > 0)).alias("vv_device"),
                     F.count_if(dev_ok & (F.col("_valid") > 0)).alias("valid_vv_device")))
    return g.select(
        *keys,
        F.coalesce(decimal0(safe_div("_all", "vv_device") / 1000 / 60), F.lit(0).cast("long")).alias("awt"),
        F.col("vv").cast("long").alias("vv"), F.col("valid_vv").cast("long").alias("valid_vv"),
        decimal0(F.col("_pos") / 1000 / 60).alias("play_duration"),
        "vv_device", "valid_vv_device")


def room_revenue(trades: DataFrame, keys: Sequence[str], price: str = "price", items: str = "item_num",
                 payer: str = "operator_id") -> DataFrame:
    """M4 / I4: total price (2 decimals), item count and distinct payers of valid trades."""
    t = trades.where(valid_trades())
    per_payer = t.groupBy(*keys, payer).agg(F.sum(price).alias("_p"), F.sum(items).alias("_i"))
    g = per_payer.groupBy(*keys).agg(F.sum("_p").alias("_p"), F.sum("_i").alias("_i"),
                                     F.count(payer).alias("total_paying_user_num"))
    return g.select(*keys, round_half_up(F.col("_p"), 2).alias("total_price"),
                    F.col("_i").cast("int").alias("total_item_num"), "total_paying_user_num")


def room_subscriptions(subs: DataFrame, keys: Sequence[str], active: str = "actived") -> DataFrame:
    """M5: new active subscriptions per key."""
    return subs.where(F.col(active) == 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("daily_subscription"))


def room_broadcast(raw: DataFrame, keys: Sequence[str], start: str = "begin_time",
                   end: str = "end_time", compat: bool = False) -> DataFrame:
    """M6: broadcast minutes per key from raw segments (end repaired as in S2), rounded to 2.

    An inverted segment counts 0 minutes and still marks the room as broadcasting.
    ``compat=True`` gives it no minutes at all (NULL, as the original job's mixed-type
    branch did), so a room with only inverted segments has NULL minutes - not broadcasting.
    """
    b, e = parse_ts(start), parse_ts(end)
    secs = F.unix_seconds(repaired_end(start, end)) - F.unix_seconds(b)
    if compat:
        inverted = ~F.col(end).startswith(OPEN_END_PREFIX) & (e < b)
        secs = F.when(inverted, F.lit(None).cast("long")).otherwise(secs)
    return (raw.groupBy(*keys)
               .agg(F.sum(secs).alias("_s"))
               .select(*keys, F.round(F.col("_s").cast("decimal(20,0)") / 60, 2).cast("double")
                       .alias("play_minutes")))
