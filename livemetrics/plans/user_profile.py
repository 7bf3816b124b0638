"""The user transaction profile of one report day, or of every day of a range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemetrics.functions.numeric import round_half_up, tier
from livemetrics.functions.predicates import valid_trades
from livemetrics.operators.spend import (
    ROLLING, daily_totals, extreme_days, rolling_spend, top_k_as_of, top_k_string,
)
from livemetrics.staging import stage

PROFILE_COLUMNS = ["date", "user_id", "day_total", "day_prange", "week_total", "week_prange",
                   "month_total", "month_prange", "most_spent_day", "most_spent_amount",
                   "first_spent_day", "first_spent_amount", "top5_item", "top5_room"]


def trade_grain(trades: DataFrame, last_day, history_start) -> DataFrame:
    """The valid trades of [history_start, last_day] reduced to (user, day, item, room) and staged:
    every part of the profile, and every report day, reads this grain instead of the history."""
    d = dt.date.fromisoformat(str(last_day))
    h = dt.date.fromisoformat(str(history_start))
    t = trades.where(valid_trades() & F.col("day").between(F.lit(h), F.lit(d)))
    return stage(t.groupBy("user_id", "day", "item_id", "room_id")
                  .agg(F.sum("item_num").alias("item_num"), F.sum("price").alias("price")), "trade_grain")


def user_transaction(trades: DataFrame, report_day, history_start) -> DataFrame:
    """One row per user with a valid trade in [history_start, report_day].

    Top-5 items (by item count) and rooms (by spend, 2 decimals), biggest and first
    spend days, and the day / 8-day / 31-day spend with its tier.
    """
    return user_transaction_from_grain(trade_grain(trades, report_day, history_start), report_day)


def user_transaction_from_grain(grain: DataFrame, report_day) -> DataFrame:
    """The profile of one report day from ``trade_grain`` (later days of it are left out)."""
    d = dt.date.fromisoformat(str(report_day))
    g = grain.where(F.col("day") <= F.lit(d))
    t3 = top_k_string(g, "user_id", "item_id", "item_num", alias="top5_item")
    t4 = top_k_string(g, "user_id", "room_id", "price", alias="top5_room",
                      value_format=lambda c: F.round(c, 2))
    t2 = extreme_days(daily_totals(g))
    t1 = rolling_spend(g, d)
    j = t3.join(t4, "user_id", "left").join(t2, "user_id", "left").join(t1, "user_id", "left")
    out = [F.lit(d.isoformat()).alias("date"), "user_id"]
    for c, p in (("day_total", "day_prange"), ("week_total", "week_prange"), ("month_total", "month_prange")):
        out += [F.coalesce(F.col(c), F.lit(0.0)).alias(c), tier(c).alias(p)]
    out += [F.date_format("most_spent_day", "yyyy-MM-dd").alias("most_spent_day"), "most_spent_amount",
            F.date_format("first_spent_day", "yyyy-MM-dd").alias("first_spent_day"), "first_spent_amount",
            "top5_item", "top5_room"]
    return j.select(*out)


def user_transaction_range(grain: DataFrame, first, last) -> DataFrame:
    """The profiles of every report day of ``[first, last]``, as ``user_transaction_from_grain`` gives
    them day by day, in one plan whose size does not depend on the number of days.

    What a user's profile shows changes only on the user's own trade days (``epochs``): strings and
    extreme days are computed there and hold until the next one.  The rolling totals are sums of
    daily totals dealt to the report days that see them, then one map per user, at most an entry per
    report day.  The states are spread over the report days last, after the last exchange: what is
    shuffled has a row per user and epoch, and a user's rows, mostly alike, are written together.
    """
    a, b = dt.date.fromisoformat(str(first)), dt.date.fromisoformat(str(last))
    lo, hi = F.lit(a), F.lit(b)
    g = grain.where(F.col("day") <= hi)
    epochs = stage(g.groupBy("user_id").agg(F.array_sort(F.collect_set(F.greatest("day", lo))).alias("epochs")), "epochs")
    t3 = top_k_as_of(g, a, "user_id", "item_id", "item_num", epochs, alias="top5_item")
    t4 = top_k_as_of(g, a, "user_id", "room_id", "price", epochs, alias="top5_room", value_format=lambda c: F.round(c, 2))

    # extreme days: what lies before the range is one row per user, then one per trade day
    daily = daily_totals(g)
    steps = daily.groupBy("user_id", F.greatest("day", lo).alias("epoch")).agg(
        F.max(F.struct(F.col("amount").alias("a"), F.col("day").alias("d"))).alias("_most"),
        F.min(F.struct(F.col("day").alias("d"), F.col("amount").alias("a"))).alias("_first"))
    so_far = Window.partitionBy("user_id").orderBy("epoch")
    t2 = steps.select("user_id", "epoch", F.max("_most").over(so_far).alias("_most"), F.min("_first").over(so_far).alias("_first"),
                      F.date_sub(F.coalesce(F.lead("epoch").over(so_far), F.date_add(hi, 1)), 1).alias("_until"))
    states = t2.join(t3, ["user_id", "epoch"], "left").join(t4, ["user_id", "epoch"], "left")

    widest = max(ROLLING.values())
    recent = daily.where(F.col("day") >= F.lit(a - dt.timedelta(days=widest)))
    seen = recent.select("user_id", "amount", F.col("day").alias("_spent"), F.explode(F.sequence(
        F.greatest("day", lo), F.least(F.date_add("day", widest), hi))).alias("day"))
    t1 = seen.groupBy("user_id", "day").agg(*[
        round_half_up(F.sum(F.when(F.date_diff("day", "_spent") <= n, F.col("amount")).otherwise(F.lit(0))), 2).alias(name)
        for name, n in ROLLING.items()])
    totals = t1.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("day", F.struct(*ROLLING)))).alias("_totals"))

    j = (states.join(totals, "user_id", "left").withColumn("day", F.explode(F.sequence("epoch", "_until")))
               .withColumn("_t", F.col("_totals")[F.col("day")]))
    out = [F.date_format("day", "yyyy-MM-dd").alias("date"), "user_id"]
    for c, p in (("day_total", "day_prange"), ("week_total", "week_prange"), ("month_total", "month_prange")):
        out += [F.coalesce(F.col(f"_t.{c}"), F.lit(0.0)).alias(c), tier(F.col(f"_t.{c}")).alias(p)]
    return j.select(*out, F.date_format("_most.d", "yyyy-MM-dd").alias("most_spent_day"),
                    round_half_up(F.col("_most.a"), 2).alias("most_spent_amount"),
                    F.date_format("_first.d", "yyyy-MM-dd").alias("first_spent_day"),
                    round_half_up(F.col("_first.a"), 2).alias("first_spent_amount"), "top5_item", "top5_room")
