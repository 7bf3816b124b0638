"""User spend: rolling totals (U1), tiers (U2 in functions), extreme days (U3), top-k (U4)."""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livemetrics.functions.numeric import round_half_up

# Fixed values of the profile: the rolling windows, in days before the report day
# (0 = the day itself; 7 and 30 give 8- and 31-day windows, both ends included).
ROLLING = {"day_total": 0, "week_total": 7, "month_total": 30}


def _d(day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


def rolling_spend(trades: DataFrame, report_day, user: str = "user_id", day: str = "day",
                  amount: str = "price", windows: dict = ROLLING) -> DataFrame:
    """Per user, the spend of each trailing window ending on ``report_day``.

    One scan of the widest window with conditional sums; users with no spend in the widest
    window do not appear.  Totals are rounded half-up to 2 decimals.
    """
    d = _d(report_day)
    widest = max(windows.values())
    t = trades.where(F.col(day).between(F.lit(d - dt.timedelta(days=widest)), F.lit(d)))
    aggs = [round_half_up(F.sum(F.when(F.col(day) >= F.lit(d - dt.timedelta(days=n)), F.col(amount))
                               .otherwise(F.lit(0))), 2).alias(name)
            for name, n in windows.items()]
    return t.groupBy(user).agg(*aggs)


def rolling_spend_daily(daily: DataFrame, user: str = "user_id", day: str = "day", amount: str = "amount",
                        windows: dict = ROLLING) -> DataFrame:
    """U1 for every spend day at once: trailing totals per (user, day) from per-day totals,
    with a range window over the day number.  A user's window holds at most one row per
    calendar day, so no partition grows with the trade volume."""
    dn = F.unix_date(F.col(day))
    out = daily.withColumn("_dn", dn)
    for name, n in windows.items():
        w = Window.partitionBy(user).orderBy("_dn").rangeBetween(-n, 0)
        out = out.withColumn(name, round_half_up(F.sum(amount).over(w), 2))
    return out.drop("_dn")


def extreme_days(daily: DataFrame, user: str = "user_id", day: str = "day", amount: str = "amount") -> DataFrame:
    """Biggest spend day (ties -> the latest day) and first spend day, with amounts."""
    g = daily.groupBy(user).agg(
        F.max(F.struct(F.col(amount).alias("a"), F.col(day).alias("d"))).alias("_most"),
        F.min(F.struct(F.col(day).alias("d"), F.col(amount).alias("a"))).alias("_first"),
        F.max(day).alias("last_spent_day"))
    return g.select(user, F.col("_most.d").alias("most_spent_day"),
                    round_half_up(F.col("_most.a"), 2).alias("most_spent_amount"),
                    F.col("_first.d").alias("first_spent_day"),
                    round_half_up(F.col("_first.a"), 2).alias("first_spent_amount"),
                    "last_spent_day")


def top_k_string(df: DataFrame, user: str, item: str, value: str, k: int = 5, alias: str = "top5",
                 value_format=None) -> DataFrame:
    """U4: ``{id:value,...}`` of the ``k`` largest summed values per user.

    Order is value descending, then id ascending (ties broken by id, so the string is
    stable).  The ranking uses the full sums; ``value_format`` only shapes what is printed.  The rank filter is planned as a per-partition group limit before the
    shuffle, so a user with millions of items ships only ``k`` rows per partition.
    """
    per = df.groupBy(user, item).agg(F.sum(value).alias("_v"))
    shown = F.col("_v") if value_format is None else value_format(F.col("_v"))
    w = Window.partitionBy(user).orderBy(F.col("_v").desc(), F.col(item).asc())
    top = per.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    pairs = F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.concat_ws(
        ":", F.col(item).cast("string"), shown.cast("string")).alias("s"))))
    return (top.groupBy(user)
               .agg(pairs.alias("_p"))
               .select(user, F.concat(F.lit("{"), F.array_join(F.transform("_p", lambda x: x["s"]), ","),
                                      F.lit("}")).alias(alias)))


def top_k_as_of(df: DataFrame, first, user: str, item: str, value: str, epochs: DataFrame, k: int = 5,
                day: str = "day", alias: str = "top5", value_format=None) -> DataFrame:
    """U4 as of many days in one plan: ``top_k_string`` per (user, epoch) over all rows up to the epoch.

    ``epochs`` (user, epochs array<date>, ascending) are the days from ``first`` on at which a user's sums
    change, ``first`` included; between them the string stays what it is.  A sum is valid from
    its day to the item's next one.  Sums that only grow overtake each other but never fall, so of
    the state before the range only the ``k`` largest sums can ever show: a user's whole history
    shrinks to ``k`` rows beside the items that change inside the range.  A user with a falling sum in
    the range keeps all items.
    """
    first = F.lit(_d(first))
    per = df.groupBy(user, item, F.greatest(F.col(day), first).alias("_from")).agg(F.sum(value).alias("_add"))
    w = Window.partitionBy(user, item).orderBy("_from")
    sums = per.select(user, item, "_from", "_add", F.sum("_add").over(w).alias("_v"), F.lead("_from").over(w).alias("_to"))
    later = sums.where(F.col("_from") > first)
    base = sums.where(F.col("_from") == first)
    falling = later.where(F.col("_add") < 0).select(F.col(user).alias("_u")).distinct()
    rank = F.row_number().over(Window.partitionBy(user).orderBy(F.col("_v").desc(), F.col(item).asc()))
    top = (base.join(falling, F.col(user) == F.col("_u"), "left_anti")
               .withColumn("_rn", rank).where(F.col("_rn") <= k).drop("_rn"))
    everything = base.join(falling, F.col(user) == F.col("_u"), "left_semi")
    valid = later.unionByName(top).unionByName(everything).join(epochs, user)
    at = valid.select(user, item, "_v", F.explode(F.filter("epochs", lambda e: (e >= F.col("_from"))
                                                  & (F.col("_to").isNull() | (e < F.col("_to"))))).alias("_epoch"))
    out = top_k_string(at.withColumn("_key", F.struct(user, "_epoch")), "_key", item, "_v", k=k, alias=alias,
                       value_format=value_format)
    return out.select(F.col(f"_key.{user}").alias(user), F.col("_key._epoch").alias("epoch"), alias)


def daily_totals(trades: DataFrame, keys: Sequence[str] = ("user_id", "day"), amount: str = "price") -> DataFrame:
    return trades.groupBy(*keys).agg(F.sum(amount).alias("amount"))
