"""Windows, tiers, extreme days, top-5 strings, profile."""

import datetime as dt
from decimal import Decimal


from pyspark.sql import functions as F

from livemetrics.operators.spend import extreme_days, rolling_spend, top_k_string
from livemetrics.plans.user_profile import user_transaction

D = dt.date(2024, 3, 31)
TR = "day date, tr_date string, room_id long, user_id long, operator_id long, item_id long, item_num long, " \
     "price decimal(18,2), trade_status int, product_name string"


def tr(day, user, price, room=1, item=1, n=1):
    return (day, "", room, user, user, item, n, Decimal(str(price)), 1, "platform")


def test_rolling_windows(spark):
    ds = [D, D - dt.timedelta(7), D - dt.timedelta(8), D - dt.timedelta(30), D - dt.timedelta(31)]
    t = spark.createDataFrame([tr(d, 1, 1) for d in ds] + [tr(D - dt.timedelta(40), 2, 5)], TR)
    got = {r.user_id: r for r in rolling_spend(t, D).collect()}
    assert set(got) == {1}                       # user with old spend only: absent
    assert (got[1].day_total, got[1].week_total, got[1].month_total) == (1.0, 2.0, 4.0)


def test_extreme_days_ties(spark):
    daily = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5.0), (1, dt.date(2024, 1, 3), 5.0),
                                   (1, dt.date(2024, 1, 2), 1.0)], "user_id long, day date, amount double")
    r = extreme_days(daily).first()
    assert (r.most_spent_day, r.most_spent_amount) == (dt.date(2024, 1, 3), 5.0)   # latest of the tie
    assert (r.first_spent_day, r.first_spent_amount) == (dt.date(2024, 1, 1), 5.0)


def test_top5(spark):
    t = spark.createDataFrame([(1, i, v) for i, v in [(1, 9), (2, 8), (3, 7), (4, 5), (5, 5), (6, 5), (7, 1)]]
                              + [(2, 3, 1), (2, 1, 2)], "user_id long, item_id long, n long")
    got = {r.user_id: r.top5 for r in top_k_string(t, "user_id", "item_id", "n").collect()}
    assert got[1] == "{1:9,2:8,3:7,4:5,5:5}"       # tied fifth: lower id wins
    assert got[2] == "{1:2,3:1}"                   # fewer than five


def test_profile(spark):
    rows = [tr(D, 1, "600.00", room=2, item=3, n=2), tr(D - dt.timedelta(3), 1, "4500.01", room=4, item=3),
            tr(D - dt.timedelta(20), 1, "50000.00", room=4, item=9), tr(dt.date(2023, 1, 1), 2, "10.00")]
    t = spark.createDataFrame(rows, TR)
    out = {r.user_id: r for r in user_transaction(t, D, "2015-06-01").collect()}
    a, b = out[1], out[2]
    assert (a.day_total, a.day_prange, a.week_total, a.week_prange) == (600.0, "p1", 5100.01, "p2")
    assert (a.month_total, a.month_prange) == (55100.01, "p3")
    assert (a.most_spent_day, a.most_spent_amount, a.first_spent_day) == ("2024-03-11", 50000.0, "2024-03-11")
    assert a.top5_item == "{3:3,9:1}" and a.top5_room == "{4:54500.01,2:600.00}"
    assert (b.day_total, b.day_prange, b.month_prange) == (0.0, "p0", "p0")


def test_top5_ranks_unrounded_sums(spark):
    t = spark.createDataFrame([(1, i, f"10.00{i}") for i in range(1, 8)], "user_id long, room_id long, p string") \
        .withColumn("p", F.col("p").cast("decimal(18,4)"))
    got = top_k_string(t, "user_id", "room_id", "p", value_format=lambda c: F.round(c, 2)).first().top5
    assert got == "{7:10.01,6:10.01,5:10.01,4:10.00,3:10.00}"


def _range_equals_days(spark, rows, first, last):
    import datetime as dt

    from livemetrics.plans.user_profile import trade_grain, user_transaction_from_grain, user_transaction_range
    t = spark.createDataFrame(rows, TR)
    grain = trade_grain(t, last, "2015-06-01")
    got = user_transaction_range(grain, first, last)
    days = [first + dt.timedelta(i) for i in range((last - first).days + 1)]
    want = [tuple(r) for d in days for r in user_transaction_from_grain(grain, d).select(*got.columns).collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and want
    return got


def test_profiles_of_a_range_equal_those_of_every_day(spark):
    """New items overtake old ones, sums tie, users begin inside the range, one user's sums fall."""
    import random
    rnd, first, last, rows = random.Random(4), D - dt.timedelta(6), D, []
    for user in range(1, 9):
        for _ in range(rnd.choice([1, 6, 40, 90])):
            back = rnd.choice([0, 1, 2, 4, 6, 7, 9, 20, 36, 37, 300])
            price = rnd.choice(["1.00", "2.50", "600.00", "4000.10"])
            rows.append(tr(D - dt.timedelta(back), user, price, room=rnd.randrange(12), item=rnd.randrange(14), n=rnd.randrange(1, 5)))
    for back in (50, 40, 5, 3, 1):           # falling sums bring back what was out of the first five
        for item in range(9):
            rows.append(tr(D - dt.timedelta(back), 99, "10.00", room=item, item=item, n=(-40 if item < 3 else 1) if back == 3 else 10 - item))
    rows.append(tr(D - dt.timedelta(2), 50, "5.00"))
    _range_equals_days(spark, rows, first, last)
    _range_equals_days(spark, rows, last, last)


def test_the_plan_of_a_range_does_not_grow_with_the_days(spark):
    from livemetrics.plans.user_profile import trade_grain, user_transaction_range
    grain = trade_grain(spark.createDataFrame([tr(D, 1, "5.00")], TR), D, "2015-06-01")
    sizes = {n: len(user_transaction_range(grain, D - dt.timedelta(n), D)._jdf.queryExecution().optimizedPlan().toString().splitlines())
             for n in (1, 300)}
    assert sizes[1] == sizes[300]


def test_a_range_is_spread_over_its_days_last(spark):
    """Nothing is exchanged or joined once a user's state has been repeated for every report day."""
    from livemetrics.plans.user_profile import trade_grain, user_transaction_range
    rows = [tr(D - dt.timedelta(9), 1, "600.00", item=3), tr(D - dt.timedelta(2), 1, "7.00", item=4), tr(D, 2, "1.00"),
            (D - dt.timedelta(1), "", 1, None, None, 5, 1, Decimal("3.00"), 1, "platform")]
    grain = trade_grain(spark.createDataFrame(rows, TR), D, "2015-06-01")
    out = user_transaction_range(grain, D - dt.timedelta(3), D)
    above = out._jdf.queryExecution().executedPlan().toString().split("Generate explode(sequence(epoch")[0]
    assert "Exchange" not in above and "Join" not in above
    got = {(r.user_id, r.date): (r.day_total, r.week_total, r.month_total, r.most_spent_day) for r in out.collect()}
    assert got == {(1, "2024-03-28"): (0.0, 600.0, 600.0, "2024-03-22"), (1, "2024-03-29"): (7.0, 607.0, 607.0, "2024-03-22"),
                   (1, "2024-03-30"): (0.0, 7.0, 607.0, "2024-03-22"), (1, "2024-03-31"): (0.0, 7.0, 607.0, "2024-03-22"),
                   (2, "2024-03-31"): (1.0, 1.0, 1.0, "2024-03-31"),
                   (None, "2024-03-30"): (0.0, 0.0, 0.0, "2024-03-30"), (None, "2024-03-31"): (0.0, 0.0, 0.0, "2024-03-30")}
