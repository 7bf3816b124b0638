"""P1-P7 on small tracks: zero visitors, cross-channel session, retention, sources."""

import datetime as dt


from livemetrics.functions.predicates import Source
from livemetrics.plans.reports import category_users, channel_report, source_report

D = dt.date(2024, 1, 8)
TRACK = "day date, pv_type int, site_type string, uuid string, ip string, first_login_time timestamp, " \
        "page_stay long, session_id_in_day long, seq_no_in_session long, source_url string, url string, tid string, is_new int"


def row(day, pv, site, uuid, sess, seq, new=0, src="", url="x", stay=60):
    fl = dt.datetime.combine(day, dt.time(1)) if new else dt.datetime(2023, 1, 1)
    return (day, pv, site, uuid, "ip-" + uuid, fl, stay, sess, seq, src, url, "t", new)


def test_channel_report(spark):
    d1 = D - dt.timedelta(1)
    t = spark.createDataFrame([
        row(d1, 1, "a", "u1", 1, 1, new=1), row(d1, 1, "a", "u2", 1, 1, new=1),     # cohort of D-1
        row(D, 1, "a", "u1", 5, 1), row(D, 2, "a", "u1", 5, 2),                     # one session, two channels
        row(D, 1, "a", "u3", 6, 1, new=1),                                          # single-view session
    ], TRACK)
    out = {(r.date, r.channel_name): r for r in channel_report(t).collect()}
    r = out[("2024-01-08", "内嵌_a")]
    assert (r.uv, r.pv, r.new_user_cnt, r.frequent_user_cnt, r.frequent_user_ratio) == (2, 2, 1, 1, 0.5)
    assert r.bounce_rate == 0.5                 # u1's session reached seq 2 (in the other channel)
    assert r["1_day_retention_rate"] == 0.5     # u1 of the two new users of D-1 came back
    assert r["7_days_retention_rate"] is None   # no cohort on D-7
    assert out[("2024-01-08", "跳转_a")].bounce_rate == 0.0
    assert out[("2024-01-07", "内嵌_a")]["1_day_retention_rate"] is None


def test_source_report_zero_and_referrers(spark):
    t = spark.createDataFrame([
        row(D, 1, "a", "u1", 1, 1, new=1, src="", url="land"),     # empty referrer counts
        row(D, 1, "a", "u2", 1, 1, src=None, url="land"),          # NULL referrer does not
        row(D - dt.timedelta(2), 1, "a", "u9", 1, 1, src="zzz", url="other"),
    ], TRACK)
    pv = t.select("day", "ip", "source_url", "url", "tid")
    src = Source.empty_or_referrer_and_landing("s", "ref", "land")
    out = {r.date: r for r in source_report(t, pv, src, load_time=0).collect()}
    assert set(out) == {"2024-01-08", "2024-01-06"}
    r = out["2024-01-08"]
    assert (r.uv, r.new_user_cnt, r.ip, r.stay_seconds, r.bounce_rate) == (1, 1, 1, 60, 1.0)
    z = out["2024-01-06"]                       # no visitor of the source: zeros, not NULLs
    assert (z.uv, z.frequent_user_ratio, z.ip, z.bounce_rate, z["7_days_retention_rate"]) == (0, 0.0, 0, 0.0, 0.0)


def test_category_users(spark):
    pv = spark.createDataFrame([
        (D, "12", "v1", "blog.x", "/en/", "click-1"),      # matches two sources
        (D, "13", "v2", "blog.x", "/fr/", "view-1"),       # matches none
        (D, "99", "v3", "", "/en/", "click-1"),            # room without category
        (D, "5", "v4", "", "/en/", "click-1"),             # one-character room id: excluded
    ], "day date, sbt string, uuid string, source_url string, url string, tid string")
    rooms = spark.createDataFrame([(12, "d", 1, "t", 7), (99, "d", 1, "t", 8)],
                                  "room_id long, domain string, user_id long, user_title string, category_id long")
    cats = spark.createDataFrame([(7, "seven", "c7")], "id long, name string, domain string")
    srcs = [Source.referrer_and_landing("blog", r"blog\.", "/en/"), Source.tracking_id("tracked", "^click-")]
    got = sorted(((r.type, r.cid, r.name, r.pv, r.uv) for r in category_users(pv, rooms, cats, srcs, 0).collect()),
                 key=repr)
    assert got == sorted([("blog", 7, "seven", 1, 1), ("tracked", 7, "seven", 1, 1), ("tracked", None, None, 1, 1)],
                         key=repr)


def test_retention_bitmaps_equal_a_plain_count(spark):
    """Days across block borders (32 days), before 1970 too, lags up to 32, NULL users and groups."""
    import random

    from livemetrics.operators.audience import retention_rates
    rnd, rows = random.Random(2), {}
    for _ in range(900):
        d = rnd.choice([D, dt.date(1970, 1, 1)]) + dt.timedelta(rnd.randrange(-50, 50))
        rows[d, rnd.choice(["a", "a", "b", None]), rnd.choice([f"u{i}" for i in range(12)] + [None])] = rnd.randrange(2)
    u = spark.createDataFrame([(*k, v) for k, v in rows.items()], "day date, site string, uuid string, _new int")
    lags = {"r1": 1, "r7": 7, "r32": 32}
    got = {(r.day, r.site): (r.r1, r.r7, r.r32) for r in retention_rates(u, ["day", "site"], lags).collect()}
    want = {}
    for i, n in enumerate(lags.values()):
        for d, site in {(d, s) for (d, s, _), new in rows.items() if new}:
            cohort = [x for (dd, s, x), new in rows.items() if (dd, s, new) == (d, site, 1) and x is not None]
            back = [x for x in cohort if site is not None and (d + dt.timedelta(n), site, x) in rows]
            rate = int(10_000 * len(back) / len(cohort) + 0.5) / 10_000 if cohort else None
            want.setdefault((d + dt.timedelta(n), site), [None] * 3)[i] = rate
    assert got == {k: tuple(v) for k, v in want.items()} and len(got) > 100


def test_retention_reads_the_users_once_and_joins_nothing(spark):
    from livemetrics.operators.audience import retention_rates
    u = spark.createDataFrame([(D, "a", "u", 1)], "day date, site string, uuid string, _new int")
    plan = retention_rates(u, ["day", "site"], {"r1": 1, "r7": 7})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.split("Initial Plan")[0].count("Scan ExistingRDD") == 1
