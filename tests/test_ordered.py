"""Running values over range parts, against a plain loop."""

import random

from pyspark.sql import functions as F

from livemetrics.operators.ordered import ordered_parts, running


def _frame(spark, n=400, seed=5):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.6 else f"g{rnd.randrange(5)}", i, rnd.randrange(-50, 50),
             rnd.randrange(100) if rnd.random() < 0.3 else None) for i in range(n)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, o long, v long, w long")


def test_running_values_match_a_loop_over_each_group(spark):
    rows, df = _frame(spark)
    parts = ordered_parts(df, ["g", "o"], partitions=7)
    out = running(parts, ["g"], ["o"], {
        "s": ("sum", F.col("v")), "n": ("count", F.lit(1)), "x": ("bit_xor", F.col("v")),
        "top": ("max", F.col("v")), "low": ("min", F.col("v")), "seen": ("last", F.col("w"))},
        totals={"all_n": ("count", F.lit(1)), "all_s": ("sum", F.col("v"))})
    got = {(r["g"], r["o"]): r for r in out.collect()}
    assert len(got) == len(rows)
    state = {}
    for g, o, v, w in sorted(rows):
        st = state.setdefault(g, dict(s=0, n=0, x=0, top=v, low=v, seen=None))
        st.update(s=st["s"] + v, n=st["n"] + 1, x=st["x"] ^ v, top=max(st["top"], v), low=min(st["low"], v),
                  seen=w if w is not None else st["seen"])
        assert {k: got[g, o][k] for k in st} == st
    for (g, _), r in got.items():
        assert (r["all_n"], r["all_s"]) == (state[g]["n"], state[g]["s"])


def test_a_hot_group_is_spread_over_parts_and_no_part_number_goes_back(spark):
    _, df = _frame(spark)
    parts = ordered_parts(df.where("g = 'hot'"), ["o"], partitions=6)
    per = parts.groupBy("_part").agg(F.min("o").alias("a"), F.max("o").alias("b")).orderBy("_part").collect()
    assert len(per) > 3
    assert all(x["b"] < y["a"] for x, y in zip(per, per[1:]))


def test_values_before_the_row(spark):
    rows, df = _frame(spark)
    parts = ordered_parts(df, ["g", "o"], partitions=7)
    out = running(parts, ["g"], ["o"], {"top": ("max", F.col("o")), "n": ("count", F.lit(1)),
                                        "seen": ("last", F.col("w"))}, inclusive=False)
    got = {(r["g"], r["o"]): (r["top"], r["n"], r["seen"]) for r in out.collect()}
    state = {}
    for g, o, _, w in sorted(rows):
        top, n, seen = state.get(g, (None, 0, None))
        assert got[g, o] == (top, n, seen)
        state[g] = (o, n + 1, w if w is not None else seen)


def test_given_parts_no_group_and_an_empty_table(spark):
    df = spark.range(100).withColumn("p", F.expr("id div 9"))
    out = running(df, [], ["id"], {"s": ("sum", F.col("id"))}, part="p")
    assert [r["s"] for r in out.orderBy("id").collect()] == [i * (i + 1) // 2 for i in range(100)]
    assert running(df.where("id < 0"), [], ["id"], {"s": ("sum", F.col("id"))}, part="p").count() == 0
