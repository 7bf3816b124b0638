"""Merge adjacent broadcast segments.

Within a key (day, room), segments ordered by start merge when the label is equal (NULL
equals NULL) and ``abs(start - previous end) <= max_gap_s``; the previous *row's* end is
used, so a segment overlapping the previous one by more than the gap does not merge and
the merged end is the last row's end even if it is earlier.

Plan (one scan, two exchanges, no join; no single task sees a whole room):
1. rows are split by (key, time bucket of start); within a bucket a window computes the
   break flags from ``lag``, a running sum numbers the local segments and an aggregation on
   the same partitioning merges each of them;
2. only a bucket's first and last local segment can go on across a bucket border: these two
   are windowed per key, the others stay dealt by bucket (one window whose partition is the
   key for border segments and (key, bucket) for inner ones).  A running sum numbers the
   chains, and an aggregation on that partitioning merges them.
A room with a third of all rows is therefore spread over its buckets; at most two rows per
bucket are processed per room.

The compat mode needs the original row order around every key's first run; it keeps rows
and joins per-bucket summaries back to them (``_merge_compat``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _gap(a: Column, b: Column, day_wrap: bool) -> Column:
    d = F.abs(F.unix_seconds(a) - F.unix_seconds(b))
    return F.pmod(d, F.lit(86400)) if day_wrap else d


def _anchors(summ: DataFrame, n: str, cont: str, prefix: str, before) -> DataFrame:
    """For each bucket summary: where the segment continued into the bucket began.

    A bucket holds a segment start unless it has a single local segment that continues the
    previous bucket; the anchor of a continuing bucket is the last start in an earlier
    bucket (``last(.., ignorenulls)``)."""
    has_start = (F.col(n) > 1) | ~F.col(cont)
    return (summ.withColumn(f"{prefix}_sb", F.when(has_start, F.col("_b")))
                .withColumn(f"{prefix}_ss", F.when(has_start, F.col(n)))
                .withColumn(f"{prefix}_b", F.last(f"{prefix}_sb", ignorenulls=True).over(before))
                .withColumn(f"{prefix}_s", F.last(f"{prefix}_ss", ignorenulls=True).over(before))
                .drop(f"{prefix}_sb", f"{prefix}_ss"))


def _on(left: DataFrame, right: DataFrame, pairs, nullable: dict):
    """Join condition: plain equality on non-nullable columns (keeps the partitioning),
    null-safe equality otherwise."""
    return [(left[a].eqNullSafe(right[b]) if nullable.get(a, True) else left[a] == right[b]) for a, b in pairs]


def merge_adjacent(df: DataFrame, key: Sequence[str], label: str, start: str, end: str,
                   max_gap_s: int = 300, sums: Sequence[str] = (), maxs: Sequence[str] = (),
                   mins: Sequence[str] = (), firsts: Sequence[str] = (), order_extra: Sequence[str] = (),
                   bucket_s: int = 3600, day_wrap: bool = False, compat: bool = False) -> DataFrame:
    """Merge segments; output: key, start, end, label, firsts, sums, maxs, mins.

    ``start``/``end`` are TIMESTAMP columns.  ``order_extra`` breaks ties after
    (start, end, label).  ``day_wrap=True`` measures the gap modulo one day.

    ``compat=True`` reproduces the original script's behaviour (implies ``day_wrap``):
    after a gap break the attributes (``firsts``) stay those of the first row of the
    title run; and, taking the keys in order of the last key column within the others
    (rooms within a day), a key whose first title equals the previous key's last title
    emits the rows of its leading run of that title unmerged, one row each.
    """
    key = list(key)
    order = [F.col(start), F.col(end), F.col(label).asc_nulls_first(),
             *[F.col(c).asc_nulls_first() for c in order_extra]]
    if compat:
        return _merge_compat(df, key, label, start, end, max_gap_s, sums, maxs, mins, firsts, order, bucket_s)

    def merged(pos):
        aggs = [F.min_by(F.col(start), pos).alias(start), F.max_by(F.col(end), pos).alias(end),
                F.min_by(F.col(label), pos).alias(label)]
        if firsts:
            aggs.append(F.min_by("_f", pos).alias("_f"))
        return aggs + [f(c).alias(c) for f, cs in ((F.sum, sums), (F.max, maxs), (F.min, mins)) for c in cs]

    in_bucket = Window.partitionBy(*key, "_b").orderBy(*order)
    rows = df.select(*key, start, end, label, *[c for c in dict.fromkeys([*sums, *maxs, *mins])],
                     *([F.struct(*firsts).alias("_f")] if firsts else []), *[c for c in order_extra if c not in (start, end, label, *key, *sums, *maxs, *mins)],
                     F.floor(F.unix_seconds(F.col(start)) / bucket_s).alias("_b"))
    breaks = (F.row_number().over(in_bucket) == 1) | ~F.lag(label).over(in_bucket).eqNullSafe(F.col(label)) | (
        _gap(F.col(start), F.lag(end).over(in_bucket), day_wrap) > max_gap_s)
    rows = rows.withColumn("_rn", F.row_number().over(in_bucket)).withColumn("_new", breaks.cast("int"))
    rows = rows.withColumn("_ls", F.sum("_new").over(in_bucket.rowsBetween(Window.unboundedPreceding, 0)))
    local = rows.groupBy(*key, "_b", "_ls").agg(*merged(F.col("_rn")))
    local = local.withColumn("_n", F.max("_ls").over(Window.partitionBy(*key, "_b")))
    border = (F.col("_ls") == 1) | (F.col("_ls") == F.col("_n"))
    local = local.withColumn("_inner", F.when(~border, F.col("_b")))
    across = Window.partitionBy(*key, "_inner").orderBy("_b", "_ls")
    goes_on = (F.col("_inner").isNull() & (F.col("_ls") == 1) & (F.lag("_b").over(across).isNotNull())
               & F.lag(label).over(across).eqNullSafe(F.col(label))
               & (_gap(F.col(start), F.lag(end).over(across), day_wrap) <= max_gap_s))
    local = local.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    local = local.withColumn("_chain", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    out = local.groupBy(*key, "_inner", "_chain").agg(*merged(F.struct("_b", "_ls")))
    return out.select(*key, start, end, label, *[F.col(f"_f.{c}").alias(c) for c in firsts], *sums, *maxs, *mins)


def _merge_compat(df, key, label, start, end, max_gap_s, sums, maxs, mins, firsts, order, bucket_s) -> DataFrame:
    day_wrap = True
    outer, last_key = key[:-1], key[-1]
    nullable = {f.name: f.nullable for f in df.schema.fields}
    w1 = Window.partitionBy(*key, "_b").orderBy(*order)
    running = w1.rowsBetween(Window.unboundedPreceding, 0)
    rows = (df.withColumn("_b", F.floor(F.unix_seconds(F.col(start)) / bucket_s))
              .withColumn("_rn", F.row_number().over(w1)))
    is_first = F.col("_rn") == 1
    new_label = ~F.lag(label).over(w1).eqNullSafe(F.col(label))
    far = _gap(F.col(start), F.lag(end).over(w1), day_wrap) > max_gap_s
    rows = rows.withColumn("_ls", F.sum((is_first | new_label | far).cast("int")).over(running))
    rows = rows.withColumn("_lr", F.sum((is_first | new_label).cast("int")).over(running))

    sagg = [F.max("_ls").alias("_n"),
            F.min_by(F.struct(F.col(label).alias("l"), F.col(start).alias("s")), "_rn").alias("_first"),
            F.max_by(F.struct(F.col(label).alias("l"), F.col(end).alias("e")), "_rn").alias("_last"),
            F.max("_lr").alias("_nr")]
    summ = rows.groupBy(*key, "_b").agg(*sagg)
    w2 = Window.partitionBy(*key).orderBy("_b")
    before = w2.rowsBetween(Window.unboundedPreceding, -1)
    prev = F.lag("_last").over(w2)
    same_label = prev.isNotNull() & prev["l"].eqNullSafe(F.col("_first.l"))
    near = _gap(F.col("_first.s"), prev["e"], day_wrap) <= max_gap_s
    summ = _anchors(summ.withColumn("_cont", F.coalesce(same_label & near, F.lit(False))),
                    "_n", "_cont", "_anc", before)
    summ = _anchors(summ.withColumn("_rcont", F.coalesce(same_label, F.lit(False))),
                    "_nr", "_rcont", "_ranc", before)
    # Which keys start with the previous key's last title: one row per key, ordered by
    # the last key column within the outer keys.
    per_key = summ.groupBy(*key).agg(F.min("_b").alias("_b0"),
                                      F.min_by(F.col("_first.l"), F.col("_b")).alias("_fl"),
                                      F.max_by(F.col("_last.l"), F.col("_b")).alias("_ll"))
    w3 = Window.partitionBy(*outer).orderBy(last_key)
    carried = F.lag(F.lit(1)).over(w3).isNotNull() & F.lag("_ll").over(w3).eqNullSafe(F.col("_fl"))
    per_key = per_key.select(*[F.col(k).alias(f"_pk_{k}") for k in key], "_b0", carried.alias("_carried"))
    summ = summ.join(per_key, _on(summ, per_key, [(k, f"_pk_{k}") for k in key], nullable)) \
               .drop(*[f"_pk_{k}" for k in key])
    extra = ["_rcont", "_ranc_b", "_ranc_s", "_b0", "_carried"]
    summ = summ.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_b").alias("_kb"),
                       "_cont", "_anc_b", "_anc_s", *extra)

    # Joined on the (key, bucket) partitioning the first window already produced.
    cond = _on(rows, summ, [(k, f"_k_{k}") for k in key], nullable) + [rows["_b"] == summ["_kb"]]
    j = rows.join(summ, cond, "left")
    cont_first = (F.col("_ls") == 1) & F.col("_cont")
    gb = F.when(cont_first, F.col("_anc_b")).otherwise(F.col("_b"))
    gs = F.when(cont_first, F.col("_anc_s")).otherwise(F.col("_ls"))
    run_first = (F.col("_lr") == 1) & F.col("_rcont")
    j = (j.withColumn("_rb", F.when(run_first, F.col("_ranc_b")).otherwise(F.col("_b")))
          .withColumn("_rs", F.when(run_first, F.col("_ranc_s")).otherwise(F.col("_lr")))
          .withColumn("_car", F.col("_carried") & (F.col("_rb") == F.col("_b0")) & (F.col("_rs") == 1)))
    gb = F.when(F.col("_car"), F.col("_b")).otherwise(gb)
    gs = F.when(F.col("_car"), -F.col("_rn")).otherwise(gs)      # carried rows stay single
    j = j.withColumn("_gb", gb).withColumn("_gs", gs).withColumn("_pos", F.struct("_b", "_rn"))

    aggs = [F.min_by(F.col(start), "_pos").alias(start),
            F.max_by(F.col(end), "_pos").alias(end),
            F.min_by(F.col(label), "_pos").alias(label)]
    if firsts:
        aggs.append(F.min_by(F.struct(*firsts), "_pos").alias("_f"))
    aggs += [F.min(F.struct("_rb", "_rs")).alias("_run"), F.max("_car").alias("_car")]
    aggs += [F.sum(c).alias(c) for c in sums]
    aggs += [F.max(c).alias(c) for c in maxs]
    aggs += [F.min(c).alias(c) for c in mins]
    out = j.groupBy(*key, "_gb", "_gs").agg(*aggs)
    first_cols = [F.col(f"_f.{c}").alias(c) for c in firsts]
    if firsts:
        # Attributes of the run's first row, except for rows emitted on their own.
        runf = (j.groupBy(*key, "_rb", "_rs").agg(F.min_by(F.struct(*firsts), "_pos").alias("_rf"))
                 .select(*[F.col(k).alias(f"_q_{k}") for k in key], "_rb", "_rs", "_rf"))
        rcond = _on(out, runf, [(k, f"_q_{k}") for k in key], nullable) + \
            [out["_run._rb"] == runf["_rb"], out["_run._rs"] == runf["_rs"]]
        out = out.join(runf, rcond, "left")
        first_cols = [F.when(F.col("_car"), F.col(f"_f.{c}")).otherwise(F.col(f"_rf.{c}")).alias(c)
                      for c in firsts]
    cols = [*[out[k] for k in key], start, end, label, *first_cols, *sums, *maxs, *mins]
    return out.select(*cols)
