"""Running values along a total order without a task per group.

A window ordered over a whole group sends that group to one task.  Here the rows are dealt to
range partitions of the order first (``ordered_parts``, stored, so a part number stays what it
is when executors are lost), running values are computed inside each (part, group), and one
total per (part, group) is carried on: a group of any size costs one extra row per part.

``group`` columns must not hold nulls (callers encode them); rows that tie on every order
column must be interchangeable; the kind ``last`` takes ascending order columns.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livemetrics.staging import stage

PART = "_part"

#: kind -> (aggregate, how the value carried from earlier parts meets a local one)
KINDS: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda carry, x: F.coalesce(carry + x, carry, x)),
    "count": (F.count, lambda carry, x: F.coalesce(carry, F.lit(0)) + x),
    "bit_xor": (F.bit_xor, lambda carry, x: F.coalesce(carry.bitwiseXOR(x), carry, x)),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda carry, x: F.coalesce(x, carry)),
}


def ordered_parts(df: DataFrame, keys: Sequence, name: str = "ordered", partitions: int | None = None) -> DataFrame:
    """``df`` stored in range partitions of ``keys``, with the partition's number as ``_part``:
    whatever sorts earlier by ``keys`` has the same or a smaller number."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return stage(df.repartitionByRange(n, *keys).withColumn(PART, F.spark_partition_id()), name)


def running(parts: DataFrame, group: Sequence[str], order: Sequence, values: dict[str, tuple[str, Column]],
            totals: dict[str, tuple[str, Column]] | None = None, part: str = PART,
            inclusive: bool = True) -> DataFrame:
    """Append running values over ``group`` in ``order`` (the row itself included, unless
    ``inclusive`` is false), and values of the whole group (``totals``); both as name -> (kind, column).

    ``part`` may be any column that never decreases along the order inside a group and whose
    values hold a bounded number of rows, e.g. ``position div 65536``.
    """
    totals = totals or {}
    keys = [part, *group]
    asked = {f"_t{i}": v for i, v in enumerate([*values.values(), *totals.values()])}

    def total(kind: str, c: Column) -> Column:
        if kind == "last":                   # an aggregate sees no order: the latest row that has a value
            return F.max_by(c, F.when(c.isNotNull(), F.struct(*order)))
        return KINDS[kind][0](c)

    per_part = parts.groupBy(*keys).agg(*[total(kind, c).alias(n) for n, (kind, c) in asked.items()])
    whole = Window.partitionBy(*group)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)

    def again(kind: str) -> Callable[[Column], Column]:
        return F.sum if kind == "count" else KINDS[kind][0]      # totals of totals

    carried = per_part.select(
        *keys,
        *[again(kind)(F.col(f"_t{i}")).over(before).alias(f"_c{i}") for i, (kind, _) in enumerate(values.values())],
        *[again(kind)(F.col(f"_t{i + len(values)}")).over(whole).alias(n)
          for i, (n, (kind, _)) in enumerate(totals.items())])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = parts.select("*", *[KINDS[kind][0](c).over(inside).alias(f"_l{i}")
                                for i, (kind, c) in enumerate(values.values())])
    out = local.join(carried, keys)
    return out.select(
        *[F.col(c) for c in parts.columns],
        *[KINDS[kind][1](F.col(f"_c{i}"), F.col(f"_l{i}")).alias(n) for i, (n, (kind, _)) in enumerate(values.items())],
        *totals)
