"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livemetrics.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` whose Python workers can import this package also when only the driver
    has it on its path (local sessions; clusters ship it with ``--py-files``)."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def ship(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (path, ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: dict[str, list[str]] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and lets several branches read it without recomputing.
    ``drop_written`` removes it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, UPPER, UPPER.lower())


def n_words(c: Column) -> Column:
    """White-space words of a text (null: 0), JVM-side."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


ID_BITS = 24


def id_bitmap(ids: DataFrame, col: str, bits: int = ID_BITS):
    """A broadcast bitmap over hashed ids, 2**bits bits (2 MB) whatever the number of ids: a
    bounded pre-filter.  A clear bit proves an id absent; set bits must be checked by a join."""
    h = F.pmod(F.xxhash64(F.col(col)), F.lit(1 << bits))
    words = (ids.select(h.alias("h")).groupBy(F.shiftright("h", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS int))")).alias("m")))
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for r in words.toLocalIterator():        # at most 2**(bits-6) rows
        out[r["w"]] = r["m"]
    return ids.sparkSession.sparkContext.broadcast(out.view(np.uint64))


def with_bitmap_bit(df: DataFrame, col: str, bits: int = ID_BITS, name: str = "_bit") -> DataFrame:
    """Append the bit position of each row's id, for ``in_bitmap``, under a name of its own."""
    while name in df.columns:
        name += "_"
    return df.select("*", F.pmod(F.xxhash64(df[col]), F.lit(1 << bits)).alias(name))


def in_bitmap(bitmap, position):
    """Mask of the rows (an Arrow column of bit positions) whose bit is set."""
    p = position.to_numpy(zero_copy_only=False).astype(np.int64)
    return (bitmap[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1


def split_by_bitmap(df: DataFrame, col: str, bitmap, present: bool, bits: int = ID_BITS) -> DataFrame:
    """The rows whose id may be (``present``) or is surely not in the bitmap's ids."""
    marked = with_bitmap_bit(df, col, bits)
    n = len(df.columns)

    def run(batches):
        for b in batches:
            mask = in_bitmap(bitmap.value, b.column(n))
            b = b.filter(pa.array(mask if present else ~mask))
            yield pa.RecordBatch.from_arrays(b.columns[:n], schema=pa.schema(list(b.schema)[:n]))

    return map_arrow(marked, run, df.schema)


def drop_ids(df: DataFrame, col: str, ids: DataFrame, id_name: str) -> DataFrame:
    """``df`` without the rows whose id is in ``ids``.  Rows surely not in it stay where they
    are; only rows that may be in it are shuffled to an exact anti join."""
    bitmap = id_bitmap(ids, id_name)
    maybe = split_by_bitmap(df, col, bitmap, True)
    gone = ids.select(F.col(id_name).alias("_gone")).distinct()
    kept = maybe.join(gone, maybe[col] == gone["_gone"], "left_anti")
    return split_by_bitmap(df, col, bitmap, False).unionByName(kept)


def whole_keys(batches):
    """Batches sorted by their first column, regrouped into tables that hold every row of each
    of their keys; only the rows of one key are held back."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(key, key[-1], "left"))
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        elif held and held[-1].column(0)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = [b]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def drop_written(spark: SparkSession) -> None:
    """Remove what ``written`` has stored for this application, through its own file system.  Call
    it when the results that read it have been saved."""
    jvm = spark._jvm
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
