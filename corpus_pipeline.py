"""Corpus pipeline over ``documents``: a list of stages, each one operator of ``livemetrics.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read
again as the next stage's ``docs``.  Every stage works on all rows its predecessor kept; all
but the last return exactly the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livemetrics.llm.common import table, written
from livemetrics.llm.decontaminate import remove_contaminated
from livemetrics.llm.jaccard_join import keep_first
from livemetrics.llm.language_id import keep_identified
from livemetrics.llm.line_dedup import MIN_WORDS, dedup_lines
from livemetrics.llm.mixing import mixture_probabilities


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents without a letter or too far from every language go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: later copies of repeated runs of lines, from one line of ``MIN_WORDS`` words on,
    are cut from the texts (``n_chars`` follows the text); a document of which nothing with a word is left goes."""
    names = docs.columns
    cut = dedup_lines(docs, min_words=MIN_WORDS)
    changed = F.col("n_removed") > 0
    out = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: five-word shingles, similarity 0.8 or more; the smallest id of a group stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that contain a benchmark item go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents sampled towards the target mixture, with their probability."""
    out = mixture_probabilities(docs).where("sampled")
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns],
                      *[c for c in ("topic", "n_tokens", "probability") if c not in docs.columns])


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: No SQL: a trained classifier cannot be stated in DuckDB SQL; the stages are tested against
#: brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
