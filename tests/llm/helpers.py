"""Small document tables with the edge rows every operator must survive."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use inside: clashing input columns must not matter.
CLASH = {"_id": "x", "_row": "y", "id": "z", "key": "k", "n": "1", "part": "p", "_bit": "b", "label": "l", "w": "q"}


def words(t):
    return WORD.findall(t or "")


def prose(seed, n):
    """n words that repeat by chance only."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("".join(chr(97 + (x >> (8 * i + 10)) % 26) for i in range(3 + x % 5)))
    return " ".join(out)


def docs_frame(spark, rows, clash=True):
    """rows: (doc_id, text[, lang, source])."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] else None)
            for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    for name, v in (CLASH if clash else {}).items():
        df = df.withColumn(name, F.lit(v))
    return df


def edge_rows():
    long = prose(99, 30_000)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (None, "a null id with words"),
            (6, long), (7, prose(7, 120)), (8, prose(7, 120)), (8, prose(7, 120)), (9, "é" * 300),
            (10, "x\n\n\nx\n"), (11, None, None, None), (12, "!!! ??? 123")]
