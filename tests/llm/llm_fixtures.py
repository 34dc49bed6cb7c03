"""Small tables for the operators' edge cases."""

import random

from pyspark.sql import types as T

DOC_FIELDS = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()),
              ("n_chars", T.LongType())]
# names that the operators use inside
CLASHING = ["digest", "bands", "bucket", "component", "score", "rank", "length", "map_word", "map_bits", "row_key", "window",
            "w", "words", "item", "sequence_id", "core", "start", "base", "kept", "again_id", "place", "gone_id"]


def frame(spark, rows, clashing=True):
    """(doc_id, text) rows as a documents table, with extra columns."""
    extra = CLASHING if clashing else []
    schema = T.StructType([T.StructField(n, k) for n, k in DOC_FIELDS] + [T.StructField(n, T.StringType()) for n in extra])
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) + ("x",) * len(extra) for i, t in rows],
                                 schema)


def prose(rng: random.Random, n: int) -> str:
    syllables = "ba de ki lo mu na pe ri so tu va we xi yo zu".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(n))


def words(text):
    return (text or "").encode().lower().split()
