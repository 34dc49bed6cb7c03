"""Token counts from an exact length histogram.

Documents are encoded whole and aggregated to one row per encoded length;
running sums over that histogram answer totals, quantiles and truncated totals
for every context limit. The sums run in two levels (blocks of lengths, then
lengths within a block), so no task holds the whole histogram.

Defined cases: a null or empty text has 0 tokens; repeated rows count each
time; an empty table has an empty histogram; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C

BLOCK = 1024
_ENCODINGS: dict[str, object] = {}


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoding(path: str):
    if path not in _ENCODINGS:
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                             mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for part in C.text_slices(batches, "text"):
            n = np.array([len(encoding.encode_ordinary(t)) if t else 0 for t in part.column("text").to_pylist()], np.int64)
            lengths, counts = np.unique(n, return_counts=True)      # counted before the shuffle
            yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array(counts.astype(np.int64))],
                                             names=["n_tokens", "documents"])
    return run


def length_histogram(docs: DataFrame, text_col: str = "text", ranks: str | None = None) -> DataFrame:
    """(n_tokens, documents): documents by encoded length."""
    return (C.small_batches(docs).select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_lengths(ranks or default_ranks()), "n_tokens long, documents long")
            .groupBy("n_tokens").agg(F.sum("documents").alias("documents")))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per length n that occurs: documents and tokens of that length,
    of at most and of more than n, and ``truncated_tokens``, the total if every
    document is cut to n tokens. Between two lengths a < n < b the truncated
    total is that of a plus (n - a) * documents_over."""
    h = C.stored(histogram.select("n_tokens", "documents", F.floor(F.col("n_tokens") / BLOCK).alias("block"),
                                  (F.col("n_tokens") * F.col("documents")).alias("tokens")), "token-histogram")
    blocks = h.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)      # one row per 1024 lengths
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
                           F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
                           F.sum("d").over(whole).alias("all_documents"), F.sum("t").over(whole).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    return h.join(blocks, "block").select(
        "n_tokens", "documents", "tokens", "all_documents", "all_tokens",
        (F.coalesce(F.sum("documents").over(inside), F.lit(0)) + F.col("d_after")).alias("documents_over"),
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("t_after")).alias("tokens_over")).select(
        "n_tokens", "documents", "tokens",
        (F.col("all_documents") - F.col("documents_over")).alias("documents_within"),
        (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_within"),
        "documents_over", "tokens_over",
        (F.col("all_tokens") - F.col("tokens_over") + F.col("n_tokens") * F.col("documents_over"))
        .alias("truncated_tokens"), "all_documents", "all_tokens")


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that covers each share of the documents."""
    asked = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    return (limits.withColumn("share", asked)
            .filter(F.col("documents_within") >= F.col("share") * F.col("all_documents"))
            .groupBy("share").agg(F.min("n_tokens").alias("n_tokens")))


def truncated_total(limits: DataFrame, limit: int) -> DataFrame:
    """One row: tokens left when every document is cut to ``limit`` tokens."""
    return (limits.select(F.when(F.col("n_tokens") <= limit, F.col("tokens")).otherwise(F.col("documents") * limit).alias("t"))
            .agg(F.coalesce(F.sum("t"), F.lit(0)).alias("truncated_tokens")))
