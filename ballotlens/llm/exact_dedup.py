"""Exact duplicates by skew-safe combining.

Texts that no other row's hash repeats are single and never move. The others are
combined in three steps, each of which compares whole texts (they are grouping
keys beside their digest): within a partition (Spark aggregates before it
shuffles), within the salted group of a digest, and over the winners of all salts.
So a text that a third of all rows repeat is one row per partition after the first
step, and one per salt after the second.

Defined cases: a NULL text counts as empty. A NULL doc_id ranks below every other
and keep_id is NULL where a group has no id. Of rows that repeat a doc_id and its
text, one is kept. Texts of one digest that differ are different groups. Empty
tables give no rows. Other columns are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.skew import join_groups

SALTS = 64          # groups of partitions whose winners are merged first

Expression = Callable[[Column], Column]


def as_is(text: Column) -> Column:
    return text


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def normalised(docs: DataFrame, id_col: str, text_col: str, normalise: Expression) -> DataFrame:
    """(doc_id long, text string): the text that is compared, never NULL."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       normalise(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"))


def split_by_repetition(rows: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``rows`` whose text is the only one of its hash, and the rest (with a few
    single ones). Only hashes are shuffled; a bitmap of bounded size is broadcast.
    At sizes that fill it, more single texts are in the rest."""
    of_text, word, bits = (C.unused_name(rows, n) for n in ("text_hash", "map_word", "map_bits"))
    hashed = rows.withColumn(of_text, F.xxhash64(text_col))
    again = hashed.groupBy(of_text).agg(F.count(F.lit(1)).alias("rows_")).filter("rows_ > 1")
    bitmap = C.stored(C.id_bitmap(again, of_text), "repeated-hashes").toDF(word, bits)
    marked = hashed.join(F.broadcast(bitmap), C._map_word(of_text) == F.col(word), "left")
    repeated = F.coalesce(F.col(bits).bitwiseAND(C._map_bit(of_text)) != 0, F.lit(False))
    return marked.filter(~repeated).select(*rows.columns), marked.filter(repeated).select(*rows.columns)


def combined(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, text, keep_id, group_size) of rows (doc_id, text, digest, salt)."""
    merged = rows.groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "text").agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Expression = as_is,
                     digest: Expression = sha256, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (the largest doc_id of its
    group), group_size, kept, and text_sha256 of the normalised text. ``digest``
    only spreads the work: whole texts decide which rows are equal."""
    single, repeated = split_by_repetition(normalised(docs, id_col, text_col, normalise))
    alone = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                          F.lit(True).alias("kept"), sha256(F.col("text")).alias("text_sha256"))
    # every row of a partition has one salt, so a text leaves a partition as one row
    rows = C.stored(repeated.select("doc_id", "text", digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("sha"),
                                    F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")), "repeated-texts")
    groups = C.stored(combined(rows, salts), "text-groups")
    # digests that several texts share: their members are told apart by text, the others' by digest
    shared = C.stored(groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest"),
                      "shared-digests")
    whole = groups.select("digest", "keep_id", "group_size").join(shared, "digest", "left_anti")
    # repeated rows of one doc_id are one row with a count until their group is known
    members = C.stored(rows.groupBy("doc_id", "digest", "sha").agg(F.count(F.lit(1)).alias("copies")), "text-members")
    found = join_groups(members, C.stored(whole, "single-text-digests"), ["digest"], "group_size", rows.count())
    clashing = (C.likely_among(rows.select("doc_id", "text", "digest", "sha"), "digest", shared)
                .groupBy("doc_id", "digest", "text", "sha").agg(F.count(F.lit(1)).alias("copies"))
                .join(groups.join(shared, "digest", "left_semi"), ["digest", "text"]))
    columns = ["doc_id", "sha", "copies", "keep_id", "group_size"]
    listed = (found.select(*columns).unionByName(clashing.select(*columns))
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return alone.unionByName(listed.select("doc_id", "keep_id", F.col("group_size"), kept.alias("kept"),
                                           F.col("sha").alias("text_sha256")))


def without_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Expression = as_is,
                         salts: int = SALTS) -> DataFrame:
    """``docs`` with one whole row per text, the one of the largest id. Of rows
    that tie on it, one stays (the greatest by their other columns, compared as
    JSON text)."""
    body, row, salt = (C.unused_name(docs, n) for n in ("compared", "row", "salt"))
    texts = docs.withColumn(body, normalise(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    single, repeated = split_by_repetition(texts, body)
    packed = repeated.select(F.struct(*docs.columns).alias(row), body, F.xxhash64(body).alias("digest"),
                             F.pmod(F.spark_partition_id(), F.lit(salts)).alias(salt))
    rank = lambda r: F.struct(F.col(f"{r}.`{id_col}`").cast("long"), F.to_json(F.col(r)))
    merged = packed.groupBy("digest", salt, body).agg(F.max_by(row, rank(row)).alias("best"))
    winners = merged.groupBy("digest", body).agg(F.max_by("best", rank("best")).alias("best"))
    return single.select(*docs.columns).union(winners.select("best.*"))
