"""The corpus pipeline: documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the docs of the next. All but the last return the
columns of documents, extra ones included. Rows with a null doc_id are told
apart by their text; of repeated rows one stays in the near-duplicate stage;
null and empty texts are clean, are linked with nothing, and are packed as
their end token; empty tables pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.decontaminate import contaminated
from ballotlens.llm.minhash import near_duplicates
from ballotlens.llm.packing import pack
from ballotlens.llm.pii import without_personal_data
from ballotlens.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, and of repeated rows, one document stays."""
    keyed, key = C.with_key(docs)
    found = C.stored(near_duplicates(keyed, id_col=key).groupBy("doc_id").agg(
        F.bool_and("kept").alias("kept"), F.count("*").alias("rows")), "pipeline-near-duplicates")
    single = C.without_ids(keyed, key, found.filter("not kept or rows > 1").select("doc_id"))
    again = found.filter("kept and rows > 1").select(F.col("doc_id").alias(C.unused_name(keyed, "again_id")))
    place = C.unused_name(keyed, "place")
    first = Window.partitionBy(key).orderBy(F.col("text").asc_nulls_last())
    # stored first, else the exact join would shuffle every text
    maybe = C.stored(C.likely_among(keyed, key, again), "pipeline-repeated")
    one = (maybe.join(again, F.col(key) == F.col(again.columns[0]), "left_semi")
           .withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1))
    return single.select(*docs.columns).union(one.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    keyed, key = C.with_key(docs)
    found = C.stored(contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=key)
                     .select("doc_id").distinct(), "pipeline-contaminated")
    return C.without_ids(keyed, key, found).select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind in brackets."""
    return without_personal_data(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_documents),
]

# the toxicity stage trains a network: no SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
