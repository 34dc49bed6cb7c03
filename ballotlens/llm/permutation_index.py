"""Approximate nearest neighbours by a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots in order. Within
blocks of about ``BLOCK`` vectors the entries are posted in pivot inverted
files (pivot -> vectors that rank it, with the rank). A query walks the lists of
its own pivots; each shared pivot brings two vectors closer in Spearman's
footrule over all pivots, where a pivot outside the prefix counts as rank
``PREFIX``: the footrule is a constant less 2 * sum of min(PREFIX - rank) over
shared pivots. The ``CANDIDATES`` of a block with the smallest footrule (ties:
smaller id) are reranked by the exact inner product in double precision, and
the best of all blocks are returned. Work per query and block is fixed, so the
share of vectors reranked does not fall as the table grows.

Pivots are a documented sample: the ``PIVOTS`` different vectors with the
smallest hashes. Of equal vectors a block keeps as many rows (smallest ids) as
an answer can hold, so that copies do not use up the candidates. For largest inner product, vectors get one more component
sqrt(M**2 - |x|**2), M the largest norm, which turns it into nearest distance.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows with a null id or with another length than
the longest usable vector; rows that repeat an id are separate candidates, ask
once (with the smallest vector), and a query never finds a row of its own id; fewer candidates than asked for are all
returned; an empty table or one without queries gives no rows; other columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ballotlens.llm import common as C

PIVOTS, PREFIX = 256, 64
BLOCK = 4096            # vectors in an index block, about
CANDIDATES = 640        # vectors of a block that are reranked for a query
QUERY_BLOCK = 2048      # queries that visit a block in one task, about
TOP = 20


def usable(vector: Column) -> Column:
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, ok)
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _prefixes(pivots: np.ndarray, longest: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nearest pivots of each vector in order, as a base vector and as a query."""
        for batch in batches:
            x = _matrix(batch.column("vector"))
            depth = min(PREFIX, len(pivots))
            if len(x):
                extra = np.sqrt(np.maximum(0, longest ** 2 - (x * x).sum(axis=1)))
                near = x @ pivots[:, :-1].T
                rank = lambda s: np.argsort(-s, axis=1, kind="stable")[:, :depth].astype(np.int16)
                base, query = rank(near + np.outer(extra, pivots[:, -1])), rank(near)
            else:
                base = query = np.zeros((0, depth), np.int16)
            rows = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("is_query"), rows(x), rows(base), rows(query)],
                names=["vec_id", "is_query", "vector", "base", "query"])
    return run


def enough_copies(ids: np.ndarray, x: np.ndarray, top: int) -> np.ndarray:
    """Rows without those equal vectors that no answer can hold: ``top`` of
    another id than the query's remain. Rows must be sorted by id."""
    same = np.unique(x, axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    place = np.arange(len(order)) - np.searchsorted(same[order], same[order])
    return np.sort(order[place < top + np.unique(ids, return_counts=True)[1].max()])


def search_block(ids: np.ndarray, x: np.ndarray, base: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
                 query: np.ndarray, pivots: int, top: int, candidates: int):
    """For each query the best rows of one block: (query number, row, score).
    Rows must be sorted by id."""
    depth = base.shape[1]
    order = np.argsort(base.ravel(), kind="stable")             # the inverted files, one after the other
    row = (order // depth).astype(np.int64)
    gain = (depth - order % depth).astype(np.int32)
    begin = np.searchsorted(base.ravel()[order], np.arange(pivots + 1))
    for i in range(len(query_ids)):
        near = np.zeros(len(ids), np.int32)
        for place, p in enumerate(query[i].tolist()):
            a, b = begin[p], begin[p + 1]
            near[row[a:b]] += np.minimum(gain[a:b], depth - place)
        rank = (-near).astype(np.int64) * len(ids) + np.arange(len(ids))      # footrule, then id
        rank[ids == query_ids[i]] = np.iinfo(np.int64).max
        some = np.argpartition(rank, candidates)[:candidates] if len(rank) > candidates else np.arange(len(rank))
        some = np.sort(some[ids[some] != query_ids[i]])
        score = (x[some] * q[i]).sum(axis=1)                    # same order of addition for every row
        best = np.argsort(-score, kind="stable")[:top]
        yield i, some[best], score[best]


def _search(pivots: int, top: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def visit(rows: list[dict]) -> pa.RecordBatch:
        decode = lambda name, kind, some: np.array([np.frombuffer(r[name], kind) for r in some])
        base, query = [r for r in rows if not r["asks"]], [r for r in rows if r["asks"]]
        out: list[list] = [[], [], []]
        if base and query:
            base.sort(key=lambda r: r["vec_id"])
            ids = np.array([r["vec_id"] for r in base], np.int64)
            asked = np.array([r["vec_id"] for r in query], np.int64)
            x, prefix = decode("vector", np.float64, base), decode("prefix", np.int16, base)
            some = enough_copies(ids, x, top)
            ids = ids[some]
            for i, found, score in search_block(ids, x[some], prefix[some],
                                                asked, decode("vector", np.float64, query),
                                                decode("prefix", np.int16, query), pivots, top, CANDIDATES):
                out[0] += [int(asked[i])] * len(found)
                out[1] += ids[found].tolist()
                out[2] += score.tolist()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by cell (index block, query block)."""
        key, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["block"], r["part"]) != key:
                    if held:
                        yield visit(held)
                    key, held = (r["block"], r["part"]), []
                held.append(r)
        if held:
            yield visit(held)
    return run


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest vectors found for
    each row where ``queries`` holds, by inner product."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vector_col).cast("array<double>").alias("vector"),
                         F.coalesce(queries, F.lit(False)).alias("is_query")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector")))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    width = own.agg(F.max(F.size("vector"))).first()[0]
    result = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return vectors.sparkSession.createDataFrame([], result)
    own = own.filter(F.size("vector") == width)
    longest, total, asked = own.agg(F.max(norm), F.count("*"), F.count_if("is_query")).first()
    sample = own.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(PIVOTS).collect()
    pivots = np.array([r.vector for r in sample])
    pivots = np.column_stack([pivots, np.sqrt(np.maximum(0, longest ** 2 - (pivots * pivots).sum(axis=1)))])
    index = C.stored(own.mapInArrow(_prefixes(pivots, longest),
                                    "vec_id long, is_query boolean, vector binary, base binary, query binary"),
                     "permutation-index")
    blocks, parts = -(-total // BLOCK), max(1, -(-asked // QUERY_BLOCK))
    deal = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    base = index.select(deal(blocks, 1).alias("block"), every(parts).alias("part"), F.lit(False).alias("asks"),
                        "vec_id", "vector", F.col("base").alias("prefix"))
    asking = index.filter("is_query").groupBy("vec_id").agg(F.min(F.struct("vector", "query")).alias("q")).select(
        "vec_id", "q.vector", "q.query")            # an id asks once
    query = asking.select(every(blocks).alias("block"), deal(parts, 2).alias("part"),
                                            F.lit(True).alias("asks"), "vec_id", "vector", F.col("query").alias("prefix"))
    found = (base.union(query).repartition("block", "part").sortWithinPartitions("block", "part")
             .mapInArrow(_search(len(pivots), top), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
