"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to owner stages by document frequency, rarest
first. A bundle of items carries, for one slice of the documents, sparse
accumulators (item, document, score) from stage to stage; each stage cogroups them
with the postings that it owns of that slice and adds integer contributions. An
accumulator leaves a stage only if it could still be among the slice's ten best:
its score plus the most that later stages can add must reach the tenth score
there. This drops nothing that could be in the result, whatever the bound. The
last stage gives ten rows per item and slice, from which the ten of all are taken.

A slice holds at most SLICE_DOCS documents and a bundle about BUNDLE_ITEMS items, so
no group grows with the data: a term that every document holds is spread over all
slices. Documents are read once; only postings of terms that an item holds are kept
(a bitmap of bounded size goes to the tasks, an exact join on the term follows).

Defined cases: a NULL text has no terms; an item without terms has no rows. Each row
of documents is a document of its own, also where a doc_id repeats. Rows that share
an item_id are one item with the terms of all of them. NULL ids are ids like others;
a NULL doc_id ranks after equal scores. Empty tables give no rows. Other columns are
ignored, whatever their names. Long texts are cut at separators while they are read,
never shortened."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C

TOP = 10
SLICE_DOCS = 2048
BUNDLE_ITEMS = 256
OWNER_SHARES = (0.001, 0.02, 0.15)      # a term's stage: how many of these its share of documents exceeds
BITMAP_WORDS = 1 << 14                  # 64-bit words of the bitmap of query terms

SEPARATORS = C.byte_class(bytes(b for b in range(128) if not chr(b).isalnum()))

_FOUND = pa.schema([("slice", pa.int64()), ("doc_no", pa.int32()), ("n", pa.int64()), ("term", pa.string()), ("hash", pa.int64()),
                    ("tf", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())])
FOUND = ("slice long, doc_no int, n long, term string, hash long, tf long, doc_ids array<long>, n_docs long, n_terms long")


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges of ``data`` as a string column."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], ends - starts)
    column = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[at].tobytes()))
    return column.cast(pa.string())


def text_terms(column: pa.Array, bitmap: np.ndarray | None) -> tuple[np.ndarray, dict]:
    """Number of terms per text, and its distinct terms that ``bitmap`` lets
    through: arrays doc, hash, tf and the strings."""
    raw, offsets = C.text_buffers(column)
    data = C._LOWER[raw]
    n = np.zeros(len(column), np.int64)
    docs, hashes, starts, ends = ([np.zeros(0, t)] for t in (np.int64, np.uint64, np.int64, np.int64))
    for a, b in C._pieces(data, offsets, SEPARATORS):
        s, e = C.word_spans(data[a:b], offsets[(offsets >= a) & (offsets <= b)] - a, SEPARATORS)
        h = C.span_hashes(data[a:b], s, e)
        d = np.searchsorted(offsets, s + a, side="right") - 1
        n += np.bincount(d, minlength=len(n))
        if bitmap is not None:
            hit = (bitmap[(h >> np.uint64(6)) & np.uint64(BITMAP_WORDS - 1)] >> (h & np.uint64(63))) & np.uint64(1)
            keep = hit.astype(bool)
            d, h, s, e = d[keep], h[keep], s[keep], e[keep]
        for part, x in zip((docs, hashes, starts, ends), (d, h, s + a, e + a)):
            part.append(x)
    d, h, s, e = (np.concatenate(x) for x in (docs, hashes, starts, ends))
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])) if len(d) else np.zeros(0, np.int64)
    tf = np.diff(np.concatenate([first, [len(d)]]))
    return n, {"doc": d[first], "hash": h[first].view(np.int64), "tf": tf.astype(np.int64),
               "term": _gather(data, s[order][first], e[order][first])}


def _find(bitmap: np.ndarray | None):
    """Postings of the documents, dealt to slices, and one row per slice with the
    ids of its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_no, ids, n_docs, n_terms = (TaskContext.get().partitionId() << 32), [], 0, 0

        def seed() -> pa.RecordBatch:
            one = {"slice": [slice_no], "doc_ids": [ids], "n_docs": [n_docs], "n_terms": [n_terms]}
            return pa.record_batch([pa.array(one.get(f.name, [None]), f.type) for f in _FOUND], schema=_FOUND)

        for batch in C.text_slices(batches, "text"):
            at = 0
            while at < len(batch):
                part = batch.slice(at, SLICE_DOCS - len(ids))
                n, found = text_terms(part.column("text"), bitmap)
                rows = len(found["doc"])
                blank = lambda t: pa.nulls(rows, t)
                yield pa.record_batch([
                    pa.array(np.full(rows, slice_no)), pa.array((found["doc"] + len(ids)).astype(np.int32)), pa.array(n[found["doc"]]),
                    found["term"], pa.array(found["hash"]), pa.array(found["tf"]), blank(pa.list_(pa.int64())),
                    blank(pa.int64()), blank(pa.int64())], schema=_FOUND)
                ids = ids + part.column("doc_id").to_pylist()
                n_docs, n_terms, at = n_docs + int((n > 0).sum()), n_terms + int(n.sum()), at + len(part)
                if len(ids) == SLICE_DOCS:
                    yield seed()
                    slice_no, ids, n_docs, n_terms = slice_no + 1, [], 0, 0
        if ids:
            yield seed()
    return run


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, hash), distinct."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.text_slices(batches, "text"):
            _, found = text_terms(batch.column("text"), None)
            yield pa.record_batch([batch.column("doc_id").take(pa.array(found["doc"])), found["term"], pa.array(found["hash"])],
                                  names=["item_id", "term", "hash"])
    return C.id_text(items, id_col, text_col).mapInArrow(run, "item_id long, term string, hash long").distinct()


def _bitmap(terms: DataFrame) -> np.ndarray:
    """Bitmap of the term hashes: BITMAP_WORDS words, however many terms."""
    word = F.shiftright("hash", 6).bitwiseAND(F.lit(BITMAP_WORDS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("hash").bitwiseAND(F.lit(63)).cast("int"))
    rows = terms.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros(BITMAP_WORDS, np.uint64)
    for r in rows:
        out[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    return out


def _numbered(rows: DataFrame, column: str, no: str) -> DataFrame:
    """(bundle, column, number): the distinct values of a bundle, numbered from 0."""
    values = F.array_sort(F.collect_set(F.struct(column)))
    return (rows.groupBy("bundle").agg(values.alias("values"))
            .select("bundle", F.posexplode("values").alias(no, "value")).select("bundle", F.col(f"value.{column}").alias(column), no))


def _weights(postings: DataFrame, n_docs: int, n_terms: int, shares: Sequence[float]) -> DataFrame:
    """(term, weight, stage, most): the most a document gets from the term."""
    df = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(_portion(n_docs, n_terms)).alias("portion"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    stage = sum([(F.col("df") > share * n_docs).cast("int") for share in shares], F.lit(0))
    return df.select("term", weight.alias("weight"), stage.alias("stage"), (weight * F.col("portion")).alias("most"))


def _portion(n_docs: int, n_terms: int):
    """A posting's score before the weight of its term."""
    m = F.lit(10).cast("long") + F.expr(f"(90L * n * {n_docs}L) div {n_terms}L")
    return F.call_function("div", F.col("tf") * F.lit(1_000_000_000).cast("long"), F.col("tf") * F.lit(1000).cast("long") + 8 * m)


CARRIER = ("bundle int, slice long, doc_ids array<long>, item_ids array<long>, term_ends array<int>, term_items array<int>, "
           "later array<long>, at_item array<int>, at_doc array<int>, at_score array<long>")
_CARRIER = pa.schema([("bundle", pa.int32()), ("slice", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("item_ids", pa.list_(pa.int64())), ("term_ends", pa.list_(pa.int32())), ("term_items", pa.list_(pa.int32())),
                      ("later", pa.list_(pa.int64())), ("at_item", pa.list_(pa.int32())), ("at_doc", pa.list_(pa.int32())),
                      ("at_score", pa.list_(pa.int64()))])
_HIT = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _stage(stage: int, last: int, top: int):
    """One owner stage: accumulators of a (bundle, slice) and the stage's postings."""
    def run(carriers: pa.Table, postings: pa.Table) -> pa.Table:
        out = _HIT if stage == last else _CARRIER
        if carriers.num_rows == 0:
            return out.empty_table()
        one = {c: carriers.column(c).combine_chunks() for c in carriers.column_names}
        whole = lambda c: np.asarray(one[c].flatten())
        ids, n_docs, n_items = one["doc_ids"].flatten(), len(one["doc_ids"].flatten()), len(one["item_ids"].flatten())
        scores = np.zeros((n_items, n_docs), np.int64)
        scores[whole("at_item"), whole("at_doc")] = whole("at_score")
        ends, term_items = whole("term_ends"), whole("term_items")
        term, doc, part = (np.asarray(postings.column(c).combine_chunks()) for c in ("term_no", "doc_no", "contribution"))
        order = np.argsort(term, kind="stable")
        term, doc, part = term[order], doc[order], part[order]
        cuts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else []
        for a, b in zip(cuts, [*cuts[1:], len(term)]):
            t = term[a]
            # documents of a term are distinct, so nothing is added twice at one place
            scores[np.ix_(term_items[ends[t - 1] if t else 0:ends[t]], doc[a:b])] += part[a:b]
        if stage == last:
            rows = [_best(scores[i], ids, top) for i in range(n_items)]
            item = np.repeat(np.arange(n_items), [len(r) for r in rows])
            at = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
            return pa.table([one["item_ids"].flatten().take(pa.array(item)), ids.take(pa.array(at)),
                             pa.array(scores[item, at])], schema=_HIT)
        floor = np.partition(scores, n_docs - top, axis=1)[:, n_docs - top] if n_docs > top else np.zeros(n_items, np.int64)
        later = whole("later").reshape(last + 1, n_items)[stage]
        item, at = np.nonzero((scores > 0) & (scores + later[:, None] >= floor[:, None]))
        kept = {"at_item": pa.array([item.astype(np.int32)], pa.list_(pa.int32())),
                "at_doc": pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                "at_score": pa.array([scores[item, at]], pa.list_(pa.int64()))}
        return pa.table([kept.get(f.name, one[f.name]).cast(f.type) for f in _CARRIER], schema=_CARRIER)
    return run


def _best(scores: np.ndarray, ids: pa.Array, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores above 0, ties to smaller ids."""
    at = np.flatnonzero(scores > 0)
    if len(at) > top:
        at = at[scores[at] >= np.partition(scores[at], len(at) - top)[len(at) - top]]
    none = np.asarray(ids.is_null())[at]
    key = np.asarray(ids.fill_null(0))[at]
    return at[np.lexsort((key, none, -scores[at]))][:top]


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, shares: Sequence[float] = OWNER_SHARES, doc_id: str = "doc_id",
           doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item.
    ``shares``: document shares between which the owner stages of terms lie."""
    asked = C.stored(_item_terms(items, item_id, item_text), "item-terms")
    n_items = asked.select("item_id").distinct().count()
    n_bundles = max(1, -(-n_items // bundle_items))
    asked = asked.select(F.pmod(F.xxhash64("item_id"), F.lit(n_bundles)).cast("int").alias("bundle"), "item_id", "term", "hash")
    vocabulary = C.stored(asked.select("term").distinct(), "query-terms")

    # one scan of the documents; whether the join is broadcast follows from the stored size of the vocabulary
    found = C.id_text(docs, doc_id, doc_text).mapInArrow(_find(_bitmap(asked)), FOUND).drop("hash")
    known = vocabulary.withColumn("known", F.lit(True))
    found = C.stored(found.join(known, "term", "left").filter("known or term is null").drop("known"), "postings")
    postings = found.filter("term is not null").select("slice", "doc_no", "n", "term", "tf")
    slices = found.filter("term is null").select(F.col("slice").alias("slice"), "doc_ids")       # told apart from postings' column
    sums = found.filter("term is null").agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
    n_docs, n_terms = sums.d or 0, max(1, sums.t or 0)
    weights = C.stored(_weights(postings, n_docs, n_terms, shares), "term-weights")

    # what a bundle knows of its items: numbers of items and terms, which items a term is of, what later stages add at most
    last = len(shares)
    held = C.stored(asked.join(weights, "term"), "weighted-terms")
    item_no, term_no = _numbered(asked, "item_id", "item_no"), _numbered(held, "term", "term_no")
    same = F.col("i.item_id").eqNullSafe(F.col("h.item_id")) & (F.col("i.bundle") == F.col("h.bundle"))
    placed = (held.alias("h").join(item_no.alias("i"), same).select("h.bundle", "h.term", "h.stage", "h.weight", "h.most", "i.item_no")
              .join(term_no, ["bundle", "term"]))
    by_no = lambda value, no: F.transform(F.array_sort(F.collect_list(F.struct(no, value))), lambda s: s[value])
    up_to = Window.partitionBy("bundle").orderBy("term_no")
    terms = (placed.groupBy("bundle", "term_no").agg(F.collect_list("item_no").alias("of"))
             .withColumn("end", F.sum(F.size("of")).over(up_to).cast("int"))
             .groupBy("bundle").agg(F.flatten(by_no("of", "term_no")).alias("term_items"), by_no("end", "term_no").alias("term_ends")))
    after = [F.sum(F.when(F.col("stage") > s, F.col("most")).otherwise(0)).alias(f"after{s}") for s in range(last + 1)]
    later = item_no.join(placed.groupBy("bundle", "item_no").agg(*after), ["bundle", "item_no"], "left")
    later = later.na.fill(0, [f"after{s}" for s in range(last + 1)])
    per_item = later.groupBy("bundle").agg(by_no("item_id", "item_no").alias("item_ids"),
                                           F.flatten(F.array(*[by_no(f"after{s}", "item_no") for s in range(last + 1)])).alias("later"))
    bundles = C.stored(per_item.join(terms, "bundle"), "item-bundles")
    term_table = C.stored(placed.select("bundle", "term", "term_no", "stage", "weight").distinct(), "bundle-terms")

    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("at_item", "int"), ("at_doc", "int"), ("at_score", "long"))]
    every = slices.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))))
    carried = every.join(bundles, "bundle").select(*[f.split()[0] for f in CARRIER.split(", ")[:7]], *none)
    for stage in range(last + 1):
        owned = term_table.filter(F.col("stage") == stage)
        given = postings.join(owned, "term").select("bundle", "slice", "doc_no", "term_no",
                                                    (F.col("weight") * _portion(n_docs, n_terms)).alias("contribution"))
        result = "item_id long, doc_id long, score long" if stage == last else CARRIER
        carried = carried.groupBy("bundle", "slice").cogroup(given.groupBy("bundle", "slice")).applyInArrow(
            _stage(stage, last, top), result)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return carried.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
