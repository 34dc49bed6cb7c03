"""Repeated passages by a sparse suffix array over words.

Suffixes are retained only at minimisers: of any 16 successive 8-word hashes
the smallest marks its position, so that a passage of 50 words, wherever it
occurs, has the same retained suffix within its first 16 words, followed by 35
or more words of the passage. Such a suffix is compared by its first 35 words
(its core), the 15 words after them and the 15 words before it.

1. The hash of each suffix's core is counted by document; suffixes whose core
   occurs in one document only are left out. (A bitmap of fixed size, broadcast,
   spares their transport; what follows is exact whatever it lets through.)
2. The suffixes are sorted: range partitions over their cores, in order of (core,
   words after, words before, doc_id) within each. Cores with more suffixes than
   a chunk of step 4 and than 1/4096 of all (so at most 4096 cores) are cut by all
   four columns, in which no two places of different documents are equal: a core
   that a third of all documents share is dealt over as many partitions as its
   rows fill. Any other core lies whole in one partition.
3. Neighbours in that order are compared: the number of words that a suffix
   shares with the next bounds the stretches of suffixes that agree on at least
   r words after the core. Each stretch is extended to the left: in the order of
   the words before, neighbours are compared again, and those that agree on
   l = 15 - r words hold the same 50 words. Where they come from two different
   doc_ids, a match of l words to the left and r to the right is found; each
   suffix keeps its longest to both sides. A document that repeats a passage
   itself only adds rows to a stretch, it never hides another document's.
4. Tasks take the order in chunks of bounded size. A core that goes over the edge
   of a chunk or of its partition is finished after the tasks: each chunk brings, per l, its groups
   of equal 50 words with their smallest and largest doc_id (no members), groups
   of equal hash are combined, and each chunk gets back what its groups are in all.
5. The matches are merged per document into maximal spans.

Words are those of the near-duplicate operator (white space apart, A-Z like
a-z). Cores and the groups of step 4 are compared by 64-bit hashes, the words
before and after by 32 bits each, so that one compared pair in four thousand
million is taken a word too far. Offsets are word numbers from 0, ends are
exclusive.

Defined cases: null, empty and shorter texts have no spans; a passage that
repeats only inside one doc_id (repeated rows included) is none; rows with a null doc_id take no part; an empty table gives an empty result;
other columns are ignored."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.skew import HEAVY

MIN_WORDS = 50
GRAM, WINDOW = 8, 16                    # words of a hash, hashes of a minimiser window
CORE = MIN_WORDS - WINDOW + 1           # 35 words certain to follow the first minimiser
REACH = MIN_WORDS - CORE                # words before and after the core that are compared
CHUNK_ROWS = 1 << 16                    # suffixes that a task compares at once
MAP_WORDS = 1 << 19                     # words of 64 bits in the bitmap
_U = np.uint64
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    """take (np.minimum or np.maximum) over windows of ``width``, a power of two."""
    step = 1
    while step < width:
        x = take(x[:-step], x[step:])
        step *= 2
    return x


def minimisers(grams: np.ndarray) -> np.ndarray:
    """Positions that hold the smallest hash of some window."""
    if len(grams) < WINDOW:
        return np.flatnonzero(grams == grams.min()) if len(grams) else np.zeros(0, np.int64)
    least = _sliding(grams, WINDOW, np.minimum)
    border = np.zeros(WINDOW - 1, least.dtype)
    return np.flatnonzero(_sliding(np.concatenate([border, least, border]), WINDOW, np.maximum) == grams)


def _run_hashes(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position."""
    with np.errstate(over="ignore"):
        up = np.full(len(words) + 1, _BASE, _U)
        up[0] = 1
        up = np.cumprod(up, dtype=_U)
        down = np.full(len(words) + 1, _INVERSE, _U)
        down[0] = 1
        down = np.cumprod(down, dtype=_U)
        total = np.zeros(len(words) + 1, _U)
        np.cumsum(words * up[:-1], out=total[1:])
        return C.mix64((total[at + width] - total[at]) * down[at])


def _retained(part: pa.RecordBatch):
    """Word hashes, document and position (in all words of the batch) of each
    retained suffix with its core hash, and the documents' word bounds."""
    data, offsets = C.text_buffers(part.column("text"))
    words, bounds = C.word_hashes(data, offsets)
    if len(words) < CORE:
        return words, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U), bounds
    weight = C.seeded(GRAM, 31) | _U(1)
    with np.errstate(over="ignore"):
        grams = np.zeros(len(words) - GRAM + 1, _U)
        for i in range(GRAM):
            grams += words[i:len(words) - GRAM + 1 + i] * weight[i]
        grams = C.mix64(grams)
    at = minimisers(grams)          # windows across a document border only add positions
    doc = np.searchsorted(bounds, at, side="right") - 1
    inside = at + CORE <= bounds[doc + 1]
    at, doc = at[inside], doc[inside]
    return words, doc, at, _run_hashes(words, at, CORE), bounds


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.text_slices(batches, "text"):
        _, doc, _, core, _ = _retained(part)
        ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        rows = np.unique(np.stack([core.view(np.int64), ids], axis=1), axis=0) if len(core) else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], names=["core", "doc_id"])


def _packed(words: np.ndarray) -> pa.Array:
    """Rows of 32-bit words as binary values that sort like the rows."""
    width = words.shape[1] * 4
    offsets = np.arange(len(words) + 1, dtype=np.int32) * np.int32(width)
    data = np.ascontiguousarray(words, dtype=">u4")
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(column: pa.Array) -> np.ndarray:
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, REACH), ">u4")
    first = int(np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)[0])
    return np.frombuffer(data, ">u4", len(column) * REACH, first).reshape(-1, REACH)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.text_slices(batches, "text"):
        words, doc, at, core, bounds = _retained(part)
        begin, end = bounds[doc], bounds[doc + 1]
        whole = np.minimum(at - begin, REACH) + np.minimum(end - at - CORE, REACH) >= REACH     # else no 50 words around it
        doc, at, core, begin, end = doc[whole], at[whole], core[whole], begin[whole, None], end[whole, None]
        ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[doc]
        short = np.maximum(words >> _U(32), _U(1)).astype(np.uint32) if len(words) else np.ones(1, np.uint32)
        near = np.arange(REACH)
        after, before = at[:, None] + CORE + near, at[:, None] - 1 - near
        # 0 stands for "beyond the document"
        after = np.where(after < end, short[np.minimum(after, len(short) - 1)], 0)
        before = np.where(before >= begin, short[np.maximum(before, 0)], 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(at - bounds[doc]), pa.array(core.view(np.int64)), _packed(after), _packed(before)],
            names=["doc_id", "at", "core", "after", "before"])


def shared_frames(core: np.ndarray, after: np.ndarray, before: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For sorted suffixes and each number of words to the left: an order of the
    suffixes and the places in it where a group of equal 50 words begins. Groups
    come from neighbours alone, in the order of the suffixes and in that of the
    words before them. Groups that reach beyond a document are left to the caller."""
    agree = np.concatenate([after[1:] == after[:-1], np.zeros((max(len(core) - 1, 0), 1), bool)], axis=1).argmin(axis=1)
    agree[core[1:] != core[:-1]] = -1                       # words shared with the suffix before, after an equal core
    by_left = np.argsort(np.ascontiguousarray(before).view(f"S{4 * REACH}").ravel(), kind="stable")
    for left in range(REACH + 1):
        stretch = np.cumsum(np.concatenate([[0], agree < REACH - left]))
        order = by_left[np.argsort(stretch[by_left], kind="stable")]
        inside, near = stretch[order], before[order, :left]
        equal = (inside[1:] == inside[:-1]) & (near[1:] == near[:-1]).all(axis=1)
        yield left, order, np.flatnonzero(np.concatenate([[True], ~equal]))


class _Sorted:
    """Sorted suffixes, those with equal surroundings as one."""

    def __init__(self, doc, at, core, after, before):
        again = (core[1:] == core[:-1]) & (after[1:] == after[:-1]).all(axis=1) & (before[1:] == before[:-1]).all(axis=1)
        begin = np.flatnonzero(np.concatenate([[True], ~again]))
        self.doc, self.at = doc, at
        self.count = np.diff(np.append(begin, len(core)))
        self.least, self.most = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
        self.core, self.after, self.before = core[begin], after[begin], before[begin]

    def groups(self):
        """Per number of words to the left: that number, members and sizes of the
        groups of equal 50 words within their documents, smallest and largest doc_id."""
        for left, order, starts in shared_frames(self.core, self.after, self.before):
            head, right = order[starts], REACH - left
            fits = np.ones(len(head), bool)
            if left:
                fits &= self.before[head, left - 1] != 0
            if right:
                fits &= self.after[head, right - 1] != 0
            size = np.diff(np.append(starts, len(order)))
            lo, hi = np.minimum.reduceat(self.least[order], starts), np.maximum.reduceat(self.most[order], starts)
            yield left, order[np.repeat(fits, size)], size[fits], head[fits], lo[fits], hi[fits]

    def keys(self, left: int, head: np.ndarray) -> np.ndarray:
        """Hash of the 50 words of the groups that these suffixes stand for."""
        words = np.concatenate([self.before[head, :left], self.after[head, :REACH - left]], axis=1).astype(_U)
        with np.errstate(over="ignore"):
            return C.mix64((C.mix64(words + _U(1)) * (C.seeded(REACH, 33) | _U(1))).sum(axis=1, dtype=_U)
                           + C.mix64(self.core[head].view(_U)) * _U(_BASE) + _U(left)).view(np.int64)

    def extended(self, shared) -> dict[str, np.ndarray]:
        """The longest match of every suffix that has one; ``shared`` tells which
        groups hold two documents, and the smallest doc_id of each."""
        n = len(self.core)
        longest, shortest, partner = np.full(n, -1), np.full(n, REACH), np.full(n, np.iinfo(np.int64).max)
        for left, members, size, head, lo, hi in self.groups():
            found, lo = shared(left, head, lo, hi)
            rows = members[np.repeat(found, size)]
            longest[rows], shortest[rows] = left, np.minimum(shortest[rows], left)
            partner[rows] = np.minimum(partner[rows], np.repeat(lo[found], size[found]))
        longest, shortest, partner = (np.repeat(x, self.count) for x in (longest, shortest, partner))
        hit = longest >= 0
        return {"doc_id": self.doc[hit], "a": (self.at - longest)[hit], "b": (self.at - shortest)[hit] + MIN_WORDS,
                "least": partner[hit]}


_SPAN_SQL = "doc_id long, a long, b long, least long"
_ROW_SQL = f"{_SPAN_SQL}, chunk long, key long, most long, core long, after binary, before binary"
_ROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "a", "b", "least", "chunk", "key", "most", "core")]
                 + [("after", pa.binary()), ("before", pa.binary())])


def _rows(**columns) -> pa.RecordBatch:
    n = len(columns["chunk"] if "chunk" in columns else columns["doc_id"])
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array)
         else pa.array(columns[f.name], f.type) for f in _ROW], schema=_ROW)


def _matches(doc, at, core, after, before) -> Iterator[pa.RecordBatch]:
    """Spans (doc_id, a, b, least) of cores that lie wholly in a chunk."""
    begin = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))
    many = np.minimum.reduceat(doc, begin) < np.maximum.reduceat(doc, begin)
    keep = np.repeat(many, np.diff(np.append(begin, len(core))))
    if keep.any():
        rows = _Sorted(*(x[keep] for x in (doc, at, core, after, before)))
        yield _rows(**rows.extended(lambda left, head, lo, hi: (lo < hi, lo)))


def _unfinished(doc, at, core, after, before) -> Iterator[pa.RecordBatch]:
    """The suffixes of a core that may go on in other chunks (``a`` is their
    place), and its groups (chunk, key, least, most)."""
    chunk = uuid.uuid4().int >> 65
    yield _rows(chunk=np.full(len(core), chunk), doc_id=doc, a=at, core=core, after=_packed(after), before=_packed(before))
    rows = _Sorted(doc, at, core, after, before)
    for left, _, _, head, lo, hi in rows.groups():
        yield _rows(chunk=np.full(len(head), chunk), key=rows.keys(left, head), least=lo, most=hi)


def _finished(suffixes: pa.Table, total: pa.Table) -> pa.Table:
    """Spans of one chunk's unfinished suffixes; ``total`` has the keys of its
    groups that hold two documents in all chunks together."""
    if not len(total) or not len(suffixes):
        return pa.table({n: pa.array([], pa.int64()) for n in ("doc_id", "a", "b", "least")})
    part = suffixes.sort_by([(n, "ascending") for n in ("core", "after", "before", "doc_id", "a")]).combine_chunks().to_batches()[0]
    total = total.sort_by("key")
    known, least = total.column("key").to_numpy(), total.column("lo").to_numpy()
    rows = _Sorted(*(part.column(n).to_numpy(zero_copy_only=False) for n in ("doc_id", "a", "core")),
                   _unpacked(part.column("after")), _unpacked(part.column("before")))

    def shared(left, head, lo, hi):
        key = rows.keys(left, head)
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return known[place] == key, least[place]
    return pa.table({n: pa.array(v, pa.int64()) for n, v in rows.extended(shared).items()})


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk one range of the sorted suffixes. A heavy core at its start or end may
    go on in the range beside it, and a core that fills a chunk in the next one."""
    waiting, rows, begun, open_core = [], 0, False, None

    def parts(last: bool):
        nonlocal waiting, rows, begun, open_core
        doc, at, core, after, before, heavy = (np.concatenate([w[i] for w in waiting]) for i in range(6))
        if not begun and heavy[0]:
            open_core = core[0]
        begun = True
        head = 0 if open_core is None else int(np.searchsorted(core, open_core, side="right"))
        tail = int(np.searchsorted(core, core[-1], side="left"))
        cuts = [(0, head, False)]
        if tail >= head:
            cuts.append((head, tail, True))
            if last:
                cuts.append((tail, len(core), not heavy[-1]))
            else:
                waiting, rows = [tuple(x[tail:] for x in (doc, at, core, after, before, heavy))], len(core) - tail
        if tail < head or last:
            waiting, rows = [], 0
        elif rows >= CHUNK_ROWS:                            # this core alone fills a chunk
            open_core = core[-1]
            cuts.append((tail, len(core), False))
            waiting, rows = [], 0
        for a, b, closed in cuts:
            if a < b:
                yield from (_matches if closed else _unfinished)(doc[a:b], at[a:b], core[a:b], after[a:b], before[a:b])

    for batch in batches:
        if not len(batch):
            continue
        waiting.append((*(batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc_id", "at", "core")),
                        _unpacked(batch.column("after")), _unpacked(batch.column("before")),
                        batch.column("heavy").to_numpy(zero_copy_only=False)))
        rows += len(batch)
        if rows >= CHUNK_ROWS:
            yield from parts(False)
    if rows:
        yield from parts(True)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start_word, end_word, n_words of each maximal span whose words
    repeat in other documents in runs of 50 or more; least_doc_id, the smallest
    doc_id that shares a run of it, and first, whether that is this document."""
    texts = C.id_text(docs, id_col, text_col).filter("doc_id is not null")
    word = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_WORDS))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(c), F.lit(64)).cast("int"))
    shared = (texts.mapInArrow(_cores, "core long, doc_id long").groupBy("core")
              .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi"))
    bitmap = C.stored(shared.groupBy(word("core").alias("map_word")).agg(F.bit_or(bit("core")).alias("map_bits")), "suffix-map")
    # stored, so that the sample that sets the ranges reads what is sorted
    suffixes = C.stored(
        texts.mapInArrow(_suffixes, "doc_id long, at long, core long, after binary, before binary")
        .join(F.broadcast(bitmap), word("core") == F.col("map_word"))           # at most MAP_WORDS rows
        .filter(F.col("map_bits").bitwiseAND(bit("core")) != 0)
        .select("doc_id", "at", "core", "after", "before"), "suffixes")
    sorted_by = ["core", "after", "before", "doc_id"]
    most = max(CHUNK_ROWS, suffixes.count() // HEAVY)
    heavy = C.stored(suffixes.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > most)
                     .select("core", F.lit(True).alias("heavy")), "suffixes-heavy")
    marked = suffixes.join(F.broadcast(heavy), "core", "left").withColumn("heavy", F.coalesce("heavy", F.lit(False)))
    compared = C.stored(marked.repartitionByRange("core", *[F.when(F.col("heavy"), F.col(c)) for c in sorted_by[1:]])
                        .sortWithinPartitions(*sorted_by).mapInArrow(_compared, _ROW_SQL), "suffixes-compared")
    groups = compared.filter("key is not null").select(F.col("chunk").alias("in_chunk"), "key", "least", "most")
    total = groups.groupBy("key").agg(F.min("least").alias("lo"), F.max("most").alias("hi")).filter("lo < hi")
    # a chunk is at most CHUNK_ROWS suffixes and a batch, with REACH + 1 groups each
    carried = (compared.filter("core is not null").select("chunk", "doc_id", "a", "core", "after", "before").groupBy("chunk")
               .cogroup(groups.join(total, "key").select("in_chunk", "key", "lo").groupBy("in_chunk"))
               .applyInArrow(_finished, _SPAN_SQL))
    spans = (compared.filter("chunk is null").select("doc_id", "a", "b", "least").unionByName(carried)
             .groupBy("doc_id", "a", "b").agg(F.min("least").alias("least")))
    order = Window.partitionBy("doc_id").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = (spans.withColumn("fresh", F.when(F.coalesce(before < F.col("a"), F.lit(True)), 1).otherwise(0))
              .withColumn("island", F.sum("fresh").over(order)))
    return (island.groupBy("doc_id", "island").agg(F.min("a").alias("start_word"), F.max("b").alias("end_word"),
                                                   F.min("least").alias("least_doc_id"))
            .select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                    "least_doc_id", (F.col("least_doc_id") == F.col("doc_id")).alias("first")))


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the given spans (word numbers)."""
    gone = {i for a, b in spans for i in range(a, b)}
    raw = text.encode()
    data, offsets = C.text_buffers(pa.array([text]))
    starts, ends = C.word_spans(data, offsets, C.WHITE)
    kept, at = [], 0
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        if i in gone:
            kept.append(raw[at:a])
            at = b
    return b"".join([*kept, raw[at:]]).decode()
