"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlens.session import scratch_dir

SHINGLE_WORDS = 5
CHUNK_BYTES = 1 << 18       # bytes of text hashed in one numpy pass
BATCH_ROWS = 2000           # rows that Spark hands to a Python worker at once, at most
BATCH_BYTES = 16 << 20      # bytes of them, about
_U = np.uint64


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared checkpoint folder of the session."""
    return f"{scratch_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, so a lost executor costs no recomputation of what came before."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that hands Python workers bounded batches: texts
    are long, and a worker holds a batch and what is made of it."""
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = str(conf.get(name)).rstrip("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(name, str(most))
    return df


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table; other columns are dropped, so
    that their names cannot clash."""
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


# ------------------------------------------------------- hashing of words

def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit words (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(0x9E3779B97F4A7C15)) * _U(0xD1342543DE82EF95))


_BASE = 0x5851F42D4C957F2D                      # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def byte_class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(chars, np.uint8)] = True
    return table


WHITE = byte_class(b" \t\n\x0b\x0c\r")          # 0x20 and 0x09-0x0D
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = seeded(256, 11)[_LOWER]               # A-Z hash like a-z


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copies; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word: maximal runs of non-separators that
    do not cross a document border."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~sep[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hasher(data: np.ndarray):
    """A function of (starts, ends) that gives 64-bit hashes of those bytes of
    ``data``, A-Z like a-z."""
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(_LETTER[data] * up[:len(data)], out=total[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))
    return hashes


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hasher(data)(starts, ends) if len(starts) else np.zeros(0, _U)


def _pieces(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Cut a batch into byte ranges of about ``size`` (CHUNK_BYTES), at document borders
    or, inside a longer document, after a separator."""
    at, end = 0, len(data)
    while at < end:
        to = min(end, at + (size or CHUNK_BYTES))
        if to < end:
            k = int(np.searchsorted(offsets, to, side="right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:
                stop = int(offsets[k + 1])
                hits = np.flatnonzero(sep[data[to:stop]])
                to = to + int(hits[0]) + 1 if len(hits) else stop
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch of documents, and for document i the
    range ``bounds[i]:bounds[i + 1]`` of its words."""
    hashes, begins = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for a, b in _pieces(data, offsets, sep):
        part = data[a:b]
        inner = offsets[(offsets >= a) & (offsets <= b)] - a
        starts, ends = word_spans(part, inner, sep)
        hashes.append(span_hashes(part, starts, ends))
        begins.append(starts + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each document in order, with bounds; a
    document of fewer than k words has its whole sequence as one shingle, one
    without words has none."""
    n = np.diff(bounds)
    weight = seeded(k, 5) | _U(1)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - k + 1), dtype=_U)
        for i in range(k):
            rolled += words[i:len(words) - k + 1 + i] * weight[i]
        rolled = mix64(rolled)
        count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
        out_bounds = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(out_bounds[-1]), dtype=_U)
        take = np.flatnonzero(n >= k)
        if len(take):
            # positions 0..n-k of every long document, laid out one after the other
            src = np.repeat(bounds[take] - out_bounds[take], count[take]) 
            dst = np.concatenate([np.arange(out_bounds[i], out_bounds[i + 1]) for i in take])
            out[dst] = rolled[dst + src]
        for i in np.flatnonzero((n > 0) & (n < k)):
            w = words[bounds[i]:bounds[i + 1]]
            out[out_bounds[i]] = mix64(np.array([(w * weight[:len(w)]).sum(dtype=_U) + _U(len(w))], _U) ^ _U(0xA5A5A5A5A5A5A5A5))[0]
    return out, out_bounds


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    data, offsets = text_buffers(pa.array([text], pa.string()))
    hashes, _ = shingle_hashes(*word_hashes(data, offsets))
    return np.unique(hashes)


# ------------------------------------------------------- batches of texts

SLICE_BYTES = 1 << 20


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each part holds about ``limit`` bytes of text
    (a longer document comes alone, whole)."""
    for batch in batches:
        _, offsets = text_buffers(batch.column(column))
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


# ------------------------------------------------------- rows by key

MAP_WORDS = 1 << 18         # words of 64 bits in a bitmap of hashed ids (bounded, so it may be broadcast)


def id_bitmap(ids: DataFrame, column: str) -> DataFrame:
    """(map_word, map_bits): a bitmap of hashed ids, at most MAP_WORDS rows."""
    return ids.groupBy(_map_word(column).alias("map_word")).agg(F.bit_or(_map_bit(column)).alias("map_bits"))


def _map_word(column: str):
    return F.pmod(F.xxhash64(column), F.lit(MAP_WORDS))


def _map_bit(column: str):
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(column), F.lit(64)).cast("int"))


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a key column: the id, or for a null id a hash of the text."""
    key = unused_name(docs, "row_key")
    return docs.withColumn(key, F.coalesce(F.col(id_col).cast("long"),
                                           F.xxhash64(F.lit("no id"), F.col(text_col).cast("string")))), key


def likely_among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among ``ids`` (one column), and a few others:
    those that a broadcast bitmap lets through. Nothing is shuffled."""
    word, bits = unused_name(rows, "map_word"), unused_name(rows, "map_bits")
    bitmap = id_bitmap(ids, ids.columns[0]).withColumnsRenamed({"map_word": word, "map_bits": bits})
    return (rows.join(F.broadcast(bitmap), _map_word(key) == F.col(word))
            .filter(F.col(bits).bitwiseAND(_map_bit(key)) != 0).select(*rows.columns))


def without_ids(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``key`` is among the ids ``gone`` (one
    column). Only rows that a broadcast bitmap can't clear are shuffled; they
    are stored first, else the optimizer would move the exact join before it."""
    word, bits = unused_name(docs, "map_word"), unused_name(docs, "map_bits")
    bitmap = id_bitmap(gone, gone.columns[0]).withColumnsRenamed({"map_word": word, "map_bits": bits})
    marked = docs.join(F.broadcast(bitmap), _map_word(key) == F.col(word), "left")
    clear = marked.filter(F.col(bits).isNull() | (F.col(bits).bitwiseAND(_map_bit(key)) == 0)).select(*docs.columns)
    ids = gone.select(F.col(gone.columns[0]).alias(unused_name(docs, "gone_id"))).distinct()
    doubtful = stored(likely_among(docs, key, gone), "doubtful")
    return clear.union(doubtful.join(ids, F.col(key) == F.col(ids.columns[0]), "left_anti").select(*docs.columns))
