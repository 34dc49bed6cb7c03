"""Best-fit packing by minimum bin slack.

Only the histogram of piece lengths, at most one row per length up to the
capacity, is planned on the driver; its size does not depend on the corpus.
Each bin starts with the longest piece left; a bitset subset-sum over the
lengths left (longest first, with their counts) finds the combination that
fills the rest fullest. The combination is removed as many times as the counts
allow, so the plan has about as many patterns as there are lengths. Pieces are
numbered within their length by Spark and look up their place in the plan.

Defined cases: a null or empty text is its end token alone; repeated rows and
rows with a null doc_id are packed like any other; an empty table packs to no
rows; other columns of the input are ignored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C

CAPACITY = 2048
END_ID = 0
SALTS = 64                  # parts in which the pieces of one length are numbered
CACHE_WORDS = 300_000       # words that a worker remembers (about 15 MB)
ENCODED_WORDS = 4000        # words that are encoded at once
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ƿ]+")      # no letter among them changes length in lower case
_ASCII_LETTER = C.byte_class(bytes(range(65, 91)) + bytes(range(97, 123)))
_MARK = C.byte_class(b".,!?;:")
_TOKENIZERS: dict[str, _Words] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Words:
    """Token ids by word, for one tokenizer: sorted 64-bit hashes of words, in
    arrays, for Python objects would take several times the memory; their ids lie
    together in a pool. When the memory is full it starts anew."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)            # ids that end a run of letters
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.keys, self.begin, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, "<u4"), 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def codes(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of words. Words of plain Latin letters are one run of letters
        each, so they are encoded as one text and told apart by word ends."""
        plain = [i for i, w in enumerate(words) if _PLAIN.fullmatch(w)]
        kept = set(plain)
        other = [i for i in range(len(words)) if i not in kept]
        found = [np.zeros(0, "<u4")] * len(words)
        for i, code in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)):
            found[i] = np.array(code.ids, "<u4")
        if plain:
            text = " ".join([words[i] for i in plain])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            joined = len(stop) == len(plain) and stop[-1] == len(ids)
            for i, own in zip(plain, np.split(ids, stop[:-1]) if joined else [self.whole(words[i]) for i in plain]):
                found[i] = own
        return found

    def learn(self, keys: np.ndarray, spans: list[tuple[int, int]], raw: bytes) -> None:
        """Remember words, given by sorted new hashes and their places in ``raw``.
        What the tokenizer makes of a word is far larger than its ids, so few
        words are encoded at once."""
        ids, count = [], np.zeros(len(keys), np.int64)
        for at in range(0, len(keys), ENCODED_WORDS):
            found = self.codes([raw[x:y].decode() for x, y in spans[at:at + ENCODED_WORDS]])
            count[at:at + len(found)] = list(map(len, found))
            ids.append(np.concatenate(found))
        after = self.used + np.cumsum(count)
        while after[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:after[-1]] = np.concatenate(ids)
        self.used, place = int(after[-1]), np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.count = (np.insert(old, place, own) for old, own in (
            (self.keys, keys), (self.begin, after - count), (self.count, count)))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        data, offsets = C.text_buffers(texts)
        hashes, starts, ends = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in C._pieces(data, offsets, C.WHITE):
            part = data[a:b]
            s, e = C.word_spans(part, np.concatenate([offsets[(offsets >= a) & (offsets <= b)] - a, _cuts(part)]), C.WHITE)
            hashes.append(C.span_hashes(part, s, e))
            starts.append(s + a)
            ends.append(e + a)
        key, first, number = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        start, end = np.concatenate(starts), np.concatenate(ends)
        if len(self.keys) > CACHE_WORDS:
            self.forget()
        new = np.flatnonzero(~np.isin(key, self.keys, assume_unique=True))
        if len(new):
            self.learn(key[new], list(zip(start[first[new]].tolist(), end[first[new]].tolist())), data.tobytes())
        slot = np.searchsorted(self.keys, key)[number]
        begin, count = self.begin[slot], self.count[slot]
        after = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(begin - after[:-1], count) + np.arange(after[-1])]
        bounds = after[np.searchsorted(start, offsets)]
        out = [ids[bounds[i]:bounds[i + 1]] for i in range(len(texts))]
        # special tokens are told apart by case, hashes are not: such texts are encoded whole
        marks = np.flatnonzero((data[:-1] == ord("|")) & (data[1:] == ord(">"))) if len(data) else ()
        for i in set((np.searchsorted(offsets, marks, side="right") - 1).tolist()):
            out[i] = self.whole(texts[i].as_py())
        return out


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places between a Latin letter (ASCII, or U+00C0 to U+00FF) and a
    punctuation mark; the tokenizer always parts them."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    letter = _ASCII_LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return np.flatnonzero(letter[:-1] & _MARK[data[1:]]) + 1


def encode_texts(texts: pa.Array, path: str) -> list[np.ndarray]:
    """Token ids of whole texts. The tokenizer drops white space and never
    joins characters across it, so words are encoded once and remembered by
    their 64-bit hash (letters A-Z like a-z, as the tokenizer sees them)."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _Words(path)
    return _TOKENIZERS[path].encode(texts)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in C.text_slices(batches, "text"):
            rows: list[tuple] = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode_texts(part.column("text"), path)):
                ids = np.append(ids, np.uint32(end_id))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start:start + capacity]
                    rows.append((doc_id, piece, start, len(own), zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            take = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:take], kinds)], names=names[:take])
    return run


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum of at most
    ``room``, long lengths preferred: bitset subset-sum with binary splitting
    of the counts."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left > 0:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (k * length)) & mask
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + k
            total -= k * length
    return used


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, multiplicity, first sequence, offset):
    ranks first..first+ranks-1 of a length lie ``multiplicity`` to a sequence,
    from ``offset`` on, in consecutive sequences."""
    left = {n: c for n, c in histogram.items() if c > 0}
    rank, sequence, plan = dict.fromkeys(left, 0), 0, []
    while left:
        seed = max(left)
        rest = dict(left)
        rest[seed] -= 1
        pattern = fullest({n: c for n, c in rest.items() if c}, capacity - seed)
        pattern[seed] = pattern.get(seed, 0) + 1
        times, offset = min(left[n] // m for n, m in pattern.items()), 0
        for n in sorted(pattern, reverse=True):
            m = pattern[n]
            plan.append((n, rank[n], times * m, m, sequence, offset))
            rank[n] += times * m
            offset += m * n
            left[n] -= times * m
            if not left[n]:
                del left[n]
        sequence += times
    return plan


def _place(plan: list[tuple]):
    order = sorted(plan)
    length, first, _, multiplicity, sequence, offset = (np.array([p[i] for p in order], np.int64) for i in range(6))
    span = int(first.max(initial=0) + max((p[2] for p in order), default=0) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            row = np.searchsorted(length * span + first, n * span + rank, side="right") - 1
            step = rank - first[row]
            keep = [i for i, c in enumerate(batch.schema.names) if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(sequence[row] + step // multiplicity[row]),
                                                   pa.array(offset[row] + step % multiplicity[row] * n)],
                names=[batch.schema.names[i] for i in keep] + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and the token ids themselves when ``with_ids`` is set."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    pieces = C.stored(C.id_text(docs, id_col, text_col).mapInArrow(
        _cut(tokenizer or default_tokenizer(), capacity, end_id, with_ids), kind), "packing-pieces")
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int"))
    counts = C.stored(dealt.groupBy("length", "salt").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("length", "salt", before.alias("base"))       # at most capacity * SALTS rows
    ranked = (dealt.withColumn("place", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
        .join(bases, ["length", "salt"])
        .select(*pieces.columns, (F.col("base") + F.col("place") - 1).alias("rank")))
    return ranked.mapInArrow(_place(plan_bins(histogram, capacity)), kind + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token sequences themselves, from pieces
    packed ``with_ids``; a sequence holds at most the capacity."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids")))
