"""MinHash near-duplicates by min-max hashing.

Every permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so 60 permutations give 120 values: 24 bands of 5.
At the lowest linked similarity (0.85) a pair misses all bands with
probability (1 - 0.85**5)**24 = 8e-7. Documents with the same shingle set form
one class first; only one row per class is banded.

Links are confirmed on the full sets, in two rounds that never emit all pairs
of a bucket:

1. each class is compared with the smallest class of each of its buckets (a
   star), which joins most groups of near copies into one component;
2. in buckets that still hold several components, classes of different
   components are compared by a longer min-max sketch (512 permutations, 1024
   one-byte values) inside blocks of at most about 1024 x 1024 rows; pairs whose
   sketches agree in 0.79 or more of the values (5.5 standard deviations below
   0.85) go on to the exact comparison.

Pairs inside a component need no further comparison: the result is
components, not pairs.

Defined cases: a null or blank text has no shingles and is linked with
nothing; repeated rows and rows that share a doc_id are one node (links of any
of its texts count) and each returns a row; a row with a null doc_id is
returned with a null component_id and kept = true; an empty table gives an
empty result; other columns of the input are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.components import connected_components

BANDS, ROWS = 24, 5
PERMUTATIONS = BANDS * ROWS // 2
SKETCH_PERMUTATIONS = 512
SKETCH_AGREE = 0.79
BLOCK = 1024            # rows of a bucket compared with as many others in one task
SALTS = 32              # parts into which the members of one centre are dealt
LINK_NUM, LINK_DEN = 85, 100
_U = np.uint64


def _min_max(values: np.ndarray, bounds: np.ndarray, permutations: int, seed: int) -> np.ndarray:
    """(documents, 2 * permutations): minimum and maximum of every permutation
    over each document's values. All documents must have values."""
    factor, shift = C.seeded(permutations, seed) | _U(1), C.seeded(permutations, seed + 1)
    out = np.empty((len(bounds) - 1, 2 * permutations), dtype=_U)
    with np.errstate(over="ignore"):
        for k in range(permutations):
            y = values * factor[k] + shift[k]
            out[:, 2 * k] = np.minimum.reduceat(y, bounds[:-1])
            out[:, 2 * k + 1] = np.maximum.reduceat(y, bounds[:-1])
    return out


def _sets(texts: pa.Array) -> list[np.ndarray]:
    data, offsets = C.text_buffers(texts)
    hashes, bounds = C.shingle_hashes(*C.word_hashes(data, offsets))
    return [np.unique(hashes[bounds[i]:bounds[i + 1]]) for i in range(len(texts))]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.text_slices(batches, "text"):
        sets = _sets(part.column("text"))
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        if full:
            signature = _min_max(*_flat([sets[i] for i in full]), PERMUTATIONS, 101)
            weight = C.seeded(ROWS, 103) | _U(1)
            with np.errstate(over="ignore"):
                rows = C.mix64((signature.reshape(len(full), BANDS, ROWS) * weight).sum(axis=2, dtype=_U)
                               + C.seeded(BANDS, 104)).view(np.int64)
            for i, row in zip(full, rows):
                bands[i] = row
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
             pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "digest", "bands"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in C.text_slices(batches, "text"):
        sets = _sets(part.column("text"))
        full = [s for s in sets if len(s)]
        if not full:
            continue
        sketch = (_min_max(*_flat(full), SKETCH_PERMUTATIONS, 107) >> _U(40)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) for s in full], pa.binary()),
             pa.array([s.tobytes() for s in full], pa.binary()),
             pa.array([row.tobytes() for row in sketch], pa.binary())],
            names=["digest", "members", "sketch"])


def _confirm(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by (centre, salt), the centre's own row first."""
        key, base = None, np.zeros(0, _U)
        for batch in batches:
            found_a, found_b = [], []
            for centre, salt, own, digest, members in zip(*(batch.column(n).to_pylist() for n in
                                                            ("centre", "salt", "own", "digest", "members"))):
                values = np.frombuffer(members, _U)
                if own == 0:
                    key, base = (centre, salt), values
                elif key == (centre, salt):
                    small, large = sorted((len(values), len(base)))
                    if den * small < num * large:
                        continue
                    common = len(np.intersect1d(values, base, assume_unique=True))
                    if den * common >= num * (small + large - common):
                        found_a.append(centre)
                        found_b.append(digest)
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.binary()), pa.array(found_b, pa.binary())],
                                             names=["da", "db"])
    return run


def _confirmed(pairs: DataFrame, candidates: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (da, db) of class digests whose full sets are similar enough.
    Members are dealt by (centre, salt); a centre goes once to each salt that
    has members."""
    sets = candidates.select("digest", "members")
    dealt = pairs.select(F.col("da").alias("centre"), F.col("db").alias("digest"),
                         F.pmod(F.xxhash64("db"), F.lit(SALTS)).cast("int").alias("salt"))
    members = dealt.join(sets, "digest").select("centre", "salt", F.lit(1).alias("own"), "digest", "members")
    centres = (dealt.select("centre", "salt").distinct().withColumn("digest", F.col("centre"))
               .join(sets, "digest").select("centre", "salt", F.lit(0).alias("own"), "digest", "members"))
    rows = (members.union(centres).repartition("centre", "salt")
            .sortWithinPartitions("centre", "salt", "own"))
    return rows.mapInArrow(_confirm(num, den), "da binary, db binary")


def _compare_cell(rows: list[dict]) -> tuple[list[bytes], list[bytes]]:
    sketch = np.stack([np.frombuffer(r["sketch"], np.uint8) for r in rows])
    bands = np.array([r["bands"] for r in rows])
    component = np.array([r["component"] for r in rows])
    block = np.array([r["block"] for r in rows])
    band = np.array([r["band"] for r in rows])
    one_block = rows[0]["i"] == rows[0]["j"]
    need, out_a, out_b = int(np.ceil(SKETCH_AGREE * sketch.shape[1])), [], []
    for x in range(len(rows) - 1):
        other = np.flatnonzero((component[x + 1:] != component[x]) & (one_block | (block[x + 1:] != block[x]))) + x + 1
        # a pair is looked at in the first band that it shares, once
        other = other[(band[other] == band[x]) & ((bands[other] == bands[x]).argmax(axis=1) == band[x])] if len(other) else other
        for y in other[(sketch[other] == sketch[x]).sum(axis=1) >= need] if len(other) else ():
            out_a.append(rows[x]["digest"])
            out_b.append(rows[y]["digest"])
    return out_a, out_b


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by cell; one cell is held at a time."""
    key, held, out_a, out_b = None, [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            if (cell := (row["bucket"], row["i"], row["j"])) != key:
                if len(held) > 1:
                    a, b = _compare_cell(held)
                    out_a += a
                    out_b += b
                key, held = cell, []
            held.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["da", "db"])
        out_a, out_b = [], []
    if len(held) > 1:
        a, b = _compare_cell(held)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["da", "db"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    num: int = LINK_NUM, den: int = LINK_DEN) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. Texts are
    linked when den * intersection >= num * union of their 5-word shingles."""
    if num * 100 < 85 * den:
        raise ValueError("bands and sketch threshold are set for similarities of 0.85 and more")
    texts = C.id_text(docs, id_col, text_col)
    features = C.stored(texts.mapInArrow(_features, "doc_id long, n_shingles long, digest binary, bands array<long>"),
                        "minhash-features")
    classes = (features.filter("digest is not null and doc_id is not null").groupBy("digest")
               .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    # one row per class: its smallest doc_id; repeated rows of that id give the same row again
    reps = (features.filter("digest is not null and doc_id is not null").groupBy("digest")
            .agg(F.min(F.struct("doc_id", "bands")).alias("r")).select("digest", F.col("r.doc_id").alias("rep"), "r.bands"))
    reps = C.stored(reps, "minhash-classes")
    posted = reps.select("digest", "rep", F.posexplode("bands").alias("band", "value")).withColumn(
        "bucket", F.xxhash64("band", "value"))
    shared = (posted.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("rep", "digest")).alias("centre"))
              .filter("size > 1"))
    members = C.stored(posted.join(shared, "bucket").select("bucket", "band", "size", "rep", "digest",
                                                            F.col("centre.digest").alias("centre")), "minhash-buckets")
    wanted = members.select("digest", F.col("rep").alias("wanted_id")).distinct()
    # texts that the bitmap lets through, nearly all of them wanted; the join on digests is exact
    candidates = C.stored(
        C.likely_among(texts, "doc_id", wanted.select("wanted_id"))
        .mapInArrow(_candidates, "digest binary, members binary, sketch binary")
        .join(wanted.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]), "minhash-candidates")
    ids = wanted.select("digest", F.col("wanted_id").alias("rep"))

    def as_edges(links: DataFrame) -> DataFrame:
        return (links.join(ids.select(F.col("digest").alias("da"), F.col("rep").alias("a")), "da")
                .join(ids.select(F.col("digest").alias("db"), F.col("rep").alias("b")), "db").select("a", "b"))

    star = members.filter("digest != centre").select(F.col("centre").alias("da"), F.col("digest").alias("db")).distinct()
    first = C.stored(as_edges(_confirmed(star, candidates, num, den)), "minhash-links")
    joined = connected_components(first)

    marked = members.join(joined, members.rep == joined.id, "left").select(
        "bucket", "band", "size", "rep", "digest", F.coalesce("component", "rep").alias("component"))
    open_buckets = (marked.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                    .filter("lo != hi").select("bucket"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cells = (marked.join(open_buckets, "bucket", "left_semi")
             .withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "band", "digest", "component", "block",
                     F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
             .join(candidates.select("digest", "sketch"), "digest")
             .join(reps.select("digest", "bands"), "digest")
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))
    crossing = cells.mapInArrow(_cells, "da binary, db binary").distinct()
    second = as_edges(_confirmed(crossing, candidates, num, den))
    edges = C.stored(second.union(joined.select(F.col("id").alias("a"), F.col("component").alias("b"))), "minhash-edges")
    # rows that share a doc_id tie their classes together; members of a class are tied to its representative
    inside = (features.filter("doc_id is not null").join(classes.filter("copies > 1"), "digest")
              .filter("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    final = connected_components(edges.union(inside))
    return (features.join(final, features.doc_id == final.id, "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
