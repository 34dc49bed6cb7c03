"""The sorted sparse suffixes: neighbours, chunks and ranges."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from ballotlens.llm import suffix_dedup as S
from llm_fixtures import frame, prose
from test_llm_filters import brute_spans


def suffix_rows(rows):
    """Sorted suffix rows of (doc_id, text), as the range partitions hold them."""
    part = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])],
                                      names=["doc_id", "text"])
    table = pa.Table.from_batches(list(S._suffixes(iter([part]))))
    return sorted(zip(*(table.column(n).to_pylist() for n in ("core", "after", "before", "doc_id", "at"))))


def batches(rows, size, heavy=True):
    for i in range(0, len(rows), size):
        core, after, before, doc, at = zip(*rows[i:i + size])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(at), pa.array(core), pa.array(after, pa.binary()), pa.array(before, pa.binary()),
             pa.array([heavy] * len(core))], names=["doc_id", "at", "core", "after", "before", "heavy"])


def cover(parts):
    """Words covered per document by the rows of compared ranges."""
    found = pa.Table.from_batches(parts, S._ROW)
    spans = [r for r in found.to_pylist() if r["chunk"] is None]
    lo, hi = {}, {}
    groups = [r for r in found.to_pylist() if r["key"] is not None]
    for g in groups:
        lo[g["key"]] = min(lo.get(g["key"], g["least"]), g["least"])
        hi[g["key"]] = max(hi.get(g["key"], g["most"]), g["most"])
    open_rows = found.filter(pc.is_valid(found.column("core")))
    for chunk in {r["chunk"] for r in open_rows.to_pylist()}:
        keys = sorted({g["key"] for g in groups if g["chunk"] == chunk and lo[g["key"]] < hi[g["key"]]}, reverse=True)
        spans += S._finished(open_rows.filter(pc.equal(open_rows.column("chunk"), chunk)),
                             pa.table({"key": pa.array(keys, pa.int64()), "lo": pa.array([lo[k] for k in keys], pa.int64())})).to_pylist()
    got = {}
    for r in spans:
        assert r["least"] <= r["doc_id"]
        got.setdefault(r["doc_id"], set()).update(range(r["a"], r["b"]))
    return got


def corpus(seed, n=60):
    """Passages in many surroundings, half of which agree on a few words."""
    rng = random.Random(seed)
    passages = [prose(rng, k) for k in (44, 49, 50, 53, 80)]
    ends = [prose(rng, 12).split() for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 3)):
            before, after = rng.choice(ends), rng.choice(ends)
            parts += [prose(rng, rng.randint(1, 9)), *before[len(before) - rng.randint(0, 9):], rng.choice(passages),
                      *after[:rng.randint(0, 9)]]
        rows.append((i // 2 if i % 5 == 0 else 1000 + i, " ".join(parts)))
    rows.append((7000, "a " * 200))
    rows.append((7001, "a " * 120))
    return rows


def test_neighbours_bound_the_groups():
    """Three suffixes of one core: two agree after it, two before it."""
    core = np.array([5, 5, 5, 9], np.int64)
    after = np.array([[1] * 15, [1] * 15, [1] * 14 + [2], [1] * 15], ">u4")
    before = np.array([[3] * 15, [4] * 15, [4] * 15, [4] * 15], ">u4")
    groups = {left: [sorted(g.tolist()) for g in np.split(order, starts[1:])]
              for left, order, starts in S.shared_frames(core, after, before)}
    assert groups[0] == [[0, 1], [2], [3]]                  # all 15 words after: the third differs in the last
    assert sorted(groups[1]) == [[0], [1, 2], [3]]          # 14 after, one before
    assert sorted(groups[15]) == [[0], [1, 2], [3]]         # none after, 15 before; another core is never joined


@pytest.mark.parametrize("chunk,size", [(1 << 16, 1 << 16), (64, 20), (5, 3), (1, 1)])
def test_chunks_do_not_matter(monkeypatch, chunk, size):
    monkeypatch.setattr(S, "CHUNK_ROWS", chunk)
    rows = corpus(3)
    want = brute_spans(rows)
    assert want and cover(list(S._compared(batches(suffix_rows(rows), size)))) == want


def test_ranges_do_not_matter(monkeypatch):
    monkeypatch.setattr(S, "CHUNK_ROWS", 50)
    rows = corpus(4)
    sorted_rows, want = suffix_rows(rows), brute_spans(rows)
    for n in (2, 7, 40):
        cuts = np.linspace(0, len(sorted_rows), n + 1).astype(int)
        parts = [p for a, b in zip(cuts, cuts[1:]) for p in S._compared(batches(sorted_rows[a:b], 30))]
        assert cover(parts) == want
    assert list(S._compared(iter([]))) == []
    # light cores lie whole in a range, and nothing is left unfinished there
    monkeypatch.setattr(S, "CHUNK_ROWS", 1 << 16)
    border = [0, *[i for i in range(1, len(sorted_rows)) if sorted_rows[i][0] != sorted_rows[i - 1][0]][::9], len(sorted_rows)]
    parts = [p for a, b in zip(border, border[1:]) for p in S._compared(batches(sorted_rows[a:b], 30, heavy=False))]
    assert cover(parts) == want and all(p.column("chunk").null_count == len(p) for p in parts)


def test_a_hot_core_is_dealt_over_ranges(spark, monkeypatch):
    """One passage in every document: its rows fill many partitions."""
    monkeypatch.setattr(S, "CHUNK_ROWS", 30)                # heavy from 30 rows on
    rng = random.Random(6)
    passage = prose(rng, 55)
    rows = [(i, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for i in range(400)]
    got = {r.doc_id: set(range(r.start_word, r.end_word)) for r in S.repeated_passages(frame(spark, rows)).collect()}
    assert got == brute_spans(rows) and len(got) == 400
    suffixes = spark.createDataFrame([(c, bytes(a), bytes(b), d) for c, a, b, d, _ in suffix_rows(rows)],
                                     "core long, after binary, before binary, doc_id long")
    hot = Counter(r.core for r in suffixes.collect()).most_common(1)[0][0]
    spread = suffixes.repartitionByRange(8, "core", "after", "before", "doc_id").filter(f"core = {hot}")
    held = [n for n in spread.rdd.glom().map(len).collect() if n]
    assert sum(held) == 400 and max(held) < 400
