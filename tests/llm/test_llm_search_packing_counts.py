import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import frame, prose
from pyspark.sql import functions as F

from ballotlens.llm import packing as P
from ballotlens.llm import token_counts as K
from ballotlens.llm.permutation_index import nearest

ODD = ["Hello  wörld\x1cfoo", "á e b ́x ΣΑΣ ΑΣ.", "<|endoftext|> x <|startoftext|>y z<|endoftext|>", "<|ENDOFTEXT|> a",
       "don't I'LL 12 345\t\x0b\x0c q　w\x85r", "İSTANBUL ﬁ Ķ", "it 's 're", "", None, "😀👍🏽 a.b a..b x!?;y é.é ×. ÷."]


# ---------------------------------------------------------------- search
def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, vector string, block int")


def test_search_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = {i: [math.cos(i), math.sin(i), 0.5] for i in range(30)}
    rows = [(i, v, 1, "x", "x", 1) for i, v in good.items()]
    rows += [(100, None, 1, "", "", 1), (120, [0.0, 0.0, 0.0], 1, "", "", 1), (140, [1.0, nan, 0.0], 1, "", "", 1),
             (160, [1.0, None, 0.0], 1, "", "", 1), (180, [inf, 0.0, 0.0], 1, "", "", 1), (None, [1.0, 0.0, 0.0], 1, "", "", 1),
             (200, [1.0], 1, "", "", 1), (220, [], 1, "", "", 1), (21, good[20], 1, "", "", 1), (20, good[20], 1, "", "", 1)]
    got = defaultdict(list)
    for r in nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 20]
    f32 = [(i, np.float32(v).astype(float)) for i, v in [*good.items(), (21, good[20]), (20, good[20])]]
    for q in (0, 20):
        x = np.float32(good[q]).astype(float)
        want = sorted(((-float((v * x).sum()), i) for i, v in f32 if i != q))[:20]
        assert [(k + 1, i, -s) for k, (s, i) in enumerate(want)] == got[q]


def test_search_recall_and_empty(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 16)).astype(np.float32) * rng.uniform(0.5, 1.5, (3000, 1)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = defaultdict(set)
    for r in nearest(df, F.col("vec_id") % 50 == 0).collect():
        found[r.query_id].add(r.vec_id)
    s = x.astype(float) @ x.T.astype(float)
    np.fill_diagonal(s, -np.inf)
    hits = [len(found[q] & set(np.argsort(-s[q])[:20].tolist())) for q in range(0, 3000, 50)]
    assert np.mean(hits) / 20 >= 0.9
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest(df.filter("vec_id % 50 != 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_search_recall_with_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 64)).astype(np.float32)
    x[rng.permutation(6000)[:2000]] = x[0]
    near = x[0] + 0.6 * rng.standard_normal((600, 64)).astype(np.float32)      # vectors around the copies
    x[1:6000:10] = near
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 100 == 1).collect():
        found[r.query_id].append(r.score)
    s = x.astype(float) @ x.T.astype(float)
    np.fill_diagonal(s, -np.inf)
    hits = [np.mean([v >= np.sort(s[q])[-20] - 1e-9 for v in found[q]]) for q in range(1, 6000, 100)]
    assert np.mean(hits) >= 0.95 and min(hits) >= 0.5


# ---------------------------------------------------------------- packing
def test_words_encode_like_whole_texts():
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("aZé.,!'s1 \t\n×÷ñ|<>-İ…́\x1c ") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = P.default_tokenizer()
    own = Tokenizer.from_file(path)
    for _ in range(2):                                  # with an empty and with a full memory
        for t, ids in zip(texts, P.encode_texts(pa.array(texts), path)):
            assert ids.tolist() == own.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_fullest_is_the_best_subset(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(5)}
    room, sums = rng.randint(5, 90), {0}
    for n, c in counts.items():
        for _ in range(c):
            sums |= {s + n for s in sums}
    used = P.fullest(counts, room)
    assert sum(n * m for n, m in used.items()) == max(s for s in sums if s <= room)
    assert all(m <= counts[n] for n, m in used.items())


def test_packing_round_trip(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randint(1, 400))) for i in range(150)] + [(1000 + i, t) for i, t in enumerate(ODD)]
    rows += [(2000, prose(rng, 9000)), (None, "no id"), (None, None), (3, rows[3][1])]
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(P.default_tokenizer())
    packed = P.pack(frame(spark, rows), with_ids=True).cache()
    got = packed.collect()
    texts = defaultdict(list)
    for r in got:
        texts[r.doc_id].append((r.piece, r.start, r.ids))
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert r.start == 2048 * r.piece
    ids = {i: own.encode(t or "", add_special_tokens=False).ids + [0] for i, t in rows}
    for i, t in rows:
        if i is not None and i != 3:
            assert [x for _, _, piece in sorted(texts[i]) for x in piece] == ids[i]
    assert len(texts[3]) == 2 and len(texts[None]) == 2
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.ids))
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 1        # within one of the least possible
    whole = {r.sequence_id: r.ids for r in P.sequences(packed).collect()}
    assert whole == {k: [x for _, _, i in sorted(v) for x in i] for k, v in sequences.items()}
    assert P.pack(frame(spark, [])).count() == 0


def test_plan_covers_every_rank_once():
    histogram = {2048: 5, 1500: 7, 700: 9, 548: 4, 3: 100, 1: 3000}
    seen = defaultdict(list)
    for n, first, ranks, many, sequence, offset in P.plan_bins(histogram, 2048):
        assert ranks % many == 0
        seen[n] += range(first, first + ranks)
    assert {n: len(v) for n, v in seen.items()} == histogram
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())


# ---------------------------------------------------------------- token counts
def test_token_counts(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 60))) for i in range(200)] + [(None, None), (1, ""), (1, "a"), (2, prose(rng, 5000))]
    encoding = K._encoding(K.default_ranks())
    n = sorted(len(encoding.encode_ordinary(t or "")) for _, t in rows)
    limits = K.limit_table(K.length_histogram(frame(spark, rows))).cache()
    got = {r.n_tokens: r for r in limits.collect()}
    assert sorted(got) == sorted(set(n))
    for k, r in got.items():
        assert (r.documents, r.tokens) == (n.count(k), k * n.count(k))
        assert (r.documents_within, r.tokens_within) == (sum(x <= k for x in n), sum(x for x in n if x <= k))
        assert (r.documents_over, r.tokens_over) == (sum(x > k for x in n), sum(x for x in n if x > k))
        assert r.truncated_tokens == sum(min(x, k) for x in n)
        assert (r.all_documents, r.all_tokens) == (len(n), sum(n))
    assert K.truncated_total(limits, 77).first()[0] == sum(min(x, 77) for x in n)
    assert {r.share: r.n_tokens for r in K.quantiles(limits, [0.5, 1.0]).collect()} == {0.5: n[len(n) // 2 - 1], 1.0: n[-1]}
    assert K.limit_table(K.length_histogram(frame(spark, []))).count() == 0
