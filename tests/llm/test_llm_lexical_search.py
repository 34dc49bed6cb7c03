import math
import random
import re
from collections import Counter

import pytest
from llm_fixtures import CLASHING, frame, prose
from pyspark.sql import types as T

from ballotlens.llm import lexical_search as S

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.lower() for t in TERM.findall((text or "").encode())]       # bytes.lower: A-Z only


def items_frame(spark, rows):
    extra = [c for c in CLASHING if c not in ("item", "text")]
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]
                          + [T.StructField(n, T.StringType()) for n in [*extra, "term", "slice", "doc_id"]])
    return spark.createDataFrame([(i, t) + ("x",) * (len(extra) + 3) for i, t in rows], schema)


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    words = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ts in asked.items():
        scores = []
        for i, b in bags:
            n = sum(b.values())
            score = 0
            for t in ts & set(b):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10 ** 9 * b[t] // (1000 * b[t] + 8 * (10 + 90 * n * n_docs // words)))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    common = prose(rng, 12).split()
    docs = [(i, prose(rng, rng.randint(1, 80)) + " " + " ".join(rng.choices(common, k=rng.randint(0, 30)))) for i in range(300)]
    copy = docs[17][1]
    docs += [(400 + i, copy) for i in range(40)] + [(17, docs[17][1]), (3, "another text of one id"), (3, "another text of one id")]
    docs += [(500, None), (501, ""), (502, "!? .\x00\x7f"), (None, copy), (None, docs[30][1]), (503, "Éa éa ÉA x_y-z 0x1F ß"),
             (504, " ".join(common) * 3000), (505, "a" * 200_000)]
    items = [(k, " ".join(docs[k][1].split()[:12])) for k in range(0, 60, 3)]
    items += [(100, " ".join(common)), (101, None), (102, ""), (103, "nothingofthis"), (104, "ÉA x Y z 0X1f"), (105, copy.upper()),
              (106, prose(rng, 5)), (106, copy), (None, " ".join(common[:3])), (107, "a" * 200_000)]
    return docs, items


def test_equals_brute_force(spark, tables, monkeypatch):
    docs, items = tables
    want = brute(docs, items)
    assert got(S.ranked(frame(spark, docs).repartition(3), items_frame(spark, items))) == want
    # many slices and bundles, other stages, all bits of the bitmap in use
    monkeypatch.setattr(S, "SLICE_DOCS", 16)
    assert got(S.ranked(frame(spark, docs), items_frame(spark, items), shares=(0.01, 0.1), bundle_items=4)) == want
    monkeypatch.setattr(S, "_bitmap", lambda terms: S.np.full(S.BITMAP_WORDS, 2 ** 64 - 1, S.np.uint64))
    assert got(S.ranked(frame(spark, docs), items_frame(spark, items), top=3, shares=())) == brute(docs, items, 3)


def test_empty_tables(spark, tables):
    docs, items = tables
    assert S.ranked(frame(spark, []), items_frame(spark, items)).collect() == []
    assert S.ranked(frame(spark, docs), items_frame(spark, [])).collect() == []
    assert S.ranked(frame(spark, [(1, None)]), items_frame(spark, items)).collect() == []


def test_texts_longer_than_a_pass_keep_their_terms(monkeypatch):
    monkeypatch.setattr(S.C, "CHUNK_BYTES", 64)
    text = " ".join(f"w{i % 50}" for i in range(400))
    n, found = S.text_terms(S.pa.array(["x y", text, None, "z"]), None)
    assert n.tolist() == [2, 400, 0, 1]
    assert dict(zip(found["term"].to_pylist(), found["tf"].tolist())) == {"x": 1, "y": 1, "z": 1, **{f"w{i}": 8 for i in range(50)}}
