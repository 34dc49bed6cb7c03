import hashlib
import random

import pytest
from llm_fixtures import frame, prose
from pyspark.sql import functions as F

from ballotlens.llm.exact_dedup import exact_duplicates, without_exact_copies


def brute(rows):
    """Sorted result rows by a dictionary of whole texts."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == best and left == 1
            left -= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, prose(rng, rng.randint(1, 60))) for i in range(60)]
    hot = prose(rng, 40)
    out += [(100 + i, hot) for i in range(150)]                                 # over a third of all rows
    out += [(300 + i, rng.choice(["a", "b", "A", "a ", "é", "é", " "])) for i in range(60)]
    out += [(400, None), (401, ""), (402, None), (7, out[7][1]), (7, out[7][1]), (8, "a"), (None, hot), (None, "only null"),
            (None, "only null"), (None, None), (500, "x" * 300_000), (501, "x" * 300_000), (502, "x" * 300_001)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_equals_brute_force(spark, rows, salts):
    assert got(exact_duplicates(frame(spark, rows).repartition(7), salts=salts)) == brute(rows)


def test_whole_texts_decide_where_digests_agree(spark, rows):
    weak = lambda t: F.length(t).cast("string")
    assert got(exact_duplicates(frame(spark, rows).repartition(5), digest=weak)) == brute(rows)
    assert got(exact_duplicates(frame(spark, rows), digest=lambda t: F.lit("one"))) == brute(rows)


def test_normalised_texts(spark):
    docs = frame(spark, [(1, "A b"), (2, "a  B"), (3, "c")])
    squeezed = exact_duplicates(docs, normalise=lambda t: F.lower(F.regexp_replace(t, r"\s+", " ")))
    assert {(r.doc_id, r.keep_id, r.text_sha256 == hashlib.sha256(b"a b").hexdigest()) for r in squeezed.collect()} == {
        (1, 2, True), (2, 2, True), (3, 3, False)}


def test_empty_table(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []
    assert without_exact_copies(frame(spark, [])).collect() == []


def test_rows_that_stay(spark, rows):
    docs = frame(spark, rows).withColumn("rank", F.monotonically_increasing_id().cast("string")).repartition(6)
    kept = without_exact_copies(docs)
    assert kept.columns == docs.columns
    want = sorted(((r[0], h) for r in brute(rows) if r[3] for h in [r[4]]), key=str)
    assert sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect()), key=str) == want
