import random

import pytest
from llm_fixtures import frame, prose, words

from ballotlens.llm.components import connected_components
from ballotlens.llm.minhash import near_duplicates


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (set sizes, component) by comparing all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = prose(rng, 1)
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randint(20, 200))) for i in range(40)]
    for k in range(6):                                      # groups of near copies around the threshold
        base = prose(rng, 150)
        out += [(100 + 20 * k + j, edited(rng, base, rng.randint(0, 6))) for j in range(14)]
    hot = prose(rng, 80)
    out += [(300 + j, hot.upper() if j % 2 else hot.replace(" ", "\t ")) for j in range(60)]
    out += [(400, None), (401, ""), (402, " \n\t"), (403, "ab cd"), (404, "AB  cd"), (405, "ab cd ef"), (None, hot), (None, None),
            (7, out[7][1]), (8, hot), (406, prose(rng, 30000)), (407, "x" * 100_000)]
    return out


def test_equals_brute_force(spark, rows):
    got = near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is True
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)
    sizes = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got)
    assert sizes == sorted((i is None, i or 0, len(shingles(t))) for i, t in rows)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == []


def test_lower_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(frame(spark, [(1, "a")]), num=1, den=2)


def test_components_of_chain_star_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 180)] + [(7, 7), (None, 3), (500, 400)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 180), 100), 400: 400, 500: 400}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
