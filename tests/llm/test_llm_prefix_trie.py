import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_fixtures import CLASHING, prose
from pyspark.sql import types as T

from ballotlens.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    extra = [*CLASHING, "depth", "digest", "key_a", "block"]
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())]
                          + [T.StructField(n, T.StringType()) for n in ["role", "text", *dict.fromkeys(extra)]])
    return spark.createDataFrame([(*r, *["x"] * len(dict.fromkeys(extra))) for r in rows], schema)


def brute(rows):
    """The trie by prefixes as tuples; subtrees by walking up from each node."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r[3], r[4]) for r in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * words
            leaves[node[:d]] += children[node] == 0
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items()), key=str)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    few = [prose(rng, rng.randint(1, 6)) for _ in range(3)]
    out = []
    for c in range(120):                                    # few different turns: many shared prefixes, some equal conversations
        out += [(c, t, rng.choice(["user", "assistant"]), rng.choice(few)) for t in range(rng.randint(1, 4))]
    stem = [("user" if t % 2 else "assistant", prose(rng, 3)) for t in range(30)]
    for c in range(200, 230):                               # long common beginnings that end or diverge inside blocks
        keep = rng.choice([4, 8, 9, 11, 16, 30])
        out += [(c, t, *stem[t]) for t in range(keep)] + [(c, 50 + t, "user", prose(rng, 2)) for t in range(rng.randint(0, 3))]
    out += [(300 + k, t, "user", "same") for k in range(60) for t in range(3)]                # a third ends at one node
    out += [(400, None, "user", "no turn"), (400, 0, None, None), (400, None, "user", None), (401, 5, "", ""), (401, 5, "", ""),
            (421, 0, "user", "a"), (441, 0, "u", "only own"), (None, 0, "user", "lost"), (-5, 0, "user", "minus"), (-3, 1, "user", "m"),
            (-5, 1, "user", "minus"), (500, 0, "us", "er"), (501, 0, "user", ""), (600, 0, "user", "x y " * 50_000)]
    out += [(700, 10_000 * t, "user", f"long {t % 7}") for t in range(300)]
    rng.shuffle(out)
    return out


def test_equals_brute_force(spark, rows):
    assert got(P.prefix_trie(frame(spark, rows).repartition(5))) == brute(rows)


def test_short_ranges_and_chunks(spark, rows, monkeypatch):
    for name, value in (("TURN_SPAN", 3), ("BLOCK_SPAN", 2), ("CHUNK", 5)):
        monkeypatch.setattr(P, name, value)
    assert got(P.prefix_trie(frame(spark, rows))) == brute(rows)


def test_no_turns_left_and_empty_table(spark):
    # 21's head would be turns of 20, which is absent; crc32 leaves it none of its own
    short = [(c, 0, "user", "hi") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0]
    assert got(P.prefix_trie(frame(spark, short))) == brute(short)
    assert len(brute(short)) == 1
    assert P.prefix_trie(frame(spark, [])).collect() == []


def test_only_blocks_with_diverging_siblings_are_refined(spark, rows):
    stem = [(c, t, "user", f"t{t}") for c in (200, 220, 240) for t in range(40)]
    tails = [(200, 90, "user", "p"), (220, 90, "user", "q")]
    turns, _ = P.rebuilt_turns(P.turn_digests(frame(spark, stem + tails)))
    members, rests = P._members(P.blocks_of(turns))
    runs = {(r["first"], r.depth) for r in members.collect()}
    # the ten whole blocks of the stem are runs of four turns; what follows belongs to one conversation each
    assert {(a, b) for a, b in runs if b <= 36} == {(d, d + 3) for d in range(1, 37, 4)}
    assert all(r["first"] > 36 for r in rests.collect())
