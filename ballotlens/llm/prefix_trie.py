"""Prefix trie of conversations by fixed-length block hashing.

Turns become digests at once; blocks of BLOCK turns become block digests, and the
bitwise xor of those up to a block names the prefix that ends there. Conversations
are grouped by these block prefixes first. Where all members of a block prefix go on
with one and the same block, its turns are nodes with the same members, and nothing
inside it is looked at. Where only one conversation goes on, the whole rest of it is
one row. Only blocks in which siblings diverge are refined into turns.

Sums over subtrees need no walk up the tree. A node belongs to the smallest of its
members, which also owns the nodes below on its own path; so the leaves under a node
are its members that own a leaf, and the words saved under it are, over its members,
the words of their turns from the node to the first one that they own.

Conversations of any length are cut into ranges for positions and running prefixes,
hot prefixes are aggregated before they are shuffled and joined by a broadcast of
the few heavy groups; the digest of the members that end at a node is taken from
chunks of sorted ids that are streamed.

Defined cases: a NULL role or text is empty. Turns are ordered by turn, NULL first,
then by digest; repeated rows are turns of their own. Rows with a NULL conv_id take
no part. A conversation is rebuilt from its head (see ``rebuilt_turns``) and may be
left without turns; then it ends at the root. An empty table gives no rows. Other columns
are ignored, whatever their names. Turns are told apart by SHA-256 of role and text,
prefixes by 128 bits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.skew import before_in_order, join_groups

BLOCK = 4               # turns in a block
HEADS = 20              # conversations that share the head of the first of them
HEAD_TURNS = 4          # heads have fewer turns than this
TURN_SPAN = 4096        # values of turn in a range
BLOCK_SPAN = 512        # blocks in a range
CHUNK = 4096            # values of conv_id in a chunk
NODE = ["depth", "key_a", "key_b"]
INSIDE = [f"words_{i}" for i in range(1, BLOCK)]      # words of the turns of a run but the last
WORD = r"[^\x20\x09-\x0D]+"


def _head_turns() -> Column:
    return F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEAD_TURNS))


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words): all that the trie needs of a turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations of :func:`turn_digests`: rows (conv_id, depth from 1,
    digest, words, length), and (conv_id, length, own) of all, ``own`` being its rows.

    Conversation c gets the first h turns of c - c % HEADS (fewer, if it has
    fewer), then its own after the first h; h = crc32(c) % HEAD_TURNS."""
    part = F.floor(F.col("turn") / TURN_SPAN)
    cut = turns.withColumn("part", part)
    inside = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "digest")
    earlier = (Window.partitionBy("conv_id").orderBy(F.col("part").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    parts = cut.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("own"))
    sizes = parts.select("conv_id", "own").distinct()
    base = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("in_base"))
    head = _head_turns()
    plan = (parts.withColumn("base", F.col("conv_id") - F.col("conv_id") % HEADS).join(base, "base", "left")
            .withColumn("skip", head).withColumn("head", F.least(head, F.coalesce("in_base", F.lit(0)))))
    plan = C.stored(plan.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("skip"), F.lit(0)))
                    .select("conv_id", "part", "before", "own", "skip", "head", "length"), "turn-ranges")
    known = plan.select(F.col("conv_id").alias("id"), F.col("part").alias("range"), "before", "skip", "head", "length")
    placed = (cut.withColumn("at", F.row_number().over(inside))
              .join(known, (F.col("conv_id") == F.col("id")) & F.col("part").eqNullSafe(F.col("range")))
              .withColumn("place", F.col("before") + F.col("at")))
    placed = C.stored(placed.select("conv_id", "place", "digest", "words", "skip", "head", "length"), "placed-turns")
    own = placed.filter("place > skip").select("conv_id", (F.col("place") - F.col("skip") + F.col("head")).alias("depth"),
                                               "digest", "words", "length")
    every = plan.filter("before = 0").select("conv_id", "head", "length", "own")
    lent = (placed.filter((F.col("place") < HEAD_TURNS) & (F.col("conv_id") % HEADS == 0))
            .select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "words"))
    heads = (every.withColumn("base", F.col("conv_id") - F.col("conv_id") % HEADS).join(lent, "base")
             .filter(F.col("depth") <= F.col("head")).select("conv_id", "depth", "digest", "words", "length"))
    return own.unionByName(heads), every.select("conv_id", "length", "own")


def _lane(digest: Column, block: Column, lane: int) -> Column:
    return F.xxhash64(F.lit(lane), digest, block)


def blocks_of(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: its turns, and names of the prefix
    before it (from_a, from_b) and with it (key_a, key_b)."""
    rows = (turns.withColumn("block", F.floor((F.col("depth") - 1) / BLOCK))
            .groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(F.struct("depth", "digest", "words"))).alias("turns"),
                                             F.sum("words").alias("in_block"), F.max("length").alias("length")))
    rows = C.stored(rows, "turn-blocks")
    digest = F.sha2(F.concat_ws(",", "turns.digest"), 256)
    rows = rows.withColumn("a", _lane(digest, F.col("block"), 1)).withColumn("b", _lane(digest, F.col("block"), 2))
    rows = before_in_order(rows, "conv_id", "block", BLOCK_SPAN, {"words_before": "in_block"}, {"from_a": "a", "from_b": "b"})
    return rows.select("conv_id", "block", "turns", "length", "words_before", "from_a", "from_b",
                       F.col("from_a").bitwiseXOR(F.col("a")).alias("key_a"), F.col("from_b").bitwiseXOR(F.col("b")).alias("key_b"))


def _members(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, rests). Members: rows of a run of nodes (depths ``first`` to
    ``depth``) and a conversation that holds them. Rests: per conversation, the run
    from the first block into which no other one goes with it."""
    group = ["block", "from_a", "from_b"]
    siblings = C.stored(blocks.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), (F.min(F.struct("key_a", "key_b")) != F.max(F.struct("key_a", "key_b"))).alias("diverge")),
        "sibling-blocks")
    known = C.stored(join_groups(blocks, siblings, group, "n", blocks.count()), "known-blocks")
    shared = known.filter("n > 1")
    start = F.col("block") * BLOCK
    none = [F.lit(0).cast("long").alias(c) for c in INSIDE]
    whole = shared.filter("not diverge").select(
        "conv_id", "length", (start + 1).alias("first"), (start + F.size("turns")).alias("depth"), "key_a", "key_b",
        start.alias("up"), F.col("from_a").alias("up_a"), F.col("from_b").alias("up_b"), "words_before",
        *[F.coalesce(F.get("turns.words", F.lit(i)), F.lit(0)).alias(c) for i, c in enumerate(INSIDE)])
    name = lambda i, lane, before: before.bitwiseXOR(
        _lane(F.sha2(F.concat_ws(",", F.slice(F.col("turns.digest"), 1, i)), 256), F.col("block"), lane))
    a, b = F.col("from_a"), F.col("from_b")
    up_words = lambda i: F.aggregate(F.slice(F.col("turns.words"), 1, i - 1), F.lit(0).cast("long"), lambda x, y: x + y)
    turn = shared.filter("diverge").withColumn("i", F.explode(F.sequence(F.lit(1), F.size("turns"))))
    i, on = F.col("i"), F.col("i") > 1
    refined = turn.select(
        "conv_id", "length", (start + i).alias("first"), (start + i).alias("depth"),
        name(i, 1, a).alias("key_a"), name(i, 2, b).alias("key_b"), (start + i - 1).alias("up"),
        F.when(on, name(F.greatest(i - 1, F.lit(1)), 1, a)).otherwise(a).alias("up_a"),
        F.when(on, name(F.greatest(i - 1, F.lit(1)), 2, b)).otherwise(b).alias("up_b"),
        (F.col("words_before") + up_words(i)).alias("words_before"), *none)
    begin = F.struct("block", "from_a", "from_b", "words_before")
    rests = (known.filter("n = 1").groupBy("conv_id").agg(F.min(begin).alias("s"), F.max("length").alias("length"))
             .select("conv_id", "length", (F.col("s.block") * BLOCK + 1).alias("first"), (F.col("s.block") * BLOCK).alias("up"),
                     F.col("s.from_a").alias("up_a"), F.col("s.from_b").alias("up_b"), F.col("s.words_before").alias("words_before")))
    return whole.unionByName(refined), rests


def _ends(ended: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id) rows: members in numerical order.
    Ids of a chunk are joined at once, then chunks are streamed in their order."""
    chunk = F.floor(F.col("conv_id") / CHUNK)
    parts = (ended.groupBy(*NODE, chunk.alias("chunk"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, names = None, None, [*NODE, "ends_sha256"]

        def closed(done: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])], names=names)

        for batch in batches:
            done = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if at != node:
                    if node is not None:
                        done.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield closed(done)
        if node is not None:
            yield closed([(*node, sha.hexdigest())])

    return (parts.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
            .mapInArrow(digest, "depth long, key_a long, key_b long, ends_sha256 string"))


NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns, every = rebuilt_turns(turn_digests(C.small_batches(conversations)))
    every = C.stored(every, "conversations")
    blocks = C.stored(blocks_of(turns), "named-blocks")
    members, rests = _members(blocks)
    members, rests = C.stored(members, "prefix-members"), C.stored(rests, "unshared-rests")

    # who owns which nodes: the smallest member
    place = ["first", "up", "up_a", "up_b", "words_before", *INSIDE]
    same = [F.min(c).alias(c) for c in place]            # equal for all members of a node
    n_ends = F.count(F.when(F.col("length") == F.col("depth"), 1))
    owned = members.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), (n_ends == F.count(F.lit(1))).alias("leaf"), *same)
    first_owned = (owned.select("conv_id", "first", "words_before", "leaf")
                   .unionByName(rests.select("conv_id", "first", "words_before", F.lit(True).alias("leaf")))
                   .groupBy("conv_id").agg(F.min(F.struct("first", "words_before")).alias("s"), F.bool_or("leaf").alias("leaf")))
    all_words = blocks.groupBy("conv_id").agg(F.sum(F.aggregate("turns.words", F.lit(0).cast("long"), lambda x, y: x + y)).alias("all"))
    owners = (all_words.join(first_owned, "conv_id", "left")
              .select("conv_id", F.coalesce("s.words_before", "all").alias("shared_words"), F.coalesce("leaf", F.lit(False)).alias("leaf")))
    owners = C.stored(owners.join(every.select("conv_id", F.col("length").alias("most")), "conv_id"), "node-owners")

    # per node, over its members
    whole = every.agg(F.sum("length").alias("turns"), F.min("conv_id").alias("smallest"), F.count(F.lit(1)).alias("convs")).first()
    known = join_groups(members, owners, ["conv_id"], "most", whole.turns or 0)
    saved = F.greatest(F.col("shared_words") - F.col("words_before"), F.lit(0))
    nodes = C.stored(known.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count(F.when(F.col("leaf"), 1)).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"), *same), "shared-nodes")
    ended = _ends(members.filter("length = depth").select(*NODE, "conv_id")
                  .unionByName(every.filter("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("key_a"),
                                                                 F.lit(0).cast("long").alias("key_b"), "conv_id")))
    ended = C.stored(ended, "node-ends")
    zero = F.lit(0).cast("long")
    root = owners.agg(F.count(F.when(F.col("leaf"), 1)).alias("leaves"), F.coalesce(F.sum("shared_words"), zero).alias("saved_tokens"))
    root = root.select(*[zero.alias(c) for c in NODE], F.lit(whole.smallest).cast("long").alias("conv_id"),
                       F.lit(whole.convs).cast("long").alias("n_convs"), F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"),
                       "saved_tokens", zero.alias("first"), *[F.lit(None).cast("long").alias(c) for c in place[1:]])
    root = root.filter("n_convs > 0")
    nodes = nodes.unionByName(root)
    up = {"up": "depth", "up_a": "key_a", "up_b": "key_b"}
    children = (nodes.select(*up).unionByName(rests.select(*up)).filter("up is not null").withColumnsRenamed(up)
                .groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children")))
    full = C.stored(nodes.join(children, NODE, "left").join(ended, NODE, "left").select(
        *nodes.columns, F.coalesce("n_children", zero).alias("n_children"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")),
        "trie-nodes")

    # parents: one row for each that has children
    runs = C.stored(full.filter("depth > 0").withColumn("shared", F.lit(True)).unionByName(rests.select(
        F.col("length").alias("depth"), zero.alias("key_a"), zero.alias("key_b"), "conv_id", F.lit(1).cast("long").alias("n_convs"),
        F.lit(1).cast("long").alias("n_leaves"), zero.alias("saved_tokens"), *place[:5], *[zero.alias(c) for c in INSIDE],
        zero.alias("n_children"),
        F.sha2(F.col("conv_id").cast("string"), 256).alias("ends_sha256"), F.lit(False).alias("shared"))), "node-runs")
    parents = full.filter("n_children > 0").select(F.col("depth").alias("up"), F.col("key_a").alias("up_a"), F.col("key_b").alias("up_b"),
                                                   F.col("conv_id").alias("parent"), F.col("n_children").alias("among"))
    linked = join_groups(runs, parents, ["up", "up_a", "up_b"], "among", runs.count())
    at = linked.withColumn("at", F.explode(F.sequence("first", "depth")))
    last = F.col("at") == F.col("depth")
    above = sum([F.when(F.col("at") - F.col("first") >= i, F.col(c)).otherwise(0) for i, c in enumerate(INSIDE, 1)], zero)
    saved = F.col("saved_tokens") - (F.col("n_convs") - 1) * above
    inner = at.select("conv_id", F.col("at").alias("depth"),
                      F.when(F.col("at") == F.col("first"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
                      "n_convs", F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves", saved.alias("saved_tokens"),
                      F.when(last, F.col("ends_sha256")).otherwise(NO_ENDS).alias("ends_sha256"))
    top = full.filter("depth = 0").select("conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
                                          "n_leaves", "saved_tokens", "ends_sha256")
    return inner.unionByName(top)
