"""Benchmark decontamination by SimHash over item-sized windows (DataFrame
functions only).

Of all windows of a document that are as long as an item, the best can be moved
right, without getting worse, until its first shingle is one of the item's or
the document ends. So the windows that begin at a shared 5-word shingle (or are
the last of the document) hold the best one; those that line a shared shingle
up with its place in the item are tried too and are preferred where equal. A
window goes on only if it holds as many shared shingles as similarity 0.8
needs; what is left out here is below 0.8 for certain. Each window gets a
64-bit SimHash of its shingles, as items do; a shingle's repeats are told apart
by number, so that every one has a vote of its own. A
multi-index of thirteen blocks finds every pair within Hamming distance 25: two
fingerprints that close differ by at most one bit in at least one block, and
items are posted under all values of a block within one bit. A block of five
bits alone would let most unrelated pairs through, so its lists are divided
by shingle: window and item are posted under their rarest numbered shingles,
so many that two of similarity 0.8 have one of them in common. Shingles that many
items share are nobody's rarest, unless an item has hardly any others. Pairs in reach
are then compared exactly: sum of the smaller by sum of the larger shingle
counts, 0.8 or more. At a similarity of 0.8 the cosine is 8 / 9 or more, so a
bit differs with probability 0.15 at most: 9.7 bits on average (standard
deviation 2.9), and a pair lies beyond 25 with probability 8e-7.

Words are runs of letters and digits of the lower-cased text. Defined cases:
items of fewer than five words, and null or empty texts, take no part; rows
that share a doc_id are one document (its best window counts), null doc_id
included; items that share an item_id are one item (its best text counts);
without benchmark items or documents the result is empty; other columns are
ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ballotlens.llm import common as C

SIMILARITY = 0.8
RADIUS = 25
BLOCK_BITS = (5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 4)    # 64 bits; 2 * blocks > RADIUS
BROADCAST_SHINGLES = 500_000                        # benchmark shingles that may be broadcast (about 20 MB)
N = C.SHINGLE_WORDS


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(w: Column) -> Column:
    return F.when(F.size(w) >= N, F.transform(F.sequence(F.lit(0), F.size(w) - N),
                                              lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(N)])))


def shingle_texts(w: Column) -> Column:
    return F.when(F.size(w) >= N, F.transform(F.sequence(F.lit(1), F.size(w) - N + 1),
                                              lambda i: F.concat_ws(" ", F.slice(w, i, N))))


def numbered(hashes: Column) -> Column:
    """Hashes of (hash, occurrence number): no two are equal."""
    return F.flatten(F.transform(F.array(F.sort_array(hashes)), lambda a: F.transform(
        a, lambda h, i: F.xxhash64(h, i - F.array_position(a, h)))))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash of an array of 64-bit hashes."""
    def vote(bit: Column) -> Column:
        return F.aggregate(hashes, F.lit(0), lambda a, h: a + F.call_function("shiftright", h, bit).bitwiseAND(1).cast("int") * 2 - 1)
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(
        F.when(vote(b) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))))


def _blocks(fingerprint: Column) -> list[Column]:
    out, low = [], 0
    for bits in BLOCK_BITS:
        out.append(F.shiftrightunsigned(fingerprint, low).bitwiseAND((1 << bits) - 1).cast("int"))
        low += bits
    return out


def exact_keys(fingerprint: Column) -> Column:
    """block * 128 + value of each block."""
    return F.array(*[F.lit(128 * i) + b for i, b in enumerate(_blocks(fingerprint))])


def near_keys(fingerprint: Column) -> Column:
    """Keys of all block values within one bit."""
    return F.array(*[F.lit(128 * i) + b.bitwiseXOR(flip) for i, b in enumerate(_blocks(fingerprint))
                     for flip in [0] + [1 << k for k in range(BLOCK_BITS[i])]])


def promising(texts: DataFrame, similarity: float) -> DataFrame:
    """(body, n, p, place): windows of n words that hold the hit at p and shared
    shingles enough for ``similarity``; place is (0 if lined up with an item,
    else 1; first word). Texts come with their hits (p, qs), ordered by p."""
    size = F.least("n", "m") - N + 1                                # shingles of a window
    last = F.greatest(F.col("m") - F.col("n"), F.lit(0))
    # c shared shingles give a similarity of c / (both sizes - c) at most
    need = F.greatest(F.ceil(similarity * (size + F.col("n") - N + 1) / (1 + similarity) - 1e-9).cast("int"), F.lit(1))
    texts = texts.select("body", "n", "hits", F.col("hits.p").alias("at"), size.alias("size"), last.alias("last"),
                         need.alias("need")).filter(F.size("hits") >= F.col("need"))

    def holds(start: Column, i: Column) -> Column:
        """Whether the window from start, which holds hit i, holds ``need`` hits."""
        return F.exists(F.sequence(F.greatest(i - F.col("size"), F.lit(0)), i), lambda j: F.coalesce(
            (F.get("at", j) >= start) & (F.get("at", j + F.col("need") - 1) < start + F.col("size")), F.lit(False)))

    def starts(hit: Column, i: Column) -> Column:
        clamp = lambda x: F.greatest(F.least(x, F.col("last")), F.lit(0))
        lined = F.transform(hit["qs"], lambda q: F.struct(F.lit(0).alias("other"), clamp(hit["p"] - q).alias("start")))
        tried = F.concat(lined, F.array(F.struct(F.lit(1).alias("other"), clamp(hit["p"]).alias("start"))))
        return F.transform(F.filter(tried, lambda t: holds(t["start"], i)), lambda t: F.struct(hit["p"].alias("p"), t.alias("place")))

    return (texts.select("body", "n", F.explode(F.flatten(F.transform("hits", starts))).alias("x"))
            .groupBy("body", "n", "x.place").agg(F.min("x.p").alias("p")))


def rarest(owners: DataFrame, key: str, held: DataFrame, common: Column) -> DataFrame:
    """(key, n, print, vote): of each owner's numbered shingles, ordered by the
    number of items that hold them, the first ``size - common + 1``. Two sets with
    ``common`` or more shingles in common share one of these. Shingles of no item
    take their places in the order but lead nowhere."""
    ordered = (owners.select(key, "n", f"{key}_print", F.size("votes").alias("size"), F.explode("votes").alias("vote"))
               .join(held, ["n", "vote"], "left").groupBy(key, "n", f"{key}_print", "size")
               .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "vote"))).alias("votes")))
    return (ordered.select(key, "n", f"{key}_print", F.explode(F.slice("votes", F.lit(1), F.col("size") - common + 1)).alias("x"))
            .filter(F.col("x.held") > 0).select(key, "n", f"{key}_print", F.col("x.vote").alias("vote")))


def meeting(windows: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """(window, item, window_print, item_print): pairs that share a list of the
    index, once per list. Both sides come with their numbered shingles (votes)."""
    held = items.select("n", F.explode("votes").alias("vote")).groupBy("n", "vote").agg(F.count("*").alias("held"))
    if (items.agg(F.sum(F.size("votes"))).first()[0] or 0) <= BROADCAST_SHINGLES:
        held = F.broadcast(held)
    own, other = F.col("size"), F.col("n") - N + 1
    both = F.ceil(similarity * (own + other) / (1 + similarity) - 1e-9).cast("int")
    least = F.ceil(similarity * other - 1e-9).cast("int")           # whatever the window's size
    return (rarest(windows, "window", held, F.greatest(both, F.lit(1)))
            .withColumn("key", F.explode(exact_keys(F.col("window_print"))))
            .join(rarest(items, "item", held, F.greatest(least, F.lit(1)))
                  .withColumn("key", F.explode(near_keys(F.col("item_print")))), ["n", "vote", "key"])
            .select("window", "item", "window_print", "item_print"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text",
                 similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, start_word): items found in documents,
    with the best window."""
    items = C.stored(
        benchmark.select(F.col(item_col).cast("long").alias("item_id"), words(F.col(item_text_col)).alias("w"))
        .filter(F.size("w") >= N).dropDuplicates(["item_id", "w"])
        .select(F.xxhash64("item_id", "w").alias("item"), "item_id", "w", F.size("w").alias("n"))
        .select("*", numbered(shingle_hashes(F.col("w"))).alias("votes"))
        .select("*", simhash(F.col("votes")).alias("item_print")), "benchmark-items")
    places = (items.select("n", F.posexplode(shingle_hashes(F.col("w"))).alias("q", "shingle"))
              .groupBy("n", "shingle").agg(F.collect_set("q").alias("qs")))
    if places.count() <= BROADCAST_SHINGLES:
        places = F.broadcast(places)
    text = C.id_text(docs, id_col, text_col).select("doc_id", words(F.col("text")).alias("words"))
    # near: the words of all windows that hold the hit
    hits = C.stored(text.select("doc_id", "words", F.xxhash64("words").alias("body"))
                    .select("doc_id", "words", "body", F.posexplode(shingle_hashes(F.col("words"))).alias("p", "shingle"))
                    .join(places, "shingle").withColumn("origin", F.greatest(F.col("p") - F.col("n"), F.lit(0)))
                    .select("doc_id", "body", "n", F.size("words").alias("m"), "p", "qs", "origin",
                            F.slice("words", F.col("origin") + 1, 2 * F.col("n")).alias("near")), "benchmark-hits")
    good = hits.groupBy("body", "n", "m").agg(F.array_sort(F.collect_set(F.struct("p", "qs"))).alias("hits"))
    found = (promising(good, similarity).join(hits.drop("m", "qs"), ["body", "n", "p"])
             .select("doc_id", "n", "place", F.slice("near", F.col("place.start") - F.col("origin") + 1, F.col("n")).alias("w"))
             .withColumn("window", F.xxhash64("n", "w")))
    found = C.stored(found.groupBy("doc_id", "window", "n").agg(F.min("place").alias("place"), F.first("w").alias("w")),
                     "benchmark-windows")
    windows = C.stored(found.groupBy("window", "n").agg(F.first("w").alias("w"))
                       .select("*", numbered(shingle_hashes(F.col("w"))).alias("votes"))
                       .select("*", simhash(F.col("votes")).alias("window_print")), "benchmark-prints")
    pairs = (meeting(windows, items, similarity).filter(F.bit_count(F.col("window_print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
             .select("window", "item").distinct())
    counts = lambda df, key: (df.select(key, F.explode(shingle_texts(F.col("w"))).alias("s"))
                              .groupBy(key, "s").agg(F.count("*").alias(f"c_{key}")))
    size = lambda df, key: df.select(key, (F.size("w") - N + 1).alias(f"n_{key}"))
    similar = (pairs.join(counts(windows, "window"), "window").join(counts(items, "item"), ["item", "s"])
               .groupBy("window", "item").agg(F.sum(F.least("c_window", "c_item")).alias("both"))
               .join(size(windows, "window"), "window").join(size(items, "item"), "item")
               .withColumn("similarity", F.col("both") / (F.col("n_window") + F.col("n_item") - F.col("both")))
               .filter(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", (-F.col("place.other")).alias("lined"), (-F.col("place.start")).alias("back")))
    return (found.select("doc_id", "window", "place").join(similar.select("window", "item", "similarity"), "window")
            .join(items.select("item", "item_id"), "item").groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", F.col("best.similarity").alias("similarity"),
                    (-F.col("best.back")).cast("long").alias("start_word")))
