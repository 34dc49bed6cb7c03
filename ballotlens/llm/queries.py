"""Registered queries of the training-data operators (thin: each applies its
operator with production parameters to its whole table) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballotlens.llm import common as C
from ballotlens.llm.decontaminate import contaminated
from ballotlens.llm.exact_dedup import exact_duplicates
from ballotlens.llm.lexical_search import ranked
from ballotlens.llm.licenses import license_notices
from ballotlens.llm.minhash import near_duplicates
from ballotlens.llm.packing import pack
from ballotlens.llm.permutation_index import nearest
from ballotlens.llm.pii import digest_table, find_personal_data
from ballotlens.llm.prefix_trie import prefix_trie
from ballotlens.llm.suffix_dedup import repeated_passages
from ballotlens.llm.token_counts import length_histogram, limit_table
from ballotlens.llm.toxicity import toxicity_scores
from ballotlens.llm.warc import archive_pages


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.documents(spark, sf_dir))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op3_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(C.documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(C.documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_table(length_histogram(C.documents(spark, sf_dir)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_table(find_personal_data(C.documents(spark, sf_dir)))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices(C.documents(spark, sf_dir))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(C.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(C.documents(spark, sf_dir))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_permutation_index": op2_permutation_index,
    "op3_bin_packing": op3_bin_packing,
    "op4_toxicity": op4_toxicity,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_exact_dedup": op13_exact_dedup,
}

_OP1_SQL = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), listed AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM lowered
), sized AS (
  SELECT doc_id, CAST(len(s) AS BIGINT) AS n, md5(array_to_string(list_sort(s), chr(10))) AS class, s FROM listed
), classes AS (
  SELECT class, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM sized WHERE n > 0 GROUP BY class
), shingles AS (SELECT rep, n, hash(x) AS x FROM (SELECT rep, n, unnest(s) AS x FROM classes)
), paired AS (
  SELECT p.rep AS a, q.rep AS b, count(*) AS n_common, any_value(p.n) AS na, any_value(q.n) AS nb
  FROM shingles p JOIN shingles q ON p.x = q.x AND p.rep < q.rep GROUP BY ALL
), links AS (
  SELECT a, b FROM paired WHERE 100 * n_common >= 85 * (na + nb - n_common)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT rep AS origin, rep AS reached FROM classes
  UNION
  SELECT reach.origin, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.reached
), roots AS (SELECT origin AS rep, min(reached) AS component FROM reach GROUP BY origin)
SELECT d.doc_id, d.n AS n_shingles, coalesce(r.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(r.component, d.doc_id) AS kept
FROM sized d LEFT JOIN classes c ON c.class = d.class AND d.n > 0 LEFT JOIN roots r ON r.rep = c.rep
"""

_OP8_SQL = r"""
WITH own AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), coded AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, hex,
    translate(array_to_string(list_transform(range(0, 4), lambda g: to_base(CAST('0x' || substr(hex, 1 + 10 * g, 10) AS BIGINT), 32, 8)), ''),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM own
), led AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM coded)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM led
"""

_OP6_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), item AS (
  SELECT item_id, w, len(w) AS n FROM (
    SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) >= 5
), item_shingle AS (
  SELECT item_id, n, q, array_to_string(w[q:q + 4], ' ') AS s FROM (SELECT *, unnest(range(1, n - 3)) AS q FROM item)
), doc_shingle AS (
  SELECT doc_id, p, len(w) AS m, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM doc WHERE len(w) >= 5)
), lined AS (
  SELECT DISTINCT d.doc_id, i.n, greatest(least(d.p - i.q, d.m - i.n), 0) AS start
  FROM doc_shingle d JOIN (SELECT DISTINCT n, q, s FROM item_shingle) i USING (s)
), met AS (
  SELECT d.doc_id, i.item_id, i.n, d.m, d.p FROM doc_shingle d JOIN (SELECT DISTINCT item_id, n, s FROM item_shingle) i USING (s)
), hopeful AS (
  SELECT doc_id, item_id, n, m FROM met GROUP BY ALL
  HAVING count(*) >= 0.8 * (least(n, m) - 4 + n - 4) / 1.8 - 1e-9
), win AS (
  SELECT doc_id, n, start, w[start + 1:start + n] AS w
  FROM (SELECT doc_id, n, unnest(range(0, greatest(m - n, 0) + 1)) AS start FROM (SELECT DISTINCT doc_id, n, m FROM hopeful))
  JOIN doc USING (doc_id)
), win_shingle AS (
  SELECT doc_id, n, start, s, count(*) AS c FROM (
    SELECT doc_id, n, start, array_to_string(w[k:k + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS k FROM win)) GROUP BY ALL
), counted AS (SELECT item_id, n, s, count(*) AS c FROM item_shingle GROUP BY ALL
), joint AS (
  SELECT a.doc_id, a.start, b.item_id, b.n, sum(least(a.c, b.c)) AS common_n
  FROM win_shingle a JOIN counted b ON a.n = b.n AND a.s = b.s GROUP BY ALL
), scored AS (
  SELECT j.doc_id, j.item_id, j.start, CAST(common_n AS DOUBLE) / (len(win.w) - 4 + j.n - 4 - common_n) AS similarity,
    CASE WHEN lined.start IS NOT NULL THEN 2 WHEN win_begins.p IS NOT NULL THEN 1 ELSE 0 END AS place
  FROM joint j JOIN win ON win.doc_id = j.doc_id AND win.n = j.n AND win.start = j.start
  LEFT JOIN lined ON lined.doc_id = j.doc_id AND lined.n = j.n AND lined.start = j.start
  LEFT JOIN (SELECT DISTINCT doc_id, n, greatest(least(p - 1, m - n), 0) AS p FROM met) win_begins
    ON win_begins.doc_id = j.doc_id AND win_begins.n = j.n AND win_begins.p = j.start
)
SELECT doc_id, item_id, max(similarity) AS similarity,
  CAST(arg_max(start, struct_pack(a := similarity, b := place, c := -start)) AS BIGINT) AS start_word
FROM scored WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

_OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), sums AS (
  SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), posting AS (
  SELECT k, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT k, doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posting, sums GROUP BY term, docs
), part AS (
  SELECT k, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))) AS gain
  FROM posting JOIN weighted USING (term), sums
), scored AS (
  SELECT item_id, k, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) QUALIFY row_number() OVER best <= 10
"""

# crc32 % 4 of the digits of conv_id, bit by bit
_OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS b,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
          lambda k: CAST(ord(substr(CAST(conv_id AS VARCHAR), CAST(k AS INTEGER), 1)) AS BIGINT))),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
          lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), lent AS (
  SELECT c, p AS d, role, text FROM conv JOIN t ON t.conv_id = conv.b AND t.p <= conv.h
), lent_n AS (SELECT c, count(*) AS n FROM lent GROUP BY c
), turns AS (
  SELECT * FROM lent
  UNION ALL
  SELECT conv.c, t.p - h + coalesce(n, 0), role, text FROM conv JOIN t ON t.conv_id = conv.c AND t.p > conv.h LEFT JOIN lent_n ON lent_n.c = conv.c
), member AS (
  SELECT c, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, ',') OVER (PARTITION BY c ORDER BY d)) AS key FROM turns
  UNION ALL
  SELECT c, 0, 0, '' FROM conv
), linked AS (
  SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS up, lead(key) OVER (PARTITION BY c ORDER BY d) IS NULL AS ends FROM member
), node AS (
  SELECT key, min(d) AS depth, min(c) AS conv_id, min(up) AS up, min(words) AS words, count(*) AS n_convs, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY key
), child AS (SELECT up AS key, count(*) AS n_children FROM node GROUP BY up
), below AS (
  SELECT m.key, CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens, count(*) FILTER (u.leaf) AS n_leaves
  FROM node u JOIN member m ON m.c = u.conv_id AND m.d <= u.depth GROUP BY m.key
)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN below USING (key) LEFT JOIN child USING (key) LEFT JOIN node parent ON parent.key = node.up
"""

_OP13_SQL = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE_SQL = {
    "op11_lexical_search": _OP11_SQL,
    "op12_prefix_trie": _OP12_SQL,
    "op13_exact_dedup": _OP13_SQL,
    "op6_decontamination": _OP6_SQL,
    "op8_warc": _OP8_SQL,
    "op1_minhash_dedup": _OP1_SQL,
}
