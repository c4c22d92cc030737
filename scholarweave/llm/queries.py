"""The registered queries of this subpackage and their SQL twins.

Each query applies its operator to the whole table and derives the columns of its
contract from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from scholarweave.llm import (
    bitsliced, bpe, exact_dedup, hard_negatives, idfile, licenses, maxent, packing,
    prefix_trie, quality_rules, secrets, simhash, token_counts,
)
from scholarweave.workspace import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.score_documents(table(spark, folder, "documents"))


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), WORD_BPE)


@query
def op3_id_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_path(spark, "id-files")
    idfile.write_ids(table(spark, folder, "documents"), WORD_BPE, files)
    return idfile.read_checksums(spark, files)


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), WORD_BPE)


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), WORD_BPE)


@query
def op4_maxent(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.score_documents(table(spark, folder, "documents"))


@query
def op6_bit_sliced(spark: SparkSession, folder: str) -> DataFrame:
    return bitsliced.search(table(spark, folder, "embeddings"))


ORACLES["op6_bit_sliced"] = """
WITH coded AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS code
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_dot_product(q.code, v.code) AS BIGINT) AS score
  FROM coded q JOIN coded v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    # The table has no paths, so they are made of source and number: thousands and hundreds
    # are directories of a source, and the first document of each is its licence file.
    number = F.col("doc_id")
    level = lambda n: F.floor(number / n).cast("string")
    path = (
        F.when(number % 1000 == 0, F.concat_ws("/", "source", level(1000), F.lit("LICENSE")))
        .when(number % 100 == 0, F.concat_ws("/", "source", level(1000), level(100), F.lit("LICENSE")))
        .otherwise(F.concat_ws("/", "source", level(1000), level(100), number.cast("string")))
    )
    return licenses.scan(table(spark, folder, "documents"), path)


@query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, folder, "documents"), digest=True)


ORACLES["op13_exact_dedup"] = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS place,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM normal
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM numbered
"""


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(embeddings.withColumn("label", moved))


ORACLES["op12_hard_negatives"] = """
WITH coded AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS code
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_dot_product(a.code, v.code) AS BIGINT) AS score
  FROM coded a JOIN coded v ON a.vec_id <> v.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
   AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(*prefix_trie.shared_beginnings(*turns))


# The remainder of a crc32 by its bitwise definition; a node is the hash of its path.
ORACLES["op11_prefix_trie"] = """
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), lengths AS (
  SELECT conv_id, count(*) AS length FROM turns GROUP BY conv_id
), digits AS (
  SELECT conv_id, [ord(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')] AS codes, 1 AS i, CAST(4294967295 AS BIGINT) AS crc
  FROM lengths
  UNION ALL
  SELECT conv_id, codes, i + 1,
    list_reduce([xor(crc, codes[i])] || [CAST(0 AS BIGINT) FOR b IN range(8)],
      LAMBDA c, b: xor(c >> 1, (c & 1) * 3988292384))
  FROM digits WHERE i <= len(codes)
), plans AS (
  SELECT d.conv_id, xor(d.crc, 4294967295) % 9 AS wanted, d.conv_id - d.conv_id % 5 AS base
  FROM digits d WHERE d.i = len(d.codes) + 1
), taken AS (
  SELECT p.*, least(p.wanted, coalesce(l.length, 0)) AS taken FROM plans p LEFT JOIN lengths l ON l.conv_id = p.base
), rebuilt AS (
  SELECT p.conv_id, t.place, t.role, t.text FROM taken p JOIN turns t ON t.conv_id = p.base AND t.place <= p.wanted
  UNION ALL
  SELECT p.conv_id, t.place - p.wanted + p.taken, t.role, t.text FROM taken p JOIN turns t ON t.conv_id = p.conv_id AND t.place > p.wanted
), digested AS (
  SELECT conv_id, place, strlen(text) AS bytes, sha256(len(role) || ':' || role || text) AS digest FROM rebuilt
), sized AS (
  SELECT l.conv_id, count(d.place) AS length FROM lengths l LEFT JOIN digested d ON d.conv_id = l.conv_id GROUP BY l.conv_id
), steps AS (
  SELECT conv_id, 0 AS depth, '' AS node, CAST(NULL AS VARCHAR) AS parent, CAST(0 AS BIGINT) AS bytes FROM lengths
  UNION ALL
  SELECT s.conv_id, s.depth + 1, sha256(s.node || d.digest), s.node, d.bytes
  FROM steps s JOIN digested d ON d.conv_id = s.conv_id AND d.place = s.depth + 1
), nodes AS (
  SELECT node, depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended) AS ends
  FROM (SELECT s.*, z.length = s.depth AS ended FROM steps s JOIN sized z USING (conv_id))
  GROUP BY node, depth
), children AS (
  SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
), counted AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.node
), totals AS (
  SELECT a.node, count(*) FILTER (WHERE c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.bytes) AS saved
  FROM counted c JOIN steps a ON a.conv_id = c.conv_id AND a.depth <= c.depth
  GROUP BY a.node
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, t.n_leaves,
       CAST(t.saved AS BIGINT) AS saved_tokens, sha256(coalesce(c.ends, '')) AS ends_sha256
FROM counted c JOIN totals t ON t.node = c.node LEFT JOIN nodes p ON p.node = c.parent
"""
