"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.llm import (
    bpe,
    chunk_dedup,
    clustering,
    decontaminate,
    language,
    lexical_search,
    line_dedup,
    lm,
    pii,
    sharding,
    simhash,
    token_counts,
    token_files,
)
from voltlake.llm.common import documents


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer()
    return bpe.digests(bpe.decode(bpe.encode(documents(spark, sf_dir), path), path))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(documents(spark, sf_dir), tokenizer()).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.learn(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def op5_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.copy_groups(documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer())


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(documents(spark, sf_dir))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_sharding": op2_sharding,
    "op3_token_files": op3_token_files,
    "op4_pii": op4_pii,
    "op5_chunk_dedup": op5_chunk_dedup,
    "op6_simhash": op6_simhash,
    "op7_token_counts": op7_token_counts,
    "op8_decontaminate": op8_decontaminate,
    "op9_pitman_yor": op9_pitman_yor,
    "op10_language": op10_language,
    "op11_clustering": op11_clustering,
    "op12_lexical_search": op12_lexical_search,
    "op13_line_dedup": op13_line_dedup,
}

# The check sum by its defining recurrence; the shard by the middle byte of each row.
OP2_SQL = """
WITH RECURSIVE
steps AS (
  SELECT i AS byte, i::BIGINT AS crc, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END, k + 1
  FROM steps WHERE k < 8
),
crc_table AS (SELECT list(crc ORDER BY byte) AS entries FROM steps WHERE k = 8),
sized AS (
  SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS digits
  FROM documents
),
summed AS (
  SELECT doc_id, size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(digits, '..'), lambda pair: ('0x' || pair)::BIGINT)),
      lambda crc, byte: xor(crc >> 8, entries[(xor(crc, byte) & 255) + 1])
    ), 4294967295::BIGINT)::BIGINT AS text_crc32
  FROM sized, crc_table
),
placed AS (
  SELECT *, (2 * sum(size) OVER (ORDER BY doc_id) - size) * 16 // (2 * sum(size) OVER ()) AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""

OP5_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# Vectors and centroids in long form, a row for each component; one step for each round.
OP11_START = """
WITH
vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
long AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM vectors),
starts AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR)) - 1 AS cluster
  FROM vectors QUALIFY cluster < 40
),
centroids_0 AS (SELECT cluster, k, x AS c FROM starts JOIN long USING (vec_id)),
"""
OP11_ROUND = """
nearest_{r} AS (
  SELECT vec_id, min(distance * 64 + cluster) % 64 AS cluster, min(distance) AS distance
  FROM (
    SELECT vec_id, cluster, sum((x - c) * (x - c))::BIGINT AS distance
    FROM long JOIN centroids_{r} USING (k) GROUP BY vec_id, cluster
  ) GROUP BY vec_id
),
"""
OP11_MOVE = """
sums_{r} AS (
  SELECT cluster, k, sum(x)::BIGINT AS s, count(*) AS n FROM nearest_{r} JOIN long USING (vec_id) GROUP BY cluster, k
),
centroids_{next} AS (
  SELECT cluster, k, coalesce((s - ((s % n + n) % n)) // n, c) AS c
  FROM centroids_{r} LEFT JOIN sums_{r} USING (cluster, k)
),
"""
OP11_END = """
digests AS (
  SELECT cluster, sha256(string_agg(c::VARCHAR, ',' ORDER BY k)) AS centroid_sha256 FROM centroids_5 GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM nearest_5 JOIN digests USING (cluster)
"""
OP11_SQL = "".join(
    [
        OP11_START,
        *(OP11_ROUND.format(r=r) + OP11_MOVE.format(r=r, next=r + 1) for r in range(5)),
        OP11_ROUND.format(r=5),
        OP11_END,
    ]
)

OP12_SQL = r"""
WITH
terms AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term
),
bases AS (SELECT doc_id, 12 * (100 - 25 + (25 * n * docs) // total) AS base FROM lengths, totals),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + base)))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN bases USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 20
"""

OP13_SQL = r"""
WITH
split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
repeated AS (
  SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> stays, false) AS dropped FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES: dict[str, str] = {
    "op2_sharding": OP2_SQL,
    "op5_chunk_dedup": OP5_SQL,
    "op11_clustering": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
