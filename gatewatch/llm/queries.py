"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm import (decontamination, neighbours, ngram_lm, pieces, quality, resampling,
                           sequences, sharding, simhash, substrings, tokens, toxicity,
                           whitening)
from gatewatch.llm.common import fold, table

MAX_TOKENS = 1024
WINDOW_WORDS = 10
QUERY_STEP, NEIGHBOURS = 20, 20
TOXIC, GOOD = 0.7, 0.3
SHARDS, SIZE_EXTRA = 24, 8
SHINGLE_WORDS, MAX_BITS = 3, 2
COMPONENTS = 32
CAPACITY, END_ID = 2048, 0

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
            .select("doc_id", "n_bytes", "n_tokens",
                    (F.col("n_tokens") > MAX_TOKENS).alias("over_limit")))


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (sharding.text_size(F.col("text")) + SIZE_EXTRA).alias("size"),
        sharding.text_crc32(F.col("text")).alias("text_crc32"))
    return sharding.shuffle_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


# CRC-32 byte by byte: the table of 256 remainders comes from its rule.
CRC32_SQL = """
WITH remainders AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1
      THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c FROM range(256) r(i)))
SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size,
  xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: ('0x' || h)::BIGINT),
    lambda a, b: xor(crc[xor(a, b) % 256 + 1], a // 256), 4294967295::BIGINT),
    4294967295) AS text_crc32
FROM documents, remainders"""

OP2_SQL = f"""
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard, slot,
  NULL::INTEGER AS grown_shard
FROM ({sharding.shards_sql(CRC32_SQL, 'doc_id NULLS FIRST, size, text_crc32',
                           "coalesce(doc_id::VARCHAR, '~') || ',' || size || ',' || text_crc32",
                           SHARDS)})"""


def op3_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def toxicity_model(docs: DataFrame, sf_dir: str) -> toxicity.Machine:
    """Fitted on labels outside the held-out third."""
    labels = table(docs.sparkSession, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    return toxicity.fit(docs, labels, "doc_id", "text", "toxic")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity_model(docs, sf_dir)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"), WINDOW_WORDS)
    return decontamination.report(found.drop("text"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"),
                              F.col("id") % QUERY_STEP == 0, NEIGHBOURS)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_lm.score_texts(docs, fold("doc_id", 5) != 1).select(
        "doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text",
                                   SHINGLE_WORDS, MAX_BITS)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    return quality.learn_and_score(table(spark, sf_dir, "documents"), labels).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.report(substrings.find_repeats(docs)).drop("text")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=COMPONENTS)


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sequences.cut_documents(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"), CAPACITY,
                                     END_ID)
    return sequences.pack(pieces, settings=sequences.Settings(capacity=CAPACITY))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))


# Words of a text: A-Z in lower case, all other ASCII but digits and letters parts them.
WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP5_SQL = """WITH doc_words AS (SELECT doc_id, {words} AS w FROM documents),
item_words AS (
  SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {words} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), {w}) AS n, array_to_string(w[k:k + least(len(w), {w}) - 1], ' ') AS window_text
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {w1}, 1) + 1)) AS k FROM item_words WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS window_text
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM doc_words, (SELECT DISTINCT n FROM item_windows))),
hits AS (SELECT doc_id, item, k, n FROM doc_windows JOIN item_windows USING (n, window_text)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""".format(words=WORDS_SQL, w=WINDOW_WORDS, w1=WINDOW_WORDS - 1)

OP10_SQL = """WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
windows AS (
  SELECT doc_id, k, data[k:k + 99] AS part
  FROM (SELECT doc_id, data, unnest(range(1, octet_length(data) - 98)) AS k FROM docs)),
again AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, k) AS place FROM windows)
  WHERE place > 1),
runs AS (
  SELECT doc_id, min(k) AS first, max(k) + 99 AS last FROM (
    SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM (
      SELECT doc_id, k, CASE WHEN k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) <= 100 THEN 0 ELSE 1 END AS new
      FROM again))
  GROUP BY doc_id, run),
cuts AS (SELECT doc_id, list(struct_pack(first := first, last := last) ORDER BY first) AS cuts FROM runs GROUP BY doc_id)
SELECT doc_id, octet_length(data)::BIGINT AS n_bytes,
  coalesce(list_sum([x.last - x.first + 1 for x in cuts]), 0)::BIGINT AS n_removed,
  coalesce(len(cuts), 0)::BIGINT AS n_spans,
  sha256(CASE WHEN cuts IS NULL THEN data ELSE unhex(array_to_string(list_transform(range(0, len(cuts) + 1),
    lambda i: hex(data[(CASE WHEN i = 0 THEN 1 ELSE cuts[i].last + 1 END):
                       (CASE WHEN i = len(cuts) THEN octet_length(data) ELSE cuts[i + 1].first - 1 END)])), '')) END) AS kept_sha256
FROM docs LEFT JOIN cuts USING (doc_id)"""


# The remainders of CRC32_SQL, here for distinct words.
OP13_SQL = f"""
WITH remainders AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(8), lambda a, k: CASE WHEN a % 2 = 1
      THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c FROM range(256) r(i))),
doc_words AS (SELECT row_number() OVER () AS line, doc_id, {WORDS_SQL} AS w FROM documents),
words AS (SELECT line, unnest(w) AS word FROM doc_words),
item_words AS (SELECT unnest({WORDS_SQL}) AS word FROM benchmark),
counts AS (
  SELECT word, sum(s) AS s, sum(t) AS t FROM (
    SELECT word, 1 AS s, 0 AS t FROM words UNION ALL SELECT word, 0, 1 FROM item_words)
  GROUP BY word),
hashed AS (
  SELECT word, s, t, xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::BIGINT),
    lambda a, b: xor(crc[xor(a, b) % 256 + 1], a // 256), 4294967295::BIGINT),
    4294967295) % 10000 AS bucket
  FROM counts, remainders),
gains AS (
  SELECT bucket, floor(1000 * ln((sum(t) + 1)::DOUBLE * (max(all_s) + 10000)::DOUBLE
    / ((sum(s) + 1)::DOUBLE * (max(all_t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM hashed, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts) GROUP BY bucket),
weights AS (
  SELECT line, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word)
  JOIN gains USING (bucket) GROUP BY line),
scored AS (
  SELECT line, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:'
      || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT
      AS score
  FROM doc_words LEFT JOIN weights USING (line)),
ranks AS (
  SELECT line, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    10 * count(*) OVER () // 100 AS take
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= take THEN place END AS rank
FROM scored LEFT JOIN ranks USING (line)"""


def queries() -> dict[str, Query]:
    found = [op1_token_counts, op2_feistel_shards, op3_piece_round_trip, op4_toxicity,
             op5_decontamination, op6_neighbours,
             op7_language_model, op8_simhash, op9_quality, op10_suffix_dedup,
             op11_whitening, op12_best_fit_packing, op13_importance_resampling]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_feistel_shards": OP2_SQL, "op5_decontamination": OP5_SQL,
            "op10_suffix_dedup": OP10_SQL, "op13_importance_resampling": OP13_SQL}
