"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import (
    byte_bpe, chat_preference, clusters, embedding_dedup, language, lexical, mixing, pii, quality, simhash, suffix_dedup,
    token_counts, topk,
)
from plantlake.llm.shared import remainder
from plantlake.llm.twins import NEW_SQL

LIMIT_TOKENS = 2048
GOOD = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(by: int, which: int):
    return F.coalesce(remainder("doc_id", by) == which, F.lit(False))


def op1_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    chosen = turns.select(turns["conv_id"].alias("pair_id"), "turn", "role", "text")
    return chat_preference.preference_segments(chosen, chat_preference.with_swapped_ends(chosen))


def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op3_gray_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), length=3, distance=2)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, remainder("doc_id", 5) != 0)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")


def op5_ranked_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT_TOKENS).alias("over_limit"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = mixing.mix_counts(table(spark, sf_dir, "documents"))
    return counts.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op7_histogram_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, factor=256.0)


def op8_int8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_forced_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    decoded = byte_bpe.decode(encoded, path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def of_kind(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    base = of_kind(*pii.BASE_KINDS)
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = clusters.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64.0, seed="1")
    digests = F.array(*[F.lit(clusters.fingerprint(c)) for c in centroids]) if centroids else F.array(F.lit(""))
    return found.withColumn("centroid_sha256", digests[F.col("cluster")])


def op13_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=10)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_preference_format, op2_subword_quality, op3_gray_simhash, op4_ppm_language, op5_ranked_token_counts,
        op6_pareto_mix, op7_histogram_top_k, op8_int8_near_vectors, op9_suffix_repeats, op10_forced_boundary_bpe,
        op11_anchor_expansion, op12_centroid_clusters, op13_document_scan,
    )
}

OP1_SQL = """
WITH last_turn AS (
  SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id),
rejected AS (
  SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = l.turn THEN n.text ELSE c.text END AS text
  FROM conversations c JOIN last_turn l USING (conv_id) LEFT JOIN last_turn n ON n.conv_id = l.conv_id + 1
  WHERE c.turn < l.turn OR n.conv_id IS NOT NULL),
sided AS (
  SELECT DISTINCT conv_id, turn, role, text, 'chosen' AS part FROM conversations
  UNION ALL SELECT DISTINCT conv_id, turn, role, text, 'rejected' FROM rejected),
prefix AS (
  SELECT conv_id, min(turn) AS cut FROM (
    SELECT conv_id, turn FROM sided GROUP BY conv_id, turn, role, text HAVING count(*) < 2)
  GROUP BY conv_id),
placed AS (
  SELECT s.*, coalesce(s.turn < p.cut, true) AS shared FROM sided s LEFT JOIN prefix p USING (conv_id))
SELECT DISTINCT conv_id AS pair_id, CASE WHEN shared THEN 'prompt' ELSE part END AS part, turn, role,
  '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS segment,
  NOT shared AND coalesce(role, '') = 'assistant' AS trained
FROM placed
"""

OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight,
    2.0::DOUBLE * source_size AS full_size
  FROM totals),
levels AS (
  SELECT *, row_number() OVER filling AS place,
    (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(full_size) OVER (filling ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (filling ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW filling AS (ORDER BY full_size / weight, source NULLS LAST)),
opening AS (SELECT min(place) AS place FROM levels WHERE level <= full_size / weight OR place = (SELECT max(place) FROM levels)),
targets AS (
  SELECT source, source_size, CASE WHEN l.place < o.place THEN full_size
    ELSE least((SELECT level FROM levels WHERE place = o.place) * weight, full_size) END AS target
  FROM levels l, opening o),
classes AS (
  SELECT source, length(bin(greatest(size, 1))) - 1 AS class, CAST(sum(size) AS BIGINT) AS words,
    8.0::DOUBLE / (8.0::DOUBLE + length(bin(greatest(size, 1))) - 1) AS preferred
  FROM sized GROUP BY ALL HAVING sum(size) > 0),
tried AS (
  SELECT t.*, class, words, preferred, lead(class) OVER by_class IS NULL AS final,
    (target - 2.0::DOUBLE * coalesce(sum(words) OVER (by_class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(preferred * words) OVER (by_class ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW by_class AS (PARTITION BY c.source ORDER BY class)),
source_level AS (
  SELECT source, arg_min(level, class) AS level FROM tried WHERE level * preferred <= 2 OR final GROUP BY source),
expected AS (
  SELECT doc_id, size, u, t.source, source_size, target,
    CASE WHEN source_size = 0 THEN 0 WHEN target >= 2.0::DOUBLE * source_size THEN 2.0::DOUBLE
      ELSE least(2.0::DOUBLE, l.level * (8.0::DOUBLE / (8.0::DOUBLE + length(bin(greatest(size, 1))) - 1))) END AS copies
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN source_level l ON l.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT doc_id, size, source, source_size, target, floor(copies) AS whole,
    target - sum(floor(copies) * size) OVER (PARTITION BY source) AS rest,
    CASE WHEN copies > floor(copies) THEN (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS rank
  FROM expected),
drawn AS (
  SELECT *, rank IS NOT NULL AND sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2.0 <= rest AS taken_once
  FROM ranked)
SELECT doc_id, size, source_size, target, CAST((whole + CAST(taken_once AS INTEGER)) * size AS BIGINT) AS taken FROM drawn
"""

OP7_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER best <= 5
"""

OP8_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS one, b.vec_id AS two FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id AS start, vec_id AS there FROM embeddings
  UNION SELECT r.start, l.two FROM reach r JOIN link l ON r.there = l.one),
component AS (SELECT start, min(there) AS component_id FROM reach GROUP BY start),
degree AS (SELECT one, count(*) AS n FROM link GROUP BY one)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.start = e.vec_id LEFT JOIN degree d ON d.one = e.vec_id
"""

LLM_SQL = {
    "op1_preference_format": OP1_SQL, "op6_pareto_mix": OP6_SQL, "op7_histogram_top_k": OP7_SQL, "op8_int8_near_vectors": OP8_SQL,
} | NEW_SQL
