"""The operators as registered queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.llm import fingerprints, hmm, language_id, license_scan, line_dedup, mixing, periodic_runs, prefix_trie, sentencepiece_codec, sharding, topk, toxicity
from watchspan.llm.common import documents, fold, small_batches
from watchspan.llm.near_dedup import near_groups

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of two thirds of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs.filter(fold("doc_id", 3) != 1), labels)
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"),
        F.size("toxic_passages").alias("n_passages"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by jump consistent hashing."""
    return sharding.shard_by_key(documents(spark, sf_dir), 24)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence passages of all documents: how many match, and the best licence (ties to the name first in order)."""
    found = license_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    best = F.array_min(F.transform("license_matches", lambda m: F.struct((-m["score"]).alias("minus"), m["license"].alias("license"))))
    return found.select("doc_id", F.size("license_matches").cast("long").alias("n_matches"), best.alias("best")).select(
        "doc_id", "n_matches", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score")
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three quarters of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(fold("doc_id", 4) != 2))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def quality_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, or by quality good or poor."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for a mixture of 80 % good, 19 % poor and 1 % toxic tokens."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    mixed, model = mixing.mix(docs, quality_domains(spark, sf_dir), {"good": 0.8, "poor": 0.19, "toxic": 0.01})
    top = F.array_position("mix_posteriors", F.array_max("mix_posteriors")).cast("int")
    return mixed.select(
        "doc_id", F.col("mix_tokens").alias("n_tokens"), F.element_at(F.lit(model.domains), top).alias("domain"),
        F.array_max("mix_posteriors").alias("posterior"), F.col("mix_rate").alias("rate"), F.col("mix_copies").alias("copies"),
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the text they decode to, as digests."""
    model = sentencepiece_codec.read_model(PIECES)
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model).select("doc_id", "ids"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows of the whole table for every row whose id is divisible by 100."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


def op8_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of all documents, learned from four fifths of them."""
    return hmm.score(documents(spark, sf_dir), fold("doc_id", 5) == 1)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on four-word shingles."""
    return near_groups(documents(spark, sf_dir), words=4, percent=80)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, compared with an edited version and with the next document."""
    small_batches(spark)
    docs = fingerprints.with_next(documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    docs = docs.withColumn("n_chars", F.length("text")).withColumn("half", half)
    docs = docs.withColumn("edited", F.expr("concat(substring(text, 1, n_chars - half), substring(next_text, 1, half))"))
    docs = docs.withColumn("edited_sha256", F.sha2("edited", 256)).drop("half")
    edited = fingerprints.compare(docs, "text", "edited", "e_", digests=False).drop("edited")
    both = fingerprints.compare(edited, "text", "next_text", "n_", digests=False)
    return both.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        F.col("e_fingerprint_left").alias("fingerprint"),
        F.col("e_fingerprint_right").alias("edited_fingerprint"),
        F.col("e_likeness").alias("near_edited"),
        F.col("n_likeness").alias("near_next"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that blocks of them share their first turns."""
    turns = prefix_trie.ordered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(turns))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic stretches of words of all documents, some of which are given one."""
    return periodic_runs.digests(periodic_runs.find_runs(documents(spark, sf_dir), change=periodic_runs.planted))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that other documents keep, as digests."""
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_license_scan": op3_license_scan,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_hmm_scoring": op8_hmm_scoring,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}

_TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
terms AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM terms q JOIN terms c USING (i) WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 10"""

_TRIE_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, md5(strlen(r) || ':' || r || x) AS m,
         len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, {sharding.crc32_sql("encode(conv_id::VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, t.p, t.m, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL SELECT c.conv_id, 1, t.p, t.m, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, words, md5(string_agg(m, ',') OVER w) AS name FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
sized AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS size, min(conv_id) OVER (PARTITION BY depth, name) AS top FROM steps),
nodes AS (
  SELECT top, depth, count(*) AS n_convs, max(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM sized GROUP BY top, depth),
linked AS (
  SELECT n.*, s.top AS parent, (SELECT count(*) FROM nodes k JOIN sized q ON q.conv_id = k.top AND q.depth = k.depth - 1 WHERE q.top = n.top AND q.depth = n.depth) AS n_children
  FROM nodes n LEFT JOIN sized s ON s.conv_id = n.top AND s.depth = n.depth - 1),
under AS (
  SELECT s.top, s.depth, sum((l.n_convs - 1) * l.words) AS saved_tokens, count_if(l.n_children = 0) AS n_leaves
  FROM linked l JOIN sized s ON s.conv_id = l.top AND s.depth <= l.depth GROUP BY ALL)
SELECT l.top AS conv_id, l.depth::BIGINT AS depth, l.parent AS parent_conv_id, l.n_convs, l.n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, l.ends_sha256
FROM linked l JOIN under u ON u.top = l.top AND u.depth = l.depth"""

_NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM words),
named AS (SELECT doc_id, s, len(s) AS n, md5(array_to_string(s, chr(10))) AS class FROM sets),
classes AS (SELECT class, any_value(s) AS s, any_value(n) AS n, min(doc_id) AS low FROM named WHERE n > 0 GROUP BY class),
held AS (SELECT class, n, unnest(s) AS g FROM classes),
shared AS (SELECT a.class AS a, b.class AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM held a JOIN held b ON a.g = b.g AND a.class <> b.class GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
reach(class, other) AS (SELECT class, class FROM classes UNION SELECT r.class, l.b FROM reach r JOIN links l ON l.a = r.other),
lowest AS (SELECT r.class, min(c.low) AS low FROM reach r JOIN classes c ON c.class = r.other GROUP BY r.class)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE low END AS component_id, doc_id = CASE WHEN n = 0 THEN doc_id ELSE low END AS kept
FROM named LEFT JOIN lowest USING (class)"""

ORACLES: dict[str, str] = {
    "op2_sharding": sharding.sharding_sql(24),
    "op3_license_scan": license_scan.license_sql(),
    "op7_exact_top_k": _TOP_K_SQL,
    "op9_minhash_near_dedup": _NEAR_SQL,
    "op11_prefix_trie": _TRIE_SQL,
    "op13_line_dedup": line_dedup.lines_sql(),
}
