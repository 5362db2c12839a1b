"""The queries opN_<name> over the supplied tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uiloom.llm import bpe, divergence, jaccard, langid, mixing, neighbours, outliers, packing, phrases, pii, sharding, toxicity, trie
from uiloom.llm.common import crc_mod, table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summarise(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    taught = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")
    own = toxicity.fit(docs, taught)
    scored = toxicity.score(docs, own)
    return scored.select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])).alias("offsets"),
    )


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, "vec_id", "embedding", 10)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    taught = docs.where(~held_out)
    filters = langid.fit(taught, "lang", "text", "doc_id")
    inputs = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.identify(inputs, filters).select("doc_id", "held_out", "lang_pred", "score")


#: Domains are read from the labels; the targets are shares of all tokens.
TARGETS = {"good": 0.6, "plain": 0.35, "toxic": 0.05}


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixing learns from: words of a sample of the labelled documents, with their domains."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("plain")
    return mixing.labelled_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, labelled_domains(spark, sf_dir), TARGETS, carry=["doc_id"])
    return mixed.select("doc_id", "n_tokens", *(f"p_{name}" for name in TARGETS), "rate")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(phrases.remove_recurring(table(spark, sf_dir, "documents"), window=35))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.shard_records(rows, "doc_id", [1.0] * 40, grown_weight=1.0)
    numbered = sharding.number_slots(placed, ["doc_id", "text_crc32", "size"])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"), size=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), "lang", "source", "text")


#: The same sums, by all pairs of sources and all kept terms.
OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), occurrences AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term FROM occurrences GROUP BY ALL HAVING count(DISTINCT row_id) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), kept_n AS (
  SELECT lang, source, term, count(*) AS n FROM occurrences SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sized AS (
  SELECT g.lang, g.source, coalesce(sum(k.n), 0)::HUGEINT AS total FROM groups g LEFT JOIN kept_n k USING (lang, source) GROUP BY ALL
), langs AS (
  SELECT s.lang, s.total, (SELECT count(*) FROM kept k WHERE k.lang = s.lang)::HUGEINT AS v
  FROM (SELECT lang, sum(total)::HUGEINT AS total FROM sized GROUP BY lang) s
), lang_n AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM kept_n GROUP BY ALL
), weights AS (
  SELECT s.lang, s.source, k.term, coalesce(n.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 5)) // (s.total + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (ln.n + 5)) // (l.total + 5 * l.v) AS q
  FROM sized s JOIN langs l USING (lang) JOIN kept k USING (lang) JOIN lang_n ln USING (lang, term)
  LEFT JOIN kept_n n ON n.lang = s.lang AND n.source = s.source AND n.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM weights x JOIN weights y USING (lang, term)
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank
    FROM weights WHERE n > 0 AND p > q) WHERE rank <= 50
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked
"""


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    # a sequence holds one piece, which starts it
    return packed.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(table(spark, sf_dir, "conversations"))


#: Every node by every conversation that starts with it; crc32 is written out, bit by bit.
OP13_SQL = """
WITH turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars, turn, coalesce(role, '') AS role,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, role, k) AS ks, list(chars ORDER BY turn NULLS FIRST, role, k) AS cs
  FROM turns GROUP BY conv_id
), taken AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
              lambda ch: [ord(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
              lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384)), 4294967295::BIGINT) % 6 AS h
  FROM own
), rebuilt AS (
  SELECT t.conv_id, list_concat(coalesce(f.ks, [])[1:t.h], t.ks[t.h + 1:]) AS ks, list_concat(coalesce(f.cs, [])[1:t.h], t.cs[t.h + 1:]) AS cs
  FROM taken t LEFT JOIN own f ON f.conv_id = t.conv_id - t.conv_id % 100
), starts AS (
  SELECT conv_id, ks, cs, unnest(range(0, len(ks) + 1)) AS depth FROM rebuilt
), nodes AS (
  SELECT ks[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(cs[depth]), 0) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ks) = depth), '')) AS ends_sha256
  FROM starts GROUP BY 1, 2
), counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children FROM nodes n
), ways AS (
  SELECT path, n_children, (n_convs - 1) * chars AS saved, unnest(range(0, depth + 1)) AS k FROM counted
), sums AS (
  SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM ways GROUP BY 1
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs, c.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.path = c.path LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
"""


QUERIES = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_mixing": op6_mixing,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_packing": op12_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

#: For the others SQL can't express the operator; tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {"op11_divergence_audit": OP11_SQL, "op13_prefix_trie": OP13_SQL}
