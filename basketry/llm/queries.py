"""Queries of this subpackage, one per operator and the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    backoff,
    chat,
    decontaminate,
    exact_dedup,
    license_scan,
    mixing,
    near_dup,
    quality_rules,
    ranking,
    secret_scan,
    token_alignment,
    token_files,
    turn_repair,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents"))


@query
def op9_chat(spark, sf_dir):
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(given.unionByName(own))


CHECKS["op9_chat"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, row_number() OVER w - 1 AS place, coalesce(lag(role) OVER w, 'start') AS before
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), marked AS (
  SELECT *,
    CASE role WHEN 'system' THEN 8 + 10 WHEN 'user' THEN 7 + 9 WHEN 'assistant' THEN 4 + 6
      ELSE 8 + length(role) + 9 + length(regexp_replace(role, '[^<\\[\\\\]', '', 'g')) END AS marks,
    length(text) + length(regexp_replace(text, '[^<\\[\\\\]', '', 'g')) AS chars,
    before || '>' || role IN
      ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') AS allowed
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(marks + chars) AS BIGINT) AS formatted_chars,
  bool_and(allowed) AS valid, min(place) FILTER (NOT allowed) AS first_error
FROM marked GROUP BY conv_id"""


@query
def op10_mixing(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


CHECKS["op10_mixing"] = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS position
  FROM sized GROUP BY source
), capped AS (
  SELECT *, [5.0, 2.0, 1.0][CAST((position - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
    1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total
  FROM sources
), shared AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
    row_number() OVER (ORDER BY cap / weight, position) AS rank
  FROM capped
), goals AS (
  SELECT source, source_size,
    least(cap, weight * coalesce((SELECT arg_min(level, rank) FROM shared WHERE level * weight < cap), 'inf'::DOUBLE)) AS target,
    CAST('0x' || substr(md5('7:' || coalesce('=' || source, 'null')), 1, 5) AS BIGINT) / 1048576.0::DOUBLE AS u
  FROM shared
), ranked AS (
  SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS r
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(u + rate * r) - floor(u + rate * (r - 1))) AS BIGINT) AS taken
FROM ranked"""


@query
def op3_secrets(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_licenses(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return quality_rules.judge(table(spark, sf_dir, "documents"), quality_rules.trusted_ids(labels))


@query
def op8_quality_ranking(spark, sf_dir):
    return ranking.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


CHECKS["op2_near_duplicates"] = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (shingle) GROUP BY ALL
), links AS (
  SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * s.n >= 85 * (a.n + b.n - s.n)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
), classes AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN classes c ON c.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""


@query
def op6_backoff(spark, sf_dir):
    found = backoff.scores(table(spark, sf_dir, "documents"))
    return found.withColumn("score", F.round("score", 6))


CHECKS["op6_backoff"] = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), words AS (SELECT r, len(w) AS n, unnest(w) AS z, generate_subscripts(w, 1) AS pos FROM texts),
grams AS (SELECT *, lag(z) OVER (PARTITION BY r ORDER BY pos) AS y, lag(z, 2) OVER (PARTITION BY r ORDER BY pos) AS x FROM words),
others AS (
  SELECT r, pos, n, least(pos, 3) AS longest,
    count(*) OVER (PARTITION BY z) - count(*) OVER (PARTITION BY r, z) AS n1,
    CASE WHEN pos > 1 THEN count(*) OVER (PARTITION BY y, z) - count(*) OVER (PARTITION BY r, y, z) ELSE 0 END AS n2,
    CASE WHEN pos > 2 THEN count(*) OVER (PARTITION BY x, y, z) - count(*) OVER (PARTITION BY r, x, y, z) ELSE 0 END AS n3
  FROM grams
), contexts AS (
  SELECT *, lag(n1) OVER (PARTITION BY r ORDER BY pos) AS c1, lag(n2) OVER (PARTITION BY r ORDER BY pos) AS c2,
    CASE WHEN n3 > 0 THEN 3 WHEN n2 > 0 THEN 2 WHEN n1 > 0 THEN 1 ELSE 0 END AS reached
  FROM others
), scored AS (
  SELECT r, (longest - reached) * log10(0.4::DOUBLE) + CASE reached WHEN 3 THEN log10(n3::DOUBLE) - log10(c2::DOUBLE)
      WHEN 2 THEN log10(n2::DOUBLE) - log10(c1::DOUBLE) WHEN 1 THEN log10(n1::DOUBLE) - log10(((SELECT count(*) FROM words) - n)::DOUBLE)
      ELSE -log10((SELECT count(*) FROM words)::DOUBLE) END AS s,
    CAST(reached < longest AS INTEGER) AS missed, CAST(reached = 0 AS INTEGER) AS unseen
  FROM contexts
)
SELECT doc_id, len(w) AS n_words, coalesce(round(sum(s), 6), 0) AS score, CAST(coalesce(sum(missed), 0) AS BIGINT) AS n_backoff,
  CAST(coalesce(sum(unseen), 0) AS BIGINT) AS n_unseen
FROM texts LEFT JOIN scored USING (r) GROUP BY r, doc_id, w"""


@query
def op4_decontamination(spark, sf_dir):
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("node")


@query
def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


CHECKS["op12_exact_dedup"] = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN groups USING (text)"""


@query
def op13_token_alignment(spark, sf_dir):
    return token_alignment.alignment(table(spark, sf_dir, "documents"))


@query
def op11_turn_repair(spark, sf_dir):
    return turn_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


CHECKS["op11_turn_repair"] = """
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), summed AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 20 AS fault
  FROM keyed
), rows AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM summed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said,
    role[1] AS initial
  FROM rows
), faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'ok' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS last
  FROM faults GROUP BY conv_id
), next AS (SELECT * FROM (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS t(s, nxt, as_role)),
kept AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) AS t(s, letter, nxt)),
paths AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'done': ''} AS best FROM counts
  UNION ALL
  SELECT conv_id, pos, s, min(best) FROM (
    WITH open AS (
      SELECT conv_id, pos, s, best FROM paths
      UNION ALL
      SELECT conv_id, pos, nxt, {'cost': best.cost + 5, 'audit': best.audit || 'I', 'done': best.done || as_role || ':' || chr(10)}
      FROM paths JOIN next USING (s)
      UNION ALL
      SELECT conv_id, pos, b.nxt, {'cost': best.cost + 10, 'audit': best.audit || 'II',
        'done': best.done || a.as_role || ':' || chr(10) || b.as_role || ':' || chr(10)}
      FROM paths JOIN next a USING (s) JOIN next b ON b.s = a.nxt
    ), step AS (SELECT o.conv_id, f.pos, o.s, o.best, f.fault, f.initial, f.role, f.text, CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
      FROM open o JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.pos = o.pos + 1)
    SELECT conv_id, pos, s, {'cost': best.cost + 2, 'audit': best.audit || 'D', 'done': best.done} AS best FROM step
    UNION ALL
    SELECT conv_id, pos, nxt, {'cost': best.cost + 1 + more, 'audit': best.audit || 'R', 'done': best.done || as_role || ':' || text || chr(10)}
    FROM step JOIN next USING (s) WHERE fault IN ('ok', 'truncated')
    UNION ALL
    SELECT conv_id, pos, nxt, {'cost': best.cost + more, 'audit': best.audit || 'K', 'done': best.done || role || ':' || text || chr(10)}
    FROM step JOIN kept USING (s) WHERE letter = initial AND fault IN ('ok', 'truncated')
  ) GROUP BY conv_id, pos, s
), ends AS (
  SELECT p.conv_id, min(CASE s WHEN 1 THEN {'cost': best.cost + 10, 'audit': best.audit || 'II', 'done': best.done || 'user:' || chr(10) || 'assistant:' || chr(10)}
    WHEN 2 THEN {'cost': best.cost + 5, 'audit': best.audit || 'I', 'done': best.done || 'assistant:' || chr(10)} ELSE best END) AS best
  FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.pos = c.last GROUP BY p.conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost, coalesce(e.best.audit, '') AS audit,
  sha256(coalesce(e.best.done[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM i.conv_id"""
