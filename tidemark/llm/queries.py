"""The registered queries of this package, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, infill, mixing, near_dedup, pii, repair, secrets, topk, url_filter
from tidemark.llm import language as tongue
from tidemark.llm import quality as good
from tidemark.llm import toxicity as toxic
from tidemark.llm.common import read, sha256_text

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return register


@query("op1_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
placed AS (
  SELECT *, 3 * source_size AS cap,
         CAST(sum(source_size) OVER () AS BIGINT) AS total,
         row_number() OVER (ORDER BY CAST(source_size AS DOUBLE) / weight, source ASC NULLS LAST) AS fill
  FROM sources),
capped AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS BIGINT) * weight
            > cap * CAST(sum(weight) OVER (ORDER BY fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                         AS BIGINT) AS is_capped
  FROM placed),
targets AS (
  SELECT source, source_size, total,
         CASE WHEN is_capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * (total - coalesce(sum(CASE WHEN is_capped THEN cap END) OVER (), 0)) AS DOUBLE)
                   / CAST(sum(CASE WHEN NOT is_capped THEN weight END) OVER () AS DOUBLE) END AS target
  FROM capped),
queued AS (
  SELECT s.*, t.source_size, t.target, t.total,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size
                              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(epoch * source_size + sent AS DOUBLE) / target ELSE 0.0 END AS finish
  FROM queued, (VALUES (0), (1), (2)) AS e(epoch)),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, shuffled, doc_id, size
                            ROWS UNBOUNDED PRECEDING) <= total AS fits
  FROM entries)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN fits THEN size ELSE 0 END) AS BIGINT) AS taken
FROM cut GROUP BY doc_id, source, size, source_size, target, sent
""")
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_decisions(read(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op4_exact_dedup", r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS line FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY line) AS keep_id,
       count(*) OVER (PARTITION BY line) AS group_size,
       row_number() OVER (PARTITION BY line ORDER BY doc_id) = 1 AS kept, sha256(line) AS text_sha256
FROM plain
""")
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup_decisions(read(spark, folder, "documents"))


@query("op8_topk", r"""
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
cells AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM ints),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM cells q JOIN cells c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings").select(
        "vec_id", topk.integer_vector("embedding").alias("vector"))
    return topk.top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxic.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    shared = bpe.share_ranks(spark, VOCABULARY, public_tokenizers.PATTERN)
    tokens = bpe.encode(read(spark, folder, "documents"), shared, decode_too=True)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return tokens.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                         sha256_text(ids).alias("ids_sha256"),
                         sha256_text(F.col("decoded")).alias("decoded_sha256"))


@query("op7_minhash_near_dedup", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
cells AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM cells a JOIN cells b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * k >= 85 * (na + nb - k)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM reached r JOIN sides e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM sets s JOIN least l USING (doc_id)
""")
def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dedup_decisions(read(spark, folder, "documents"), words=3, percent=85)


@query("op2_secrets")
def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(read(spark, folder, "documents")))


@query("op6_quality")
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return good.quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op9_pii")
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_personal(read(spark, folder, "documents")))


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"))


@query("op11_fill_in_middle", r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents),
numbers AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM drawn),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
         array_to_string(units[high + 1:], '') AS suffix
  FROM cuts)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
""")
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = infill.infill(read(spark, folder, "documents"), seed=7, rate=100, spm=50)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      sha256_text(F.col("output")).alias("output_sha256"),
                      sha256_text(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query("op13_language_id")
def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return tongue.language(read(spark, folder, "documents")).drop("shares")


@query("op12_conversation_repair", r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
drawn AS (
  SELECT *, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(name, '')]),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
             lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 20 AS draw
  FROM raw),
hurt AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM drawn, (VALUES (1), (2)) AS copies(copy)
  WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM hurt),
judged AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY r) > 1 THEN 'duplicate'
                 WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY r) AS earlier
  FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(r) AS n,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (r > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
-- a way is its cost in eight digits, then its letters, so that the least string is the best way
ways(conv_id, r, w) AS (
  SELECT conv_id, CAST(0 AS BIGINT), ['00000000', NULL, NULL, NULL] FROM counted
  UNION ALL
  SELECT conv_id, r, [
    CASE WHEN m[1] IS NOT NULL THEN lpad(CAST(CAST(left(m[1], 8) AS BIGINT) + 3 AS VARCHAR), 8, '0') || substr(m[1], 9) || 'D' END,
    least(lpad(CAST(CAST(left(m[2], 8) AS BIGINT) + 3 AS VARCHAR), 8, '0') || substr(m[2], 9) || 'D',
          CASE WHEN stays AND initial = 's'
               THEN lpad(CAST(CAST(left(m[1], 8) AS BIGINT) + late AS VARCHAR), 8, '0') || substr(m[1], 9) || 'K' END),
    least(lpad(CAST(CAST(left(m[3], 8) AS BIGINT) + 3 AS VARCHAR), 8, '0') || substr(m[3], 9) || 'D',
          CASE WHEN stays THEN list_min([lpad(CAST(CAST(left(x, 8) AS BIGINT) + late
                 + CASE initial WHEN 'u' THEN 0 ELSE 2 END AS VARCHAR), 8, '0') || substr(x, 9)
                 || CASE initial WHEN 'u' THEN 'K' ELSE 'R' END FOR x IN [m[1], m[2], m[4]]]) END),
    least(lpad(CAST(CAST(left(m[4], 8) AS BIGINT) + 3 AS VARCHAR), 8, '0') || substr(m[4], 9) || 'D',
          CASE WHEN stays THEN lpad(CAST(CAST(left(m[3], 8) AS BIGINT) + late
                 + CASE initial WHEN 'a' THEN 0 ELSE 2 END AS VARCHAR), 8, '0') || substr(m[3], 9)
                 || CASE initial WHEN 'a' THEN 'K' ELSE 'R' END END)]
  FROM (
    SELECT j.conv_id, j.r, j.initial, j.fault NOT IN ('blank', 'duplicate') AS stays,
           CASE j.fault WHEN 'truncated' THEN 1 ELSE 0 END AS late,
           [w[1], w[2],
            least(w[3], list_min([lpad(CAST(CAST(left(x, 8) AS BIGINT) + 2 AS VARCHAR), 8, '0') || substr(x, 9) || 'I'
                                  FOR x IN [w[1], w[2], w[4]]])),
            least(w[4], lpad(CAST(CAST(left(w[3], 8) AS BIGINT) + 2 AS VARCHAR), 8, '0') || substr(w[3], 9) || 'I',
                  list_min([lpad(CAST(CAST(left(x, 8) AS BIGINT) + 4 AS VARCHAR), 8, '0') || substr(x, 9) || 'II'
                            FOR x IN [w[1], w[2]]]))] AS m
    FROM ways p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.r = p.r + 1)),
best AS (
  SELECT c.*, list_min([lpad(CAST(CAST(left(e.x, 8) AS BIGINT) + 2 * len(e.ends) AS VARCHAR), 8, '0') || substr(e.x, 9)
                        || e.ends FOR e IN [{'x': w[1], 'ends': ''}, {'x': w[2], 'ends': 'II'},
                                            {'x': w[3], 'ends': 'I'}, {'x': w[4], 'ends': ''}]]) AS way
  FROM counted c JOIN ways p ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.r),
letters AS (
  SELECT conv_id, unnest(string_split(substr(way, 9), '')) AS letter, generate_subscripts(string_split(substr(way, 9), ''), 1) AS p
  FROM best),
edits AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS r,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY p) AS k
  FROM letters),
left_over AS (
  SELECT e.conv_id, e.p, e.k, e.letter, j.role, CASE e.letter WHEN 'I' THEN '' ELSE j.text END AS text,
         max(CASE WHEN e.k = 1 AND e.letter = 'K' AND j.initial = 's' THEN 1 ELSE 0 END)
           OVER (PARTITION BY e.conv_id) AS opening
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.r = e.r
  WHERE e.letter IN ('K', 'R', 'I')),
written AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role
                                  WHEN (k - opening) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY p) AS whole
  FROM left_over GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(b.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(b.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(b.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(b.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(b.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(left(b.way, 8), '0') AS BIGINT) AS cost,
       coalesce(substr(b.way, 9), '') AS audit, sha256(coalesce(w.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN best b ON a.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN written w ON a.conv_id IS NOT DISTINCT FROM w.conv_id
""")
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations")
    return repair.digest(turns.select("conv_id"), repair.repair(repair.damaged(turns)))
