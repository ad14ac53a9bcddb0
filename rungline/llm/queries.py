"""Registered queries of the operators, each beside the SQL it must equal where SQL can express it."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rungline.llm import (chat, collocations, common, grammar, licenses, mixing, packing, quality, repair, simhash, suffixes, toxicity, urls,
                          vectors)

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY, WORD_IDS = public_tokenizers.path("word_bpe_49k.json"), 49_408


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(common.documents(spark, sf_dir), BYTE_VOCABULARY).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, sf_dir)).select(
        "doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents"))


def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.read_back(common.written(chat.format_conversations(rows.unionByName(hard)), "formatted"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.learn(docs, common.table(spark, sf_dir, "labels")))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.documents(spark, sf_dir))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(common.documents(spark, sf_dir), common.table(spark, sf_dir, "labels")).select(
        "doc_id", *quality.BASE, "base_failed", "kept", "quality")


def q_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_folder(spark, "shards")
    grammar.write(common.documents(spark, sf_dir), WORD_VOCABULARY, path, WORD_IDS)
    return grammar.read(spark, path, WORD_IDS)


def q_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def q_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(common.documents(spark, sf_dir), suffixes.WORDS)


def q_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(common.table(spark, sf_dir, "documents").select("lang", "text"))


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), "
                      "('org', '/fr/', 'allow') AS rules(host, path, verdict)")
    return urls.judged(common.table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def q_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
), found AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT a AS vec_id, (SELECT count(*) FROM l WHERE l.a = found.a) AS n_links, component_id, a = component_id AS kept FROM found
"""


CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, len(regexp_extract_all(text, '</?s>|\[/?INST\]|\[/?ROLE\]|\[SAYS\]')) AS n_text,
         len(regexp_extract_all(role, '</?s>|\[/?INST\]|\[/?ROLE\]|\[SAYS\]')) AS n_role FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(text) + n_text + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
                ELSE 23 + length(role) + n_role END) AS BIGINT) AS formatted_chars
FROM counted GROUP BY conv_id
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
split AS (
  SELECT *, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
), cuts AS (
  SELECT s.*, l.f AS l, r.f AS r, CAST(1000000 * a::HUGEINT * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM split s JOIN f l ON l.lang = s.lang AND l.phrase = s.first JOIN f r ON r.lang = s.lang AND r.phrase = s.rest
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_of AS (
  SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM cand WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_of i ON i.lang = b.lang AND i.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang) WHERE rank <= 2000
"""

URLS_SQL = r"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM (
  SELECT *, CASE WHEN under_en THEN 'example.net/en/' WHEN under_de THEN 'example.com/de/' WHEN under_fr THEN 'org/fr/' WHEN under_net THEN 'net/' END AS rule,
         CASE WHEN under_en OR under_fr THEN 'allow' WHEN under_de OR under_net THEN 'block' END AS verdict
  FROM (SELECT *, (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS under_net,
               (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS under_en,
               (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS under_de,
               (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS under_fr FROM parts))
"""

#: The whole repair as a recursion from each conversation's last row to its first: per state the least cost, its least audit and the lines.
REPAIR_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b
  FROM conversations
), faulty AS (
  SELECT * EXCLUDE (b), xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295), 4294967295) % 20 AS fault FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM faulty WHERE fault <> 0
), told AS (
  SELECT *, rtrim(text, E' \t\n\x0B\f\r') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said FROM damaged
), seen AS (
  SELECT *, t = '' AS blank, t <> '' AND said > 1 AS dup, t <> '' AND said = 1 AND right(t, 1) NOT IN ('.', '!', '?') AS broken,
         CASE WHEN left(role, 1) IN ('u', 'a', 's') THEN left(role, 1) ELSE 'o' END AS ini FROM told
), pairs AS (SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM seen),
stats AS (
  SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (broken) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id
), back AS (
  SELECT conv_id, rows AS i, {'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])} AS s0, {'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']} AS s1,
         {'c': 2, 'a': 'I', 'r': ['assistant:']} AS s2, {'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])} AS s3 FROM stats
  UNION ALL
  SELECT conv_id, i - 1,
         list_sort([b0, {'c': b2.c + 2, 'a': 'I' || b2.a, 'r': ['user:'] || b2.r}, {'c': b3.c + 4, 'a': 'II' || b3.a, 'r': ['user:', 'assistant:'] || b3.r}])[1],
         list_sort([b1, {'c': b2.c + 2, 'a': 'I' || b2.a, 'r': ['user:'] || b2.r}, {'c': b3.c + 4, 'a': 'II' || b3.a, 'r': ['user:', 'assistant:'] || b3.r}])[1],
         list_sort([b2, {'c': b3.c + 2, 'a': 'I' || b3.a, 'r': ['assistant:'] || b3.r}])[1],
         list_sort([b3, {'c': b2.c + 2, 'a': 'I' || b2.a, 'r': ['user:'] || b2.r}])[1]
  FROM (
    SELECT conv_id, i, list_sort([{'c': s0.c + 3, 'a': 'D' || s0.a, 'r': s0.r}, CASE ini WHEN 's' THEN {'c': s1.c + k, 'a': 'K' || s1.a, 'r': line || s1.r}
                               WHEN 'u' THEN ku ELSE no END, ru])[1] AS b0,
           list_sort([{'c': s1.c + 3, 'a': 'D' || s1.a, 'r': s1.r}, CASE ini WHEN 'u' THEN ku ELSE no END, ru])[1] AS b1,
           list_sort([{'c': s2.c + 3, 'a': 'D' || s2.a, 'r': s2.r}, CASE ini WHEN 'a' THEN {'c': s3.c + k, 'a': 'K' || s3.a, 'r': line || s3.r} ELSE no END,
                      {'c': s3.c + k + 2, 'a': 'R' || s3.a, 'r': ['assistant:' || text] || s3.r}])[1] AS b2,
           list_sort([{'c': s3.c + 3, 'a': 'D' || s3.a, 'r': s3.r}, CASE ini WHEN 'u' THEN ku ELSE no END, ru])[1] AS b3
    FROM (SELECT *, {'c': s2.c + k, 'a': 'K' || s2.a, 'r': line || s2.r} AS ku, {'c': s2.c + k + 2, 'a': 'R' || s2.a, 'r': ['user:' || text] || s2.r} AS ru,
                 {'c': 1000000000, 'a': '', 'r': CAST([] AS VARCHAR[])} AS no
          FROM (SELECT b.*, ini, text, [role || ':' || text] AS line, CASE WHEN blank OR dup THEN 100000000 WHEN broken THEN 1 ELSE 0 END AS k
                FROM back b JOIN seen s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.i = b.i)))
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
       sha256(coalesce(array_to_string(s0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN back ON back.conv_id IS NOT DISTINCT FROM ids.conv_id AND back.i = 0
"""

ENTRIES = {
    "op1_packing": (q_packing, None),
    "op2_toxicity": (q_toxicity, None),
    "op3_simhash": (q_simhash, None),
    "op4_licenses": (q_licenses, None),
    "op5_quality": (q_quality, None),
    "op6_mixing": (q_mixing, None),
    "op7_vectors": (q_vectors, VECTORS_SQL),
    "op8_suffixes": (q_suffixes, None),
    "op9_chat": (q_chat, CHAT_SQL),
    "op10_token_ids": (q_grammar, None),
    "op11_collocations": (q_collocations, COLLOCATIONS_SQL),
    "op12_urls": (q_urls, URLS_SQL),
    "op13_repair": (q_repair, REPAIR_SQL),
}
