"""Registered queries of the training-data operators and, where SQL can say it, their DuckDB statements.

Every query runs its operator with production parameters over its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekloom.llm import decontaminate, lattice_lm, licenses, merkle, ngram_join, packing, perspectives, pii_crf, quality, secrets, sentencepiece_codec, url_rules, whitening
from weekloom.llm.common import table


def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lattice_lm.LatticeModel().fit(docs).score(docs)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.UrlRules(url_rules.default_rules(spark)).judge(table(spark, sf_dir, "pages"))


def op3_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


def op5_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.NgramJoin(table(spark, sf_dir, "documents")).documents()


def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotated(table(spark, sf_dir, "conversations"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_crf.find_personal_data(docs, pii_crf.fitted(docs))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.QualityCascade().fit(docs).judge(docs)


def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).places.drop("key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lattice_likelihood, op2_url_rules, op3_credential_linking, op4_license_rules, op5_pigeonhole_decontamination, op6_ngram_jaccard_join, op7_perspective_rotation, op8_personal_data, op9_quality_cascade, op10_sentencepiece_codec,
                              op11_embedding_whitening, op12_merkle_manifest, op13_best_fit_packing)
}

ORACLES: dict[str, str] = {
    "op2_url_rules": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT h.page_id, h.host, h.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS n
  FROM hosts h LEFT JOIN rules r
    ON (h.host = r.rule_host OR ends_with(h.host, '.' || r.rule_host)) AND starts_with(h.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE n = 1
""",
    "op7_perspective_rotation": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, count(*) AS times
  FROM conversations GROUP BY ALL
), speakers AS (
  SELECT DISTINCT conv_id, role AS speaker FROM said WHERE role <> 'system'
), turns AS (
  SELECT s.conv_id, p.speaker, s.turn, s.times, s.role = p.speaker AS mine,
         CASE WHEN s.role = 'system' THEN '<|system|>' WHEN s.role = p.speaker THEN '<|assistant|>'
              ELSE '<|user name=' || regexp_replace(s.role, '[^A-Za-z0-9_.-]', '_', 'g') || '|>' END || chr(10) AS head,
         replace(s.text, '<|', '< |') || '<|end|>' AS body
  FROM said s JOIN speakers p USING (conv_id)
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, speaker ORDER BY turn) - 1 AS stop FROM turns
)
SELECT conv_id, speaker, 0::BIGINT AS block, NULL::BIGINT AS turn, 0::INTEGER AS slice, count(*) AS n_messages, count(*) FILTER (mine) AS n_trained,
       sum(times)::BIGINT AS n_rows, string_agg(head || body || chr(10), '' ORDER BY turn) AS text,
       coalesce(string_agg(CAST(stop - length(body) AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY turn) FILTER (mine), '') AS mask
FROM placed p GROUP BY conv_id, speaker
""",
    "op9_quality_cascade": r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM repeated) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), figures AS (
  SELECT doc_id, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(regexp_replace(t, '\PL', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_capitals,
         length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 5 * n_symbols > n_words OR (n_letters >= 40 AND 2 * n_capitals > n_letters) OR 4 * n_bangs > n_words
            OR 2 * n_letters < word_chars OR NOT (2 * n_words <= word_chars AND word_chars <= 25 * n_words)
            OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)) AS kept
FROM judged
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE given AS (
  SELECT *, CASE WHEN doc_id IS NULL THEN false ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 2 = 0 END AS touched
  FROM documents
), heads AS (
  SELECT *, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
         CASE WHEN touched THEN replace(text, chr(10), '') ELSE text END AS late
  FROM given
), hashed AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(late)) || ':' || late, '-')) AS claimed
  FROM heads
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM hashed
), tree AS (
  SELECT 0 AS lvl, grp, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT lvl + 1, grp, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3) FROM tree WHERE n > 1 GROUP BY lvl, grp, pos // 3
), subroots AS (
  SELECT grp, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), crown AS (
  SELECT 0 AS lvl, pos, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + 2) // 3) FROM crown WHERE n > 1 GROUP BY lvl, pos // 3
), nodes AS (
  SELECT grp, lvl, pos, digest, n FROM tree WHERE n > 1
  UNION ALL SELECT NULL, lvl, pos, digest, n FROM crown WHERE n > 1
), steps AS (
  SELECT a.grp, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS after
  FROM nodes a JOIN nodes b ON a.grp IS NOT DISTINCT FROM b.grp AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 GROUP BY ALL
), ways AS (
  SELECT l.grp, l.pos, s.lvl, s.before, s.after FROM leaves l JOIN steps s ON s.grp = l.grp AND s.pos = l.pos // CAST(power(3, s.lvl) AS BIGINT)
  UNION ALL
  SELECT l.grp, l.pos, r.height + s.lvl, s.before, s.after
  FROM leaves l JOIN subroots r USING (grp) JOIN steps s ON s.grp IS NULL AND s.pos = r.pos // CAST(power(3, s.lvl) AS BIGINT)
), proofs AS (
  SELECT grp, pos, string_agg(before || after, '' ORDER BY lvl) AS proof, list(before || '|' || after ORDER BY lvl) AS steps FROM ways GROUP BY grp, pos
), done AS (
  SELECT l.doc_id, l.leaf, r.subroot, (SELECT digest FROM crown WHERE n = 1) AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
         list_reduce(list_prepend(l.claimed, coalesce(p.steps, [])), lambda acc, step: sha256(split_part(step, '|', 1) || acc || split_part(step, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots r USING (grp) LEFT JOIN proofs p ON p.grp = l.grp AND p.pos = l.pos
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM done
""",
}

def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
