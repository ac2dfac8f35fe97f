"""The dealt operators over their whole tables: one query each."""

from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, langid, line_rules, lm_score, mixing, negatives, pii, quality, substring_dedup, token_index, toxicity, whitening
from .registry import ORACLES, QUERIES, query, read  # noqa: F401


@query("op7_pii")
def op7_pii(spark, sf_dir):
    return pii.op_digest(read(spark, sf_dir, "documents"))


@query("op3_langid")
def op3_langid(spark, sf_dir):
    return langid.op_languages(read(spark, sf_dir, "documents"))


@query("op5_quality")
def op5_quality(spark, sf_dir):
    return quality.op_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8),
twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         lower(trim(regexp_replace(l, '[ \t\x0B\f\r]+', ' ', 'g'))) AS norm
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d)),
dups AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE n > 0 GROUP BY doc_id),
hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source),
common AS (
  SELECT l.source, norm FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE n > 0
  GROUP BY l.source, norm, docs HAVING count(DISTINCT doc_id) > 10 AND count(DISTINCT doc_id) > docs * 0.01),
lost AS (
  SELECT doc_id, sum(n) AS n, count(*) AS lines FROM lines l
  JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.norm = c.norm GROUP BY doc_id),
stats AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, (len(ws) - coalesce(lost.n, 0))::BIGINT AS words_left,
         coalesce(lost.lines, 0)::BIGINT AS lines_removed
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND words_left >= 0.5 * n_words AS kept
FROM stats
"""


@query("op9_line_rules", SQL_RULES)
def op9_line_rules(spark, sf_dir):
    return line_rules.op_rules(read(spark, sf_dir, "documents"))


@query("op2_mixing", mixing.SQL)
def op2_mixing(spark, sf_dir):
    return mixing.op_mix(read(spark, sf_dir, "documents"))


@query("op8_decontamination")
def op8_decontamination(spark, sf_dir):
    return decontaminate.op_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    return toxicity.op_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SQL_REPEATS = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
h AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s FROM p),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM f WHERE r > 1),
lists AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(ws) + 1), lambda k: ks IS NULL OR NOT list_contains(ks, k)),
                                             lambda k: ws[k]), ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""


@query("op6_substring_dedup", SQL_REPEATS)
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.op_repeats(read(spark, sf_dir, "documents"))


SQL_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""


@query("op4_jaccard_join", SQL_JACCARD)
def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.op_components(read(spark, sf_dir, "documents"))


@query("op10_lm_score")
def op10_lm_score(spark, sf_dir):
    return lm_score.op_scores(read(spark, sf_dir, "documents"))


@query("op11_token_index")
def op11_token_index(spark, sf_dir):
    import public_tokenizers

    return token_index.op_index(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whitening.op_whiten(read(spark, sf_dir, "embeddings"))


SQL_NEGATIVES = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label IS NOT DISTINCT FROM b.label AS same,
         list_dot_product(a.x, b.x)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op12_negatives", SQL_NEGATIVES)
def op12_negatives(spark, sf_dir):
    df = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.op_negatives(df.withColumn("label", label), F.col("vec_id") % 50 == 0)
