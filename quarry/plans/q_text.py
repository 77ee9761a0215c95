"""Text queries over documents, posts, parts and the clinical text views."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.columns import r6
from quarry.operators import text as tx
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views

_W = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"

# Stop words (four languages), a small polarity lexicon with
# negators, and keyword rules for part descriptions.
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "de", "la", "le", "les", "et",
              "des", "en", "un", "der", "die", "und", "den", "von", "el", "que", "es", "y", "los"]
LEXICON = [("best", 3.2), ("good", 1.9), ("great", 3.1), ("bad", -2.5), ("poor", -2.1), ("wrong", -2.1),
           ("bien", 1.6), ("mal", -1.9), ("gut", 1.8), ("schlecht", -2.2), ("bueno", 1.9), ("malo", -2.0)]
NEGATORS = ["not", "no", "never", "pas", "nicht", "kein", "nunca"]
PART_RULES = [("bolt|gear", "Mechanical"), ("ring|plate", "Hardware"), ("widget|gizmo", "Gadget")]
DX_RULES = {"Economy": "^ECONOMY$", "Small": "SMALL", "Widget": "widget"}


def _docs(spark, root):
    return Views(spark, root).t.documents


@register("j14_word_count_unicode", f"""
SELECT word, count(*) AS n FROM (SELECT unnest({_W}) AS word FROM documents) GROUP BY 1""")
def j14_word_count_unicode(spark, root):
    return tx.word_count(_docs(spark, root), "text", unicode=True).orderBy(F.desc("n"), "word")


@register("j15_word_count_ascii", r"""
SELECT word, count(*) AS n FROM (
  SELECT regexp_replace(t, '[^\x00-\x7F]', '', 'g') AS word FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS t FROM documents))
WHERE word <> '' GROUP BY 1""")
def j15_word_count_ascii(spark, root):
    return tx.word_count(_docs(spark, root), "text", unicode=False)


_CLEAN_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  text, 'https?://[^ \t\n\r]+|www\.[^ \t\n\r]+', ' ', 'g'), '@[A-Za-z0-9_]+', ' ', 'g'), '#([A-Za-z0-9_]+)', '\1', 'g'),
  '&(amp|lt|gt|quot|#39);', ' ', 'g'), '[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F2FF}]', '', 'g'), '[\t\n\r]+', ' ', 'g'), ' {2,}', ' ', 'g'))"""


@register("j10_clean_posts", with_views("posts") + f"SELECT id, {_CLEAN_SQL} AS clean FROM posts")
def j10_clean_posts(spark, root):
    return Views(spark, root).posts.select("id", tx.clean_post("text").alias("clean"))


@register("j11_drop_numbers_times", r"""
SELECT doc_id, array_to_string(list_filter(string_split_regex(trim(text), '[ \t\n\r]+'),
  lambda t: NOT (regexp_matches(t, '^[0-9]+([.,][0-9]+)?$') OR regexp_matches(t, '^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$')
            OR regexp_matches(lower(t), '^(utc|gmt|eat|cet|cest|est|pst|bst)$')) AND t <> ''), ' ') AS kept FROM documents""")
def j11_drop_numbers_times(spark, root):
    return _docs(spark, root).select("doc_id", tx.drop_numbers_times("text").alias("kept"))


@register("j12_alnum_tokens", """
SELECT doc_id, CAST(len(regexp_extract_all(text, '([A-Za-z0-9]+)', 1)) AS INTEGER) AS n_tokens,
  array_to_string(regexp_extract_all(text, '([A-Za-z0-9]+)', 1), ' ') AS tokens FROM documents""")
def j12_alnum_tokens(spark, root):
    t = tx.alnum_tokens("text")
    return _docs(spark, root).select("doc_id", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@register("j13_split_camel", with_views("posts") + r"""
SELECT id, regexp_replace(handle || 'Feed' || upper(lang) || text, '([a-z])([A-Z])', '\1 \2', 'g') AS split_text FROM posts""")
def j13_split_camel(spark, root):
    p = Views(spark, root).posts
    return p.select("id", tx.split_camel(F.concat("handle", F.lit("Feed"), F.upper("lang"), "text")).alias("split_text"))


@register("j16_tags_mentions", with_views("posts") + """
SELECT id, array_to_string(regexp_extract_all(text, '#([A-Za-z0-9_]+)', 1), ' ') AS hashtags,
  array_to_string(regexp_extract_all(text, '@([A-Za-z0-9_]+)', 1), ' ') AS mentions FROM posts""")
def j16_tags_mentions(spark, root):
    p = Views(spark, root).posts
    return p.select("id", tx.tags_text("text", "#").alias("hashtags"), tx.tags_text("text", "@").alias("mentions"))


@register("j17_first_two_chars", """
SELECT doc_id, TRY_CAST(substr(CAST(n_chars AS VARCHAR), 1, 2) AS INTEGER) AS lead2 FROM documents""")
def j17_first_two_chars(spark, root):
    d = _docs(spark, root)
    return d.select("doc_id", F.substring(F.col("n_chars").cast("string"), 1, 2).try_cast("int").alias("lead2"))


@register("j18_repost_prefix", with_views("posts") + """
, p AS (SELECT id, CASE WHEN retweeted IS NOT NULL THEN 'RT @' || handle || ': ' || text ELSE text END AS text, likes FROM posts)
SELECT id, starts_with(text, 'RT @') AS is_repost, CASE WHEN starts_with(text, 'RT @') THEN 0 ELSE likes END AS likes,
  CASE WHEN starts_with(text, 'RT @') THEN '' ELSE array_to_string(regexp_extract_all(text, '#([A-Za-z0-9_]+)', 1), ' ') END AS hashtags
FROM p""")
def j18_repost_prefix(spark, root):
    p = Views(spark, root).posts
    t = F.when(F.col("retweeted").isNotNull(), F.concat(F.lit("RT @"), "handle", F.lit(": "), "text")).otherwise(F.col("text"))
    q = p.select("id", t.alias("text"), "likes")
    rt = F.col("text").startswith("RT @")
    return q.select("id", rt.alias("is_repost"), F.when(rt, F.lit(0)).otherwise(F.col("likes")).alias("likes"),
                    F.when(rt, F.lit("")).otherwise(tx.tags_text("text", "#")).alias("hashtags"))


@register("j1_strip_units", with_views("admissions") + r"""
, s AS (SELECT adm_id, CAST(CAST(floor(weight_kg * 1000) AS BIGINT) AS VARCHAR) || CASE WHEN adm_id % 2 = 0 THEN ' g' ELSE 'g (kg)' END AS raw FROM admissions)
SELECT adm_id, raw, TRY_CAST(trim(regexp_replace(raw, '^(.*?)(?:kg|g)', '\1')) AS DOUBLE) AS weight FROM s""")
def j1_strip_units(spark, root):
    a = Views(spark, root).admissions
    raw = F.concat(F.floor(F.col("weight_kg") * 1000).cast("string"),
                   F.when(F.col("adm_id") % 2 == 0, F.lit(" g")).otherwise(F.lit("g (kg)")))
    s = a.select("adm_id", raw.alias("raw"))
    return s.select("adm_id", "raw", tx.strip_units("raw", "kg|g", first_only=True).alias("weight"))


@register("j2_j3_brand_number_titlecase", r"""
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(p_brand, '(\d+)', 1), '') AS INTEGER) AS brand_no,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title FROM part""")
def j2_j3_brand_number_titlecase(spark, root):
    p = Views(spark, root).t.part
    return p.select("p_partkey", tx.first_integer("p_brand").alias("brand_no"), F.initcap("p_name").alias("title"))


@register("j4_merge_text_fields", with_views("diag_text") + """
SELECT adm_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(
  string_split(regexp_replace(concat_ws(';', dx_a, dx_b, dx_c, diagnoses), 'Brand#', '', 'g'), ';'), lambda t: trim(t)), lambda t: t <> ''))), ';') AS merged
FROM diag_text""")
def j4_merge_text_fields(spark, root):
    d = Views(spark, root).diag_text
    return d.select("adm_id", tx.merge_text_fields(["dx_a", "dx_b", "dx_c", "diagnoses"], strip="Brand#").alias("merged"))


_SIGN_LABELS = {"Floppy": "floppy", "Convulsions": "convulsions", "Indrawing": "indrawing", "Grunting": "grunting"}


@register("j5_checkbox_labels", with_views("signs") + """
SELECT adm_id, array_to_string(list_filter([CASE WHEN floppy = 'Yes' THEN 'Floppy' END, CASE WHEN convulsions = 'Yes' THEN 'Convulsions' END,
  CASE WHEN indrawing = 'Yes' THEN 'Indrawing' END, CASE WHEN grunting = 'Yes' THEN 'Grunting' END], lambda x: x IS NOT NULL), ', ') AS labels
FROM signs""")
def j5_checkbox_labels(spark, root):
    s = Views(spark, root).signs
    lab = tx.checkbox_labels({k: F.col(v) == "Yes" for k, v in _SIGN_LABELS.items()})
    return s.select("adm_id", F.array_join(lab, ", ").alias("labels"))


@register("j6_combined_labels", with_views("signs", "diag_text") + """
SELECT s.adm_id, array_to_string(list_sort(list_distinct(list_filter(
  list_concat(list_filter([CASE WHEN s.floppy = 'Yes' THEN 'Floppy' END, CASE WHEN s.grunting = 'Yes' THEN 'Grunting' END], lambda x: x IS NOT NULL),
              string_split(d.diagnoses, ';')), lambda x: x IS NOT NULL AND x <> ''))), '|') AS labels
FROM signs s JOIN diag_text d USING (adm_id)""")
def j6_combined_labels(spark, root):
    v = Views(spark, root)
    j = v.signs.join(v.diag_text, "adm_id")
    a = tx.checkbox_labels({"Floppy": F.col("floppy") == "Yes", "Grunting": F.col("grunting") == "Yes"})
    return j.select("adm_id", F.array_join(tx.combine_labels(a, F.split("diagnoses", ";")), "|").alias("labels"))


@register("j7_first_match_class", """
SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'bolt|gear') THEN 'Mechanical' WHEN regexp_matches(p_name, 'ring|plate') THEN 'Hardware'
  WHEN regexp_matches(p_name, 'widget|gizmo') THEN 'Gadget' ELSE 'Other' END AS category FROM part""")
def j7_first_match_class(spark, root):
    p = Views(spark, root).t.part
    return p.select("p_partkey", tx.first_match_class("p_name", PART_RULES).alias("category"))


@register("j8_keyword_flags", with_views("diag_text") + """
, t AS (SELECT adm_id, list_filter(list_transform(string_split(diagnoses, ';'), lambda x: trim(x)), lambda x: x <> '') AS toks FROM diag_text)
SELECT adm_id, len(list_filter(toks, lambda x: regexp_matches(x, '^ECONOMY$'))) > 0 AS "Economy",
  len(list_filter(toks, lambda x: regexp_matches(x, 'SMALL'))) > 0 AS "Small",
  len(list_filter(toks, lambda x: regexp_matches(x, 'widget'))) > 0 AS "Widget",
  len(list_filter(toks, lambda x: NOT regexp_matches(x, '(?:^ECONOMY$)|(?:SMALL)|(?:widget)'))) > 0 AS "Other",
  len(toks) = 0 AS "No Diagnosis" FROM t""")
def j8_keyword_flags(spark, root):
    d = Views(spark, root).diag_text
    toks = F.filter(F.transform(F.split("diagnoses", ";"), lambda x: F.trim(x)), lambda x: x != "")
    flags = tx.keyword_flags(toks, DX_RULES)
    return d.select("adm_id", *[c.alias(k) for k, c in flags.items()])


@register("j9_any_column_contains", with_views("diag_text") + """
, d AS (SELECT adm_id, CASE WHEN adm_id % 8 = 0 THEN NULL ELSE dx_a END AS a, CASE WHEN adm_id % 4 = 0 THEN NULL ELSE dx_b END AS b,
  CASE WHEN adm_id % 16 = 0 THEN NULL ELSE dx_c END AS c FROM diag_text)
SELECT adm_id, CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN NULL ELSE regexp_matches(concat_ws(' ', a, b, c), 'ring') END AS has_ring FROM d""")
def j9_any_column_contains(spark, root):
    d = Views(spark, root).diag_text
    k = F.col("adm_id")
    d = d.select("adm_id", F.when(k % 8 == 0, None).otherwise(F.col("dx_a")).alias("a"),
                 F.when(k % 4 == 0, None).otherwise(F.col("dx_b")).alias("b"),
                 F.when(k % 16 == 0, None).otherwise(F.col("dx_c")).alias("c"))
    return d.select("adm_id", tx.any_column_contains(["a", "b", "c"], "ring").alias("has_ring"))


@register("l1_stopword_removal", f"""
SELECT doc_id, CAST(len({_W}) AS INTEGER) AS n_tokens, CAST(len(list_filter({_W}, lambda w: NOT list_contains({STOP_WORDS!r}, w))) AS INTEGER) AS n_kept FROM documents""")
def l1_stopword_removal(spark, root):
    d = _docs(spark, root)
    t = tx.words("text")
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.size(tx.remove_stopwords(t, STOP_WORDS)).alias("n_kept"))


@register("l2_bigram_phrases", f"""
WITH t AS (SELECT {_W} AS w FROM documents),
u AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM t) GROUP BY 1),
v AS (SELECT count(*) AS "V" FROM u),
p AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: {{'a': w[i], 'b': w[i + 1]}})) AS p FROM t WHERE len(w) >= 2),
b AS (SELECT p.a AS a, p.b AS b, count(*) AS n_ab FROM p GROUP BY 1, 2 HAVING count(*) >= 3),
s AS (SELECT b.a, b.b, b.n_ab, round((b.n_ab - 3) * v."V" / (ua.n * ub.n), 6) AS score
      FROM b JOIN u ua ON ua.w = b.a JOIN u ub ON ub.w = b.b, v)
SELECT * FROM s WHERE score > 40""")
def l2_bigram_phrases(spark, root):
    return tx.bigram_phrases(_docs(spark, root), "doc_id", "text", 3, 40.0)


def _lexicon(spark):
    return spark.createDataFrame(LEXICON, "word string, score double")


_LEX_SQL = "(VALUES " + ", ".join(f"('{w}', CAST({s} AS DOUBLE))" for w, s in LEXICON) + ") lex(word, score)"
_POLARITY_SQL = f"""
, t AS (SELECT doc_id, {_W} AS w FROM documents),
p AS (SELECT doc_id, unnest(list_transform(range(1, len(w) + 1), lambda i: {{'w': w[i], 'prev': CASE WHEN i > 1 THEN w[i - 1] END}})) AS p FROM t),
s AS (SELECT doc_id, CASE WHEN coalesce(p.prev, '') IN ({", ".join(repr(n) for n in NEGATORS)}) THEN -lex.score ELSE lex.score END AS s
      FROM p JOIN {_LEX_SQL} ON lex.word = p.w),
per AS (SELECT doc_id, sum(s) AS raw FROM s GROUP BY 1),
pol AS (SELECT d.doc_id, round(coalesce(raw, 0.0), 6) AS raw,
  round(coalesce(raw, 0.0) / sqrt(coalesce(raw, 0.0) * coalesce(raw, 0.0) + 15), 6) AS compound FROM documents d LEFT JOIN per USING (doc_id))"""


@register("l9_lexicon_polarity", "WITH " + _POLARITY_SQL.lstrip()[1:] + " SELECT * FROM pol")
def l9_lexicon_polarity(spark, root):
    return tx.lexicon_polarity(_docs(spark, root), "doc_id", "text", _lexicon(spark), NEGATORS)


@register("l10_median_polarity_by_hour", with_views("posts") + _POLARITY_SQL + """
SELECT CAST(p.ts AS DATE) AS day, CAST(hour(p.ts) AS INTEGER) AS hour, round(quantile_cont(pol.compound, 0.5), 6) AS median
FROM posts p JOIN pol ON p.id = pol.doc_id GROUP BY 1, 2""")
def l10_median_polarity_by_hour(spark, root):
    v = Views(spark, root)
    pol = tx.lexicon_polarity(v.t.documents, "doc_id", "text", _lexicon(spark), NEGATORS)
    j = v.posts.join(pol, v.posts.id == pol.doc_id).select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), "compound")
    return tx.polarity_median_by(j, ["day", "hour"], "compound")


@register("l11_gazetteer_entities", f"""
, gz AS (SELECT lower(n_name) AS phrase, 'COUNTRY' AS type FROM nation UNION ALL SELECT lower(r_name), 'REGION' FROM region
         UNION ALL SELECT 'example com', 'DOMAIN'),
t AS (SELECT doc_id, {_W} AS w FROM documents),
g AS (SELECT doc_id, unnest(list_concat(
   list_transform(range(1, len(w) + 1), lambda i: w[i]),
   list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
   list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS phrase FROM t)
SELECT doc_id, array_to_string(list_sort(list(g.phrase)), '|') AS mentions, array_to_string(list_sort(list(gz.type)), '|') AS types
FROM g JOIN gz USING (phrase) GROUP BY doc_id""".replace("\n, gz AS", "WITH gz AS", 1))
def l11_gazetteer_entities(spark, root):
    v = Views(spark, root)
    gz = (v.t.nation.select(F.col("n_name").alias("phrase"), F.lit("COUNTRY").alias("type"))
          .unionByName(v.t.region.select(F.col("r_name").alias("phrase"), F.lit("REGION").alias("type")))
          .unionByName(spark.createDataFrame([("example com", "DOMAIN")], "phrase string, type string")))
    return tx.gazetteer_entities(v.t.documents, "doc_id", "text", gz, 3)


__all__ = ["r6"]
