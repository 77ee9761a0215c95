"""One query per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ann, bpe, centroids, chat_format, fingerprints, language_id, packing, ranking, sharding, simhash_dedup, substring_dedup, toxicity, url_filter
from quarry.llm.common import table
from quarry.llm.registry import query

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query("op2_url_filter", sql=r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict
FROM r""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page url against the four rules, default allow."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids; one row per piece."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded again."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), WORD_BPE, keep_ids=False)


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, language_id.learn(docs))
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, 3 bits."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_chat_format")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    chunks = chat_format.format_conversations(turns.unionByName(own), BYTE_BPE)
    return chat_format.read_back(chunks, BYTE_BPE)


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 50 or more words that repeat."""
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op7_ann")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th vector, among all rows."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    """The clustering in SQL: one assignment and one update per round."""
    gap = "list_sum(list_transform(list_zip(v.p, c.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = f"SELECT v.r, CAST(min({gap} * 1000 + c.c) AS BIGINT) AS q FROM v CROSS JOIN {{}} c GROUP BY v.r"
    steps = [r"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, p) - 1 AS c, p FROM (
    SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, p FROM v ORDER BY h, p LIMIT {k}))"""]
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({near.format(f"c{i}")}),
c{i + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.p, c.p) AS p FROM c{i} c LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS p FROM (
      SELECT c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (
        SELECT q % 1000 AS c, unnest(v.p) AS x, generate_subscripts(v.p, 1) AS i FROM a{i} JOIN v USING (r)) GROUP BY c, i) GROUP BY c) m USING (c))""")
    return f"""WITH {", ".join(steps)},
f AS MATERIALIZED ({near.format(f"c{rounds}")})
SELECT vec_id, CAST(q % 1000 AS INTEGER) AS cluster, q // 1000 AS distance,
       CAST(sum(q // 1000) OVER (PARTITION BY q % 1000) AS BIGINT) AS cluster_inertia, CAST(sum(q // 1000) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM f JOIN v USING (r) JOIN c{rounds} c ON c.c = q % 1000"""


@query("op11_centroid_clustering", sql=kmeans_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64-component vectors in 40 clusters after five rounds."""
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_sharding")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8)


@query("op13_ranked_search", sql=r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
s AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
q AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
f AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term) CROSS JOIN s),
m AS (SELECT r, doc_id, 100 - 50 + (50 * len(t) * n) // l AS m FROM d CROSS JOIN s),
x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item, among all documents."""
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
