"""The domain views of ``views.py`` as DuckDB SQL, for the oracle.

``with_views('admissions', 'attempts')`` returns a ``WITH`` prefix holding
the named views (and whatever they depend on), so oracle queries read
``FROM admissions`` exactly as the Spark side reads ``Views.admissions``.
"""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_SURVEY_ITEMS = ",\n".join(
    f"  CAST(1 + greatest(0, least(4, CAST(floor((CAST(embedding[{i + 1}] AS DOUBLE) + 0.25) * 10) AS INTEGER))) AS INTEGER) AS i{i + 1}"
    for i in range(20)
)

_WEIGHTS = ",\n".join(
    f"  max(CASE WHEN l_linenumber = {i} THEN l_quantity END) AS weight_{i},\n"
    f"  CASE WHEN max(CASE WHEN l_linenumber = {i} THEN l_quantity END) IS NULL THEN NULL "
    f"WHEN max(CASE WHEN l_linenumber = {i} THEN l_quantity END) > 25 THEN 'g' ELSE 'kg' END AS unit_{i},\n"
    f"  CAST(min(CASE WHEN l_linenumber = {i} THEN l_shipdate END) AS DATE) AS date_{i}"
    for i in range(1, 8)
)

VIEW_SQL: dict[str, str] = {
    "attempts": f"""
SELECT user_id, event_id, ts,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS session,
  event_type AS question,
  value AS time_s,
  {_K} AS k,
  CAST({_K} % 2 AS INTEGER) AS correct,
  CAST({_K} % 3 AS INTEGER) AS feedback,
  CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS INTEGER) AS try_no
FROM events""",
    "profiles": """
SELECT c_custkey AS user_id, c_name AS name,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS cadre,
  CAST(c_custkey % 2 AS INTEGER) AS arm,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(floor(abs(c_acctbal) / 500) AS BIGINT) END AS experience,
  c_nationkey AS country, c_acctbal AS balance
FROM customer""",
    "admissions": """
SELECT o.o_orderkey AS adm_id, o.o_custkey AS patient, n.n_name AS hospital, n.n_regionkey AS region,
  c.c_mktsegment AS ward, o.o_orderdate AS adm_time, CAST(o.o_orderdate AS DATE) AS adm_date,
  fs.discharge_time,
  o.o_orderstatus = 'F' AS dead,
  0.5 + (o.o_totalprice % 4500) / 1000 AS weight_kg,
  CASE WHEN o.o_totalprice < 166800.0 THEN 'Under' WHEN o.o_totalprice < 334700.0 THEN 'Correct' ELSE 'Over' END AS dose_class,
  o.o_orderkey % 2 = 0 AS dx_sepsis,
  o.o_orderkey % 3 = 0 AS dx_prematurity,
  o.o_orderkey % 5 = 0 AS dx_jaundice,
  o.o_orderkey % 7 = 0 AS dx_asphyxia,
  CAST(o.o_custkey % 29 AS INTEGER) AS age_days,
  CAST(24 + o.o_orderkey % 19 AS INTEGER) AS gest_weeks,
  CAST(o.o_orderkey % 11 AS INTEGER) AS apgar,
  34.0 + (o.o_totalprice % 60) / 10 AS temp_c,
  o.o_totalprice AS price, o.o_orderpriority AS priority, o.o_orderstatus AS status
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS discharge_time FROM lineitem GROUP BY l_orderkey) fs
  ON o.o_orderkey = fs.l_orderkey""",
    "signs": """
SELECT o_orderkey AS adm_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Empty' END AS floppy,
  CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'No' WHEN 3 THEN 'Empty' END AS convulsions,
  CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' WHEN 3 THEN 'No' WHEN 5 THEN 'empty' END AS indrawing,
  CASE o_orderkey % 7 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' WHEN 3 THEN 'No' WHEN 4 THEN 'Yes' END AS grunting,
  CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS jaundice
FROM orders""",
    "diag_text": """
SELECT p_partkey AS adm_id,
  CASE WHEN p_partkey % 10 = 0 THEN ''
       WHEN p_partkey % 10 = 1 THEN concat_ws(';', p_type, p_type, p_brand)
       WHEN p_partkey % 10 = 2 THEN concat_ws(';;', p_name, ' ', p_brand)
       ELSE concat_ws(';', p_type, p_name, p_brand) END AS diagnoses,
  p_type AS dx_a, p_name AS dx_b, p_brand AS dx_c
FROM part""",
    "weights_wide": f"""
SELECT l_orderkey AS adm_id,
{_WEIGHTS}
FROM lineitem GROUP BY l_orderkey""",
    "ratings": """
SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) AS rating
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, l.l_partkey""",
    "edges": """
SELECT l_suppkey AS src, l_partkey + 1000000000 AS dst FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
UNION ALL
SELECT l_partkey + 1000000000 AS src, l_suppkey AS dst FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)""",
    "posts": """
SELECT d.doc_id AS id, d.source AS handle, d.text, d.lang,
  TIMESTAMP '2020-04-18 00:00:00' + d.doc_id * INTERVAL 1 MINUTE AS ts,
  CASE WHEN f.orig_id < d.doc_id THEN f.orig_id END AS retweeted,
  d.n_chars % 100 AS likes, d.doc_id % 7 AS retweets
FROM documents d JOIN (SELECT text, min(doc_id) AS orig_id FROM documents GROUP BY text) f ON d.text = f.text""",
    "survey": f"""
SELECT vec_id AS user_id, CAST(label % 2 AS INTEGER) AS platform, CAST(label % 4 AS INTEGER) AS klass, label,
{_SURVEY_ITEMS}
FROM embeddings""",
    "scored": """
SELECT l.doc_id, d.lang, d.source, l.quality AS y, l.toxic, (d.n_chars % 997 + 0.5) / 998 AS p
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "cases": """
SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(l_returnflag = 'R' AS INTEGER) AS y,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS quantity,
  l_extendedprice AS price, l_discount AS discount, l_tax AS tax,
  l_suppkey AS site, CAST(l_suppkey % 5 AS INTEGER) AS stratum, l_shipdate AS ts
FROM lineitem""",
}

_DEPS: dict[str, tuple[str, ...]] = {}


def with_views(*names: str) -> str:
    seen: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, ()):
            add(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in seen) + "\n"
