"""Core relational queries: counts, sums, joins, set operations, reshape,
sorting and schema operations over the driver tables and views."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.columns import level_rank, r6
from quarry.operators import aggregate as agg
from quarry.operators import cohort, joins, recode, reshape, setops, windows
from quarry.plans.registry import register
from quarry.plans.views import Views
from quarry.plans.views_sql import with_views


# ----------------------------------------------------------------- E1-E5

@register("e1_count_by_quantity", "SELECT CAST(l_quantity AS BIGINT) AS quantity, count(*) AS n FROM lineitem GROUP BY 1")
def e1_count_by_quantity(spark, root):
    li = Views(spark, root).t.lineitem
    return agg.count_by(li.select(F.col("l_quantity").cast("long").alias("quantity")), ["quantity"]).orderBy("quantity")


@register("e2_spend_by_customer", """
SELECT o.o_custkey AS customer, round(sum(l.l_extendedprice), 4) AS total
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1""")
def e2_spend_by_customer(spark, root):
    v = Views(spark, root)
    j = v.t.lineitem.select("l_orderkey", "l_extendedprice").join(
        v.t.orders.select("o_orderkey", F.col("o_custkey").alias("customer")), F.col("l_orderkey") == F.col("o_orderkey"))
    s = agg.sum_by(j, ["customer"], "l_extendedprice", "total")
    return s.select("customer", F.round("total", 4).alias("total")).orderBy("total")


@register("e3_mean_by_segment", """
SELECT c_mktsegment AS segment, round(avg(c_acctbal), 6) AS mean_balance FROM customer GROUP BY 1""")
def e3_mean_by_segment(spark, root):
    c = Views(spark, root).t.customer.withColumnRenamed("c_mktsegment", "segment")
    return agg.mean_by(c, ["segment"], "c_acctbal", "mean_balance").select("segment", r6("mean_balance").alias("mean_balance"))


@register("e4_min_value_where", """
SELECT user_id, min(value) AS min_view_value FROM events WHERE event_type = 'view' GROUP BY 1""")
def e4_min_value_where(spark, root):
    e = Views(spark, root).t.events
    return agg.min_where(e, ["user_id"], "value", F.col("event_type") == "view", "min_view_value")


@register("e5_argmax_customer", """
SELECT o_custkey AS customer, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, customer DESC LIMIT 1""")
def e5_argmax_customer(spark, root):
    c = agg.count_by(Views(spark, root).t.orders.withColumnRenamed("o_custkey", "customer"), ["customer"])
    return agg.argmax_record(c, "n", "customer")


@register("e7_distinct_counts", """
SELECT o_orderstatus AS status, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1""")
def e7_distinct_counts(spark, root):
    o = Views(spark, root).t.orders
    return o.groupBy(F.col("o_orderstatus").alias("status")).agg(F.countDistinct("o_custkey").alias("n_customers"))


# ----------------------------------------------------------------- A9, C1, C2, C7

@register("a9_sql_temp_view", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 13 AND c_acctbal <= 1900""")
def a9_sql_temp_view(spark, root):
    c = Views(spark, root).t.customer
    name = f"people_{abs(hash(root)) % 10**8}"
    c.createOrReplaceTempView(name)
    return spark.sql(f"SELECT c_custkey, c_name, c_acctbal FROM {name} WHERE c_acctbal >= 13 AND c_acctbal <= 1900")


@register("c1_filters", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_totalprice BETWEEN 100000 AND 200000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""")
def c1_filters(spark, root):
    o = Views(spark, root).t.orders
    return o.filter(F.col("o_totalprice").between(100000, 200000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & ~F.col("o_orderstatus").isin("P")).select("o_orderkey", "o_orderpriority")


@register("c2_date_window", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-07-01 00:00:00'""")
def c2_date_window(spark, root):
    o = Views(spark, root).t.orders
    return cohort.date_window(o, "o_orderdate", "1997-01-01 00:00:00", "1997-07-01 00:00:00", closed_end=False) \
        .select("o_orderkey", "o_orderdate")


@register("c7_complete_cases", with_views("cases") + """
SELECT l_orderkey, l_linenumber, quantity, price FROM cases WHERE quantity IS NOT NULL AND price IS NOT NULL""")
def c7_complete_cases(spark, root):
    c = Views(spark, root).cases.select("l_orderkey", "l_linenumber", "quantity", "price")
    return cohort.complete_cases(c, ["quantity", "price"])


# ----------------------------------------------------------------- joins

@register("d1_inner_join", """
SELECT p.p_brand AS brand, count(*) AS n_lines, round(sum(l.l_quantity), 4) AS qty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1""")
def d1_inner_join(spark, root):
    t = Views(spark, root).t
    j = t.lineitem.select("l_partkey", "l_quantity").join(t.part.select("p_partkey", F.col("p_brand").alias("brand")),
                                                          F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("brand").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 4).alias("qty"))


@register("d2_enrichment_chain", """
SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def d2_enrichment_chain(spark, root):
    t = Views(spark, root).t
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    # nation (25 rows) and region (5 rows) are fixed-size dimensions
    out = joins.enrich(o, [(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_custkey"]),
                           (F.broadcast(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name",
                                                        "n_regionkey")), ["c_nationkey"]),
                           (F.broadcast(t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")),
                            ["n_regionkey"])])
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@register("d3_full_outer_join", """
SELECT coalesce(a.nation, b.nation) AS nation, a.rich_customers, b.indebted_suppliers FROM
 (SELECT c_nationkey AS nation, count(*) AS rich_customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1) a
FULL OUTER JOIN (SELECT s_nationkey AS nation, count(*) AS indebted_suppliers FROM supplier WHERE s_acctbal < 0 GROUP BY 1) b
ON a.nation = b.nation""")
def d3_full_outer_join(spark, root):
    t = Views(spark, root).t
    a = t.customer.filter(F.col("c_acctbal") > 9000).groupBy(F.col("c_nationkey").alias("nation")) \
        .agg(F.count(F.lit(1)).alias("rich_customers"))
    b = t.supplier.filter(F.col("s_acctbal") < 0).groupBy(F.col("s_nationkey").alias("nation")) \
        .agg(F.count(F.lit(1)).alias("indebted_suppliers"))
    return a.join(b, "nation", "full").select("nation", "rich_customers", "indebted_suppliers")


@register("d6_dimension_lookup", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""")
def d6_dimension_lookup(spark, root):
    t = Views(spark, root).t
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.lookup_dimension(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), dim, "l_partkey")


@register("d7_self_reference_fill", with_views("posts") + """
, p AS (SELECT id, retweeted, CASE WHEN retweeted IS NOT NULL THEN NULL ELSE lang END AS topic FROM posts)
SELECT a.id, a.retweeted, coalesce(b.topic, a.topic) AS topic FROM p a LEFT JOIN p b ON a.retweeted = b.id""")
def d7_self_reference_fill(spark, root):
    p = Views(spark, root).posts.select("id", "retweeted",
                                        F.when(F.col("retweeted").isNotNull(), F.lit(None)).otherwise(F.col("lang"))
                                        .alias("topic"))
    return joins.self_reference_fill(p, "id", "retweeted", ["topic"])


@register("d8_prefix_match", with_views("posts") + """
, p AS (SELECT id, handle, substr(text, 1, 30) AS pre FROM posts)
SELECT a.id, min(b.id) AS matched_id FROM p a JOIN p b ON a.handle = b.handle AND a.pre = b.pre AND a.id <> b.id GROUP BY a.id""")
def d8_prefix_match(spark, root):
    p = Views(spark, root).posts
    return joins.prefix_match(p, p, "handle", "text", "id", 30)


@register("d8_containment_match", with_views("posts") + """
SELECT a.id, min(b.id) AS matched_id FROM posts a JOIN posts b
  ON a.handle = b.handle AND contains(b.text, substr(a.text, 1, 30)) AND a.id <> b.id GROUP BY a.id""")
def d8_containment_match(spark, root):
    p = Views(spark, root).t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("handle"), "text")
    return joins.containment_match(p, p, "handle", "text", "id", 30)


@register("d10_bind_by_key", with_views("admissions", "signs") + """
SELECT a.adm_id, a.hospital, s.floppy FROM admissions a JOIN signs s USING (adm_id)""")
def d10_bind_by_key(spark, root):
    v = Views(spark, root)
    return joins.bind_columns(v.admissions.select("adm_id", "hospital"), v.signs.select("adm_id", "floppy"), "adm_id")


@register("d11_d12_different_key_names", with_views("profiles") + """
SELECT o.o_orderkey, p.name, p.cadre FROM orders o LEFT JOIN profiles p ON o.o_custkey = p.user_id""")
def d11_d12_different_key_names(spark, root):
    v = Views(spark, root)
    p = v.profiles
    j = v.t.orders.join(p, v.t.orders.o_custkey == p.user_id, "left")
    return j.select("o_orderkey", "name", "cadre")


# ----------------------------------------------------------------- sort / top-k

@register("g1_g2_top_customers", """
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment ASC, c_acctbal DESC, c_custkey LIMIT 20""")
def g1_g2_top_customers(spark, root):
    c = Views(spark, root).t.customer
    return windows.top_n(c.select("c_custkey", "c_mktsegment", "c_acctbal"),
                         [F.col("c_mktsegment").asc(), F.col("c_acctbal").desc(), "c_custkey"], 20)


@register("g4_level_order_sort", """
SELECT o_orderpriority, count(*) AS n,
  CAST(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) AS INTEGER) AS level
FROM orders GROUP BY 1""")
def g4_level_order_sort(spark, root):
    o = Views(spark, root).t.orders
    # Declared level order of the priority factor.
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    c = agg.count_by(o, ["o_orderpriority"])
    return c.withColumn("level", level_rank("o_orderpriority", levels)).orderBy("level")


@register("e34_keep_group_best", """
SELECT c_custkey, c_nationkey, c_acctbal FROM customer c
WHERE c_acctbal = (SELECT max(c_acctbal) FROM customer d WHERE d.c_nationkey = c.c_nationkey)""")
def e34_keep_group_best(spark, root):
    c = Views(spark, root).t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return agg.keep_group_best(c, ["c_nationkey"], "c_acctbal")


# ----------------------------------------------------------------- set operations

@register("h1_h2_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::INTEGER AS size, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier
UNION ALL SELECT p_partkey, p_name, NULL, p_size, 'part' FROM part""")
def h1_h2_union_by_name(spark, root):
    t = Views(spark, root).t
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return setops.union_tagged([(a, "customer"), (b, "supplier"), (c, "part")], "source")


@register("h3_distinct_subset", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def h3_distinct_subset(spark, root):
    return Views(spark, root).t.orders.dropDuplicates(["o_custkey", "o_orderstatus"]).select("o_custkey", "o_orderstatus")


@register("h4_intersect_except", """
SELECT 'both' AS part, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
UNION ALL SELECT 'only_f', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')""")
def h4_intersect_except(spark, root):
    o = Views(spark, root).t.orders
    f = o.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    op = o.filter(F.col("o_orderstatus") == "O").select("o_custkey")
    a = f.intersect(op).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("both"))
    b = f.subtract(op).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("only_f"))
    return a.unionByName(b).select("part", "n")


@register("h5_merge_duplicates", with_views("posts") + """
SELECT text, max(likes) AS likes, max(retweets) AS retweets, arg_min(handle, id) AS handle, min(id) AS id FROM posts GROUP BY text""")
def h5_merge_duplicates(spark, root):
    p = Views(spark, root).posts
    return setops.merge_duplicates(p, "text", max_cols=["likes", "retweets"], first_cols=["handle"], order="id") \
        .select("text", "likes", "retweets", "handle", "id")


@register("h6_drop_dangling", with_views("posts") + """
, p AS (SELECT id, CASE WHEN id % 5 = 0 THEN id + 100000000 ELSE retweeted END AS retweeted FROM posts)
SELECT a.id, CASE WHEN b.id IS NULL THEN NULL ELSE a.retweeted END AS retweeted FROM p a LEFT JOIN posts b ON a.retweeted = b.id""")
def h6_drop_dangling(spark, root):
    p = Views(spark, root).posts
    q = p.select("id", F.when(F.col("id") % 5 == 0, F.col("id") + 100000000).otherwise(F.col("retweeted")).alias("retweeted"))
    return setops.drop_dangling(q, p.select("id"), "retweeted", "id")


# ----------------------------------------------------------------- reshape

@register("i1_long_to_wide", """
SELECT o_custkey, round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 6) AS F,
  round(avg(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 6) AS O,
  round(avg(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 6) AS P FROM orders GROUP BY 1""")
def i1_long_to_wide(spark, root):
    w = reshape.long_to_wide(Views(spark, root).t.orders, ["o_custkey"], "o_orderstatus", "o_totalprice", ["F", "O", "P"])
    return w.select("o_custkey", *[r6(c).alias(c) for c in ("F", "O", "P")])


@register("i2_i5_wide_to_long", with_views("survey") + " SELECT user_id, 'i1' AS item, i1 AS score FROM survey"
          + "".join(f" UNION ALL SELECT user_id, 'i{i}', i{i} FROM survey" for i in range(2, 21)))
def i2_i5_wide_to_long(spark, root):
    s = Views(spark, root).survey
    return reshape.wide_to_long(s, ["user_id"], [f"i{i}" for i in range(1, 21)], "item", "score")


@register("i3_repeated_blocks", with_views("weights_wide") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT adm_id, {i} AS iteration, weight_{i} AS weight, unit_{i} AS unit, date_{i} AS date FROM weights_wide"
    for i in range(1, 8)) + ") WHERE weight IS NOT NULL OR unit IS NOT NULL OR date IS NOT NULL")
def i3_repeated_blocks(spark, root):
    return reshape.repeated_blocks(Views(spark, root).weights_wide, ["adm_id"], ["weight", "unit", "date"])


@register("i4_spread_fill_zero", with_views("admissions") + """
, c AS (SELECT CAST(year(adm_date) AS INTEGER) AS year, priority, count(*) AS n FROM admissions WHERE dead GROUP BY 1, 2),
g AS (SELECT y.year, p.priority FROM (SELECT DISTINCT year FROM c) y, (SELECT DISTINCT priority FROM c) p)
SELECT g.year, g.priority, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (year, priority)""")
def i4_spread_fill_zero(spark, root):
    a = Views(spark, root).admissions.filter(F.col("dead"))
    c = agg.count_by(a.select(F.year("adm_date").alias("year"), "priority"), ["year", "priority"])
    return reshape.fill_grid(c, ["year", "priority"], "n", 0)


@register("i6_measured_count", with_views("weights_wide") + """
, l AS (""" + " UNION ALL ".join(f"SELECT adm_id, weight_{i} AS w FROM weights_wide" for i in range(1, 8)) + """)
SELECT adm_id, count(w) AS n_measured, count(w) > 1 AS measured_multiple FROM l GROUP BY 1""")
def i6_measured_count(spark, root):
    w = Views(spark, root).weights_wide
    long = reshape.wide_to_long(w, ["adm_id"], [f"weight_{i}" for i in range(1, 8)], "k", "w")
    return reshape.measured_count(long, "adm_id", "w")


# ----------------------------------------------------------------- schema ops

@register("b1_b3_rename_drop", with_views("signs") + """
SELECT adm_id, floppy AS "Floppy.Infant", convulsions AS "Convulsions", grunting AS "Grunting" FROM signs""")
def b1_b3_rename_drop(spark, root):
    s = Views(spark, root).signs
    s = recode.drop_like(s, r"^(indrawing|jaundice)$")
    return recode.rename(s, {"floppy": "Floppy.Infant", "convulsions": "Convulsions", "grunting": "Grunting"})


@register("b2_select_by_pattern", with_views("weights_wide") + """
SELECT adm_id, weight_1, weight_2, weight_3, weight_4, weight_5, weight_6, weight_7 FROM weights_wide""")
def b2_select_by_pattern(spark, root):
    return recode.select_like(Views(spark, root).weights_wide, keep=["adm_id"], startswith="weight_")


@register("b4_cast_by_pattern", with_views("weights_wide") + """
SELECT adm_id, TRY_CAST(weight_1 AS DOUBLE) AS weight_1, unit_1, TRY_CAST(date_1 AS DATE) AS date_1,
  CAST(weight_2 AS VARCHAR) AS weight_2_doc FROM weights_wide""")
def b4_cast_by_pattern(spark, root):
    w = Views(spark, root).weights_wide
    s = w.select(F.col("adm_id"), F.col("weight_1").cast("string").alias("weight_1"), "unit_1",
                 F.col("date_1").cast("string").alias("date_1"), F.col("weight_2").cast("string").alias("weight_2_doc"))
    return recode.cast_by_pattern(s, [(r"^date_", "date"), (r"^weight_", "double")], exclude=r"_(doc|units|complete)$")


@register("b6_sanitise_label_last", with_views("cases") + """
SELECT y, l_orderkey AS "l_orderkey", quantity AS "qty_per_item", price FROM cases""")
def b6_sanitise_label_last(spark, root):
    c = Views(spark, root).cases.select("y", "l_orderkey", F.col("quantity").alias("qty/per item"), "price")
    return recode.sanitise_names(c, label="y").select("y", "l_orderkey", "qty_per_item", "price")


@register("b7_dense_row_key", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS row_key FROM orders""")
def b7_dense_row_key(spark, root):
    o = Views(spark, root).t.orders.select("o_orderkey", "o_orderdate")
    return recode.dense_row_key(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_key")


# ----------------------------------------------------------------- survey summaries

_ITEMS = [f"i{i}" for i in range(1, 21)]


@register("e9_side_by_side_summary", with_views("survey") + """
SELECT klass, count(i1) AS pre_n, round(avg(i1), 6) AS pre_mean, round(stddev_samp(i1), 6) AS pre_sd,
  count(i2) AS post_n, round(avg(i2), 6) AS post_mean, round(stddev_samp(i2), 6) AS post_sd FROM survey GROUP BY klass""")
def e9_side_by_side_summary(spark, root):
    s = Views(spark, root).survey
    a = agg.describe_by(s, ["klass"], "i1", "pre_").select("klass", "pre_n", "pre_mean", "pre_sd")
    b = agg.describe_by(s, ["klass"], "i2", "post_").select("klass", "post_n", "post_mean", "post_sd")
    return a.join(b, "klass")


@register("e10_mean_se_ci", with_views("survey") + """
SELECT platform, count(i3) AS n, round(avg(i3), 6) AS mean, round(stddev_samp(i3), 6) AS sd,
  round(stddev_samp(i3) / sqrt(count(i3)), 6) AS se, round(avg(i3) - 1.96 * stddev_samp(i3) / sqrt(count(i3)), 6) AS lo,
  round(avg(i3) + 1.96 * stddev_samp(i3) / sqrt(count(i3)), 6) AS hi FROM survey GROUP BY platform""")
def e10_mean_se_ci(spark, root):
    return agg.describe_by(Views(spark, root).survey, ["platform"], "i3")


@register("e11_crosstab_margins", with_views("survey") + """
SELECT coalesce(CAST(klass AS VARCHAR), 'All') AS klass, coalesce(CAST(platform AS VARCHAR), 'All') AS platform, count(*) AS n
FROM survey GROUP BY CUBE (klass, platform)""")
def e11_crosstab_margins(spark, root):
    return agg.crosstab_margins(Views(spark, root).survey, "klass", "platform")


@register("e12_crosstab_share", with_views("survey") + """
, c AS (SELECT klass, platform, count(*) AS n FROM survey GROUP BY 1, 2)
SELECT klass, platform, n, round(n / sum(n) OVER (PARTITION BY klass), 6) AS share FROM c""")
def e12_crosstab_share(spark, root):
    return agg.crosstab_share(Views(spark, root).survey, "klass", "platform", normalize="row")


@register("e13_share_of_total", with_views("survey") + """
SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM survey GROUP BY 1""")
def e13_share_of_total(spark, root):
    return agg.share_of_total(Views(spark, root).survey, ["label"])


@register("e18_mode_impute", with_views("survey") + """
, m AS (SELECT klass, arg_min(i4, (-n, i4)) AS mode FROM (SELECT klass, i4, count(*) AS n FROM survey GROUP BY 1, 2) GROUP BY 1)
SELECT s.user_id, coalesce(CASE WHEN s.user_id % 6 = 0 THEN NULL ELSE s.i4 END, m.mode) AS i4 FROM survey s JOIN m USING (klass)""")
def e18_mode_impute(spark, root):
    s = Views(spark, root).survey
    m = agg.mode_value(s, ["klass"], "i4", "mode")
    x = s.select("user_id", "klass", F.when(F.col("user_id") % 6 == 0, F.lit(None)).otherwise(F.col("i4")).alias("i4"))
    return x.join(m, "klass").select("user_id", F.coalesce("i4", "mode").alias("i4"))


@register("e19_item_moments", with_views("survey") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS item, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, "
    f"round(skewness({c}), 6) AS skew, round(kurtosis({c}), 6) AS kurt FROM survey" for c in _ITEMS[:6]) + ")")
def e19_item_moments(spark, root):
    s = Views(spark, root).survey
    long = reshape.wide_to_long(s, ["user_id"], _ITEMS[:6], "item", "v")
    return agg.moments(long, ["item"], "v")


@register("e20_correlation_pairs", with_views("survey") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS r, count(*) AS n FROM survey"
    for i, a in enumerate(_ITEMS[:5]) for b in _ITEMS[:5][i + 1:]) + ")")
def e20_correlation_pairs(spark, root):
    return agg.correlation_pairs(Views(spark, root).survey, _ITEMS[:5])


_LEVELS = [1, 2, 3, 4, 5]


@register("e38_likert_distribution", with_views("survey") + """
, l AS (""" + " UNION ALL ".join(f"SELECT platform, 'i{i}' AS item, i{i} AS level FROM survey" for i in range(1, 6)) + """),
g AS (SELECT p.platform, i.item, lv.level FROM (SELECT DISTINCT platform FROM l) p, (SELECT DISTINCT item FROM l) i,
      (VALUES (1), (2), (3), (4), (5)) lv(level)),
c AS (SELECT platform, item, level, count(*) AS n FROM l GROUP BY 1, 2, 3)
SELECT g.platform, g.item, g.level, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (platform, item, level)""")
def e38_likert_distribution(spark, root):
    s = Views(spark, root).survey
    long = reshape.wide_to_long(s, ["platform"], _ITEMS[:5], "item", "level")
    return agg.likert_distribution(long, ["platform", "item"], "level", _LEVELS)


@register("e39_subscale_by_class", with_views("survey") + """
, l AS (""" + " UNION ALL ".join(f"SELECT klass, platform, i{i} AS v FROM survey" for i in range(1, 11)) + """)
SELECT klass, platform, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd FROM l GROUP BY 1, 2""")
def e39_subscale_by_class(spark, root):
    s = Views(spark, root).survey
    long = reshape.wide_to_long(s, ["klass", "platform"], _ITEMS[:10], "item", "v")
    return long.groupBy("klass", "platform").agg(F.count("v").alias("n"), r6(F.avg("v")).alias("mean"),
                                                 r6(F.stddev_samp("v")).alias("sd"))


__all__ = ["T"]
