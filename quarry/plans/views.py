"""Domain views over the driver tables (Spark side).

Each view re-reads a driver table under the names the analysis jobs expect
(learner attempts, clinical admissions, ratings, graph edges, posts, survey
items, scored predictions, risk cases).  ``views_sql.py`` holds the same
definitions as DuckDB SQL for the oracle.  Missing values are planted by
fixed modulo rules so that both engines agree; they only shape the *inputs*,
every query then runs over the whole view.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import day_start
from quarry.sources.tables import Tables

# Fixed values of the fixture rules (shared with views_sql.py).
DOSE_CUTS = (166800.0, 334700.0)
POST_EPOCH = "2020-04-18 00:00:00"
ITEM_COUNT = 20


class Views:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.t = Tables(spark, root)

    # ---------------------------------------------------------------- learning app
    @cached_property
    def attempts(self) -> DataFrame:
        """Learner attempts: one row per answer, tries not numbered."""
        e = self.t.events
        k = F.get_json_object("props", "$.k").cast("int")
        return (
            e.select(
                "user_id", "event_id", "ts",
                day_start("ts").alias("session"),
                F.col("event_type").alias("question"),
                F.col("value").alias("time_s"),
                k.alias("k"),
            )
            .withColumn("correct", (F.col("k") % 2).cast("int"))
            .withColumn("feedback", (F.col("k") % 3).cast("int"))
        )

    @cached_property
    def tries(self) -> DataFrame:
        """Attempts with ``try_no`` numbered within (user, session, question)
        by the total order (ts, event_id); no group is held by one task."""
        from quarry.functions.ordered import running_index
        return running_index(self.attempts, ["user_id", "session", "question"], ["ts", "event_id"], "try_no") \
            .withColumn("try_no", F.col("try_no").cast("int"))

    @cached_property
    def profiles(self) -> DataFrame:
        c = self.t.customer
        masked = (F.col("c_custkey") % 7) == 0
        return c.select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.when(masked, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("cadre"),
            (F.col("c_custkey") % 2).cast("int").alias("arm"),
            F.when(masked, F.lit(None))
            .otherwise(F.floor(F.abs("c_acctbal") / 500)).alias("experience"),
            F.col("c_nationkey").alias("country"),
            F.col("c_acctbal").alias("balance"),
        )

    # ---------------------------------------------------------------- clinical
    @cached_property
    def first_ship(self) -> DataFrame:
        """Earliest shipment per order: partial aggregation before the join."""
        return self.t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("discharge_time"))

    @cached_property
    def admissions(self) -> DataFrame:
        o, c = self.t.orders, self.t.customer
        # nation has a fixed 25 rows: a broadcast with a proven bound.
        n = F.broadcast(self.t.nation.select("n_nationkey", "n_name", "n_regionkey"))
        price = F.col("o_totalprice")
        dose = (F.when(price < DOSE_CUTS[0], "Under")
                .when(price < DOSE_CUTS[1], "Correct").otherwise("Over"))
        base = (
            o.join(c.select("c_custkey", "c_nationkey", "c_mktsegment"),
                   o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.first_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )
        return base.select(
            F.col("o_orderkey").alias("adm_id"),
            F.col("o_custkey").alias("patient"),
            F.col("n_name").alias("hospital"),
            F.col("n_regionkey").alias("region"),
            F.col("c_mktsegment").alias("ward"),
            F.col("o_orderdate").alias("adm_time"),
            F.to_date("o_orderdate").alias("adm_date"),
            F.col("discharge_time"),
            (F.col("o_orderstatus") == "F").alias("dead"),
            (F.lit(0.5) + (price % 4500) / 1000).alias("weight_kg"),
            dose.alias("dose_class"),
            ((F.col("o_orderkey") % 2) == 0).alias("dx_sepsis"),
            ((F.col("o_orderkey") % 3) == 0).alias("dx_prematurity"),
            ((F.col("o_orderkey") % 5) == 0).alias("dx_jaundice"),
            ((F.col("o_orderkey") % 7) == 0).alias("dx_asphyxia"),
            (F.col("o_custkey") % 29).cast("int").alias("age_days"),
            (F.lit(24) + F.col("o_orderkey") % 19).cast("int").alias("gest_weeks"),
            (F.col("o_orderkey") % 11).cast("int").alias("apgar"),
            (F.lit(34.0) + (price % 60) / 10).alias("temp_c"),
            price.alias("price"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def signs(self) -> DataFrame:
        k = F.col("o_orderkey")

        def code(mod, table):
            out = None
            for rem, val in table.items():
                cond = (k % mod) == rem
                v = F.lit(val).cast("string")
                out = F.when(cond, v) if out is None else out.when(cond, v)
            return out

        return self.t.orders.select(
            k.alias("adm_id"),
            code(4, {0: "Yes", 1: "No", 2: "Empty"}).alias("floppy"),
            code(5, {0: "Yes", 1: "No", 2: "No", 3: "Empty"}).alias("convulsions"),
            code(6, {0: "Yes", 1: "Yes", 2: "No", 3: "No", 5: "empty"}).alias("indrawing"),
            code(7, {0: "No", 1: "Yes", 2: "No", 3: "No", 4: "Yes"}).alias("grunting"),
            code(3, {0: "Yes", 1: "No"}).alias("jaundice"),
        )

    @cached_property
    def diag_text(self) -> DataFrame:
        p = self.t.part
        k = F.col("p_partkey")
        txt = (F.when(k % 10 == 0, F.lit(""))
               .when(k % 10 == 1, F.concat_ws(";", "p_type", "p_type", "p_brand"))
               .when(k % 10 == 2, F.concat_ws(";;", "p_name", F.lit(" "), "p_brand"))
               .otherwise(F.concat_ws(";", "p_type", "p_name", "p_brand")))
        return p.select(k.alias("adm_id"), txt.alias("diagnoses"),
                        F.col("p_type").alias("dx_a"), F.col("p_name").alias("dx_b"),
                        F.col("p_brand").alias("dx_c"))

    @cached_property
    def weights_wide(self) -> DataFrame:
        """Repeated measures held wide: weight_i, unit_i, date_i for i=1..7."""
        li = self.t.lineitem
        levels = list(range(1, 8))
        agg = (li.groupBy("l_orderkey").pivot("l_linenumber", levels)
               .agg(F.max("l_quantity").alias("w"), F.min("l_shipdate").alias("d")))
        cols = [F.col("l_orderkey").alias("adm_id")]
        for i in levels:
            w = F.col(f"{i}_w")
            cols += [
                w.alias(f"weight_{i}"),
                F.when(w.isNull(), F.lit(None)).when(w > 25, "g").otherwise("kg").alias(f"unit_{i}"),
                F.to_date(F.col(f"{i}_d")).alias(f"date_{i}"),
            ]
        return agg.select(*cols)

    # ---------------------------------------------------------------- ratings / graph
    @cached_property
    def ratings(self) -> DataFrame:
        li = self.t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
        o = self.t.orders.select("o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
                .agg(F.avg("l_quantity").alias("rating")))

    @cached_property
    def edges(self) -> DataFrame:
        """Supplier-part graph, both directions; part ids offset to keep the
        two node sets apart."""
        li = self.t.lineitem.select("l_suppkey", "l_partkey").distinct()
        part_node = F.col("l_partkey") + F.lit(1_000_000_000)
        a = li.select(F.col("l_suppkey").alias("src"), part_node.alias("dst"))
        b = li.select(part_node.alias("src"), F.col("l_suppkey").alias("dst"))
        return a.unionByName(b)

    # ---------------------------------------------------------------- posts
    @cached_property
    def posts(self) -> DataFrame:
        d = self.t.documents
        # equal texts by a 128-bit digest: no text is shuffled as a key
        keyed = d.withColumn("_digest", F.unhex(F.md5(F.col("text").cast("binary"))))
        first = keyed.groupBy("_digest").agg(F.min("doc_id").alias("orig_id"))
        origin = keyed.select("doc_id", "_digest").join(first, "_digest").where("orig_id < doc_id").select("doc_id", "orig_id")
        ts = F.timestamp_add("MINUTE", F.col("doc_id"), F.to_timestamp_ntz(F.lit(POST_EPOCH)))
        return (d.join(origin, "doc_id", "left")
                .select(F.col("doc_id").alias("id"), F.col("source").alias("handle"), "text", "lang",
                        ts.alias("ts"),
                        F.col("orig_id").alias("retweeted"),
                        (F.col("n_chars") % 100).alias("likes"),
                        (F.col("doc_id") % 7).alias("retweets")))

    # ---------------------------------------------------------------- survey / models
    @cached_property
    def survey(self) -> DataFrame:
        e = self.t.embeddings
        items = []
        for i in range(ITEM_COUNT):
            x = F.col("embedding")[i].cast("double")
            v = F.lit(1) + F.greatest(F.lit(0), F.least(F.lit(4), F.floor((x + 0.25) * 10).cast("int")))
            items.append(v.cast("int").alias(f"i{i + 1}"))
        return e.select(F.col("vec_id").alias("user_id"),
                        (F.col("label") % 2).cast("int").alias("platform"),
                        (F.col("label") % 4).cast("int").alias("klass"),
                        F.col("label").alias("label"), *items)

    @cached_property
    def scored(self) -> DataFrame:
        lab, d = self.t.labels, self.t.documents
        return (lab.join(d.select("doc_id", "n_chars", "lang", "source"), "doc_id")
                .select("doc_id", "lang", "source", F.col("quality").alias("y"),
                        F.col("toxic"),
                        ((F.col("n_chars") % 997 + 0.5) / 998).alias("p")))

    @cached_property
    def cases(self) -> DataFrame:
        li = self.t.lineitem
        masked = (F.col("l_orderkey") % 11) == 0
        return li.select(
            "l_orderkey", "l_linenumber", "l_partkey",
            (F.col("l_returnflag") == "R").cast("int").alias("y"),
            F.when(masked, F.lit(None)).otherwise(F.col("l_quantity")).alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("l_suppkey").alias("site"),
            (F.col("l_suppkey") % 5).cast("int").alias("stratum"),
            F.col("l_shipdate").alias("ts"),
        )
