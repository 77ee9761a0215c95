"""Texts, ratings and rows are read once; nothing wide passes the driver."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import linear_grid as lg
from quarry.operators import text as tx
from quarry.operators import topics
from quarry.plans import q_misc
from quarry.plans.views import Views


@contextmanager
def conf(spark, **values):
    old = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "New York, new york; new"), (2, "new york is"), (2, "big new york"), (3, ""), (4, None), (5, "été"), (None, "york new york")]
    return spark.createDataFrame(rows, "id long, text string")


def test_bigram_counts_are_written_once(spark, docs):
    out = tx.bigram_phrases(docs, "id", "text", 3, 0.1)
    assert "split(" not in plan(out)
    # new 6, york 6, pairs (new, york) 5 and (york, new) 2; V = new york is big été
    assert [tuple(r) for r in out.collect()] == [("new", "york", 5, pytest.approx(2 * 5 / 36, abs=1e-6))]


def test_few_phrases_are_looked_up_without_a_shuffle_of_pairs(spark, docs):
    toks = docs.select("id", tx.words("text").alias("t"))
    phrases = spark.createDataFrame([("new", "york")], "a string, b string")
    with conf(spark, **{THRESHOLD: "-1"}):
        got = tx.phrase_positions(toks, "id", F.col("t"), phrases)
        assert "BroadcastHashJoin" in plan(got)
        assert {r.id: r.cand for r in got.collect()}[1] == [1, 3]


def test_term_counts_join_the_dictionary_where_the_rows_lie(spark, docs):
    with conf(spark, **{THRESHOLD: "-1"}):
        got = topics.term_counts(docs, "id", "text", ["is"], min_df=2)
        assert "SortMergeJoin" not in plan(got)
        rows = {(r.id, r.term, r.n) for r in got.collect()}
    assert rows == {(1, "new", 3), (1, "york", 2), (2, "new", 2), (2, "york", 2), (None, "york", 2), (None, "new", 1)}


def test_topic_weights_do_not_pass_the_driver(spark):
    counts = spark.createDataFrame([(d, f"w{(d * 7 + i) % 40}", 1) for d in range(30) for i in range(8)], "doc long, term string, n long")
    model = topics.fit_topics(counts, "doc", [topics.Setting(3)], passes=1)
    assert "BroadcastHashJoin" not in plan(topics._topic_weights(model))


def test_ratings_are_computed_once_for_all_layouts(spark, sf, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    once = F.udf(seen, "long").asNondeterministic()
    rows = spark.range(20).select(once("id").alias("user_id"), F.col("id").alias("item_id"), F.lit(3.5).alias("rating"))
    monkeypatch.setattr(Views, "ratings", property(lambda self: rows))
    got = {r.scan: r.n_rows for r in q_misc.a1_a6_text_scans(spark, sf).collect()}
    assert got["a1_colon"] == got["a1_whitespace"] == 20 and made.value == 20


def test_fold_fits_begin_at_the_fit_on_all_rows(spark, monkeypatch):
    rows = [(float((i * 37) % 101), float((i * 11) % 17), int((i * 37) % 101 + (i * 53) % 60 > 80), i % 5 + 1) for i in range(500)]
    table = spark.createDataFrame(rows, "a double, b double, y int, f int").coalesce(2)
    work, sums = [], lg._sums

    def counted(points, mean, sd, repeats, trials):
        work.append(len(trials))
        return sums(points, mean, sd, repeats, trials)

    monkeypatch.setattr(lg, "_sums", counted)
    grid = [lg.Setting("log", "l1", 1e-3), lg.Setting("log", "l2", 1e-3)]
    fits = lg.fit_grid(table, ["a", "b"], "y", grid, ["f"], 5)
    begun, work[:] = sum(work), []
    x = np.array([r[:2] for r in rows])
    jobs = [(f.setting, f.repeat, f.fold) for f in fits]
    zero = {i: np.zeros(3) for i in range(len(grid))}
    at, _, _ = lg._train(lg._points(table, ["a", "b"], "y", ["f"]), x.mean(axis=0), x.std(axis=0), grid, 1, jobs, zero, 100, 1e-9)
    assert all(f.converged for f in fits) and begun < 0.8 * sum(work)
    for f, j in zip(fits, jobs, strict=True):
        assert f.scaled == pytest.approx(at[j], rel=1e-6, abs=1e-8)
