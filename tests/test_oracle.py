"""Registered queries against their DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from quarry.plans import registry
from quarry.sources.tables import TABLES

registry.load_all()

SAMPLE = ["f10_pooled_band", "e14_dose_error_rates", "e26_diagnosis_combinations", "b24_weight_band",
          "c3_cohort_attrition", "f3_prior_counts", "f5_session_gaps", "e32_feedback_success", "e37_transitions",
          "d2_enrichment_chain", "i3_repeated_blocks", "b7_dense_row_key", "h5_merge_duplicates",
          "n1_item_similarity", "m1_hop_distance", "j14_word_count_unicode", "l2_bigram_phrases",
          "l9_lexicon_polarity", "t8_mann_whitney", "t9_kruskal_wallis", "o18_roc_pr_auc", "o15_stratified_folds",
          "e19_item_moments", "p2_dedup_stream", "o6_rasch_pair_counts"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf, con, name):
    df = registry.QUERIES[name](spark, sf)
    cur = con.execute(registry.ORACLE[name])
    dnames = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dnames)
    order = sorted(df.columns)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    idx = [dnames.index(c) for c in order]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert a == b


def test_every_query_has_a_callable_and_most_have_sql():
    assert len(registry.QUERIES) >= 150
    assert len(registry.ORACLE) >= 0.85 * len(registry.QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
