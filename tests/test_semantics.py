"""Edge cases where the obvious Spark default differs from the analyses."""

import math

from pyspark.sql import functions as F

from quarry.functions.columns import cut, level_rank, row_mean, rules, value_map, yes_no
from quarry.operators import aggregate as agg
from quarry.operators import recode, windows


def test_cut_is_right_closed_and_drops_lowest_edge(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (7.0,), (7.5,)], "x double")
    out = [r[0] for r in df.select(cut("x", [0, 1, 7, 28], ["a", "b", "c"]).alias("b")).collect()]
    assert out == [None, "a", "b", "b", "c"]
    inc = [r[0] for r in df.select(cut("x", [0, 1, 7, 28], ["a", "b", "c"], include_lowest=True)).collect()]
    assert inc[0] == "a"


def test_rules_later_win_and_null_predicate_is_false(spark):
    df = spark.createDataFrame([(1, None), (5, 1), (9, 1)], "x int, y int")
    r = rules("none", [(F.col("x") > 2, "big"), (F.col("y") == 1, "flag"), (F.col("x") > 8, "huge")])
    assert [t[0] for t in df.select(r).collect()] == ["none", "flag", "huge"]


def test_value_map_is_simultaneous(spark):
    df = spark.createDataFrame([(9,), (7,), (6,), (3,)], "x int")
    out = [r[0] for r in df.select(value_map("x", {9: 12, 8: 10, 7: 9, 6: 7})).collect()]
    assert out == [12, 9, 7, 3]          # 7 -> 9 does not cascade on to 12


def test_yes_no_keeps_null(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,)], "s string")
    assert [r[0] for r in df.select(yes_no("s")).collect()] == [True, False, None]


def test_corrected_skew_and_kurtosis_match_pandas(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double").withColumn("g", F.lit(1))
    r = agg.moments(df, ["g"], "v").first()
    assert abs(r["skew"] - 1.763632) < 1e-5
    assert abs(r["kurt"] - 3.228) < 1e-5


def test_zscore_divisors(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    pop = recode.standardise(df, ["v"], ddof=0).agg(F.max("v_z")).first()[0]
    samp = recode.standardise(df, ["v"], ddof=1).agg(F.max("v_z")).first()[0]
    assert abs(pop - 1.6970563) < 1e-6 and abs(samp - 1.4696938) < 1e-6


def test_unicode_word_split_keeps_accents(spark):
    from quarry.operators.text import words
    df = spark.createDataFrame([("L'été à Zürich, naïve_test!",)], "t string")
    assert df.select(words("t")).first()[0] == ["l", "été", "à", "zürich", "naïve_test"]


def test_percentile_is_type7(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double").withColumn("g", F.lit(0))
    q = agg.quantiles_by(df, ["g"], "v").first()
    assert (q["q1"], q["median"], q["q3"]) == (1.75, 2.5, 3.25)


def test_session_gap_modes(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 600.0), (1, "2024-01-01 02:00:00", 60.0)],
                               "u int, s string, d double").withColumn("s", F.to_timestamp_ntz("s"))
    ref = windows.session_gaps(df, ["u"], "s", "d", "s").orderBy("s").collect()
    assert ref[0]["gap_type"] == "None" and abs(ref[0]["gap_log"] - math.log(0.01)) < 1e-6
    assert ref[1]["gap_min"] == 130.0 and ref[1]["gap_type"] == "Spaced"
    idle = windows.session_gaps(df, ["u"], "s", "d", "s", mode="idle").orderBy("s").collect()
    assert idle[1]["gap_min"] == 110.0


def test_normalised_gain_bounds(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 10.0), (4.0, 7.0), (8.0, 4.0)], "a double, b double")
    g = [r[0] for r in df.select(windows.normalised_gain("a", "b", 10)).collect()]
    assert g == [0.0, 0.0, 0.5, -0.5]


def test_argmax_ties_to_larger_id(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7)], "id int, n int")
    r = agg.argmax_record(df, "n", "id").first()
    assert (r["id"], r["n"]) == (3, 7)


def test_row_mean_null_aware(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(row_mean(["a", "b", "c"])).collect()] == [2.0, None]


def test_level_rank(spark):
    df = spark.createDataFrame([("low",), ("high",), ("mid",), ("x",)], "s string")
    assert [r[0] for r in df.select(level_rank("s", ["low", "mid", "high"])).collect()] == [1, 3, 2, 0]


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (1, 3), (1, 2), (1, 5)], "g int, v int")
    assert agg.mode_value(df, ["g"], "v").first()["mode"] == 2


def test_three_valued_composite(spark):
    df = spark.createDataFrame([(True, None, None), (False, None, None), (None, None, None)],
                               "a boolean, b boolean, c boolean")
    out = [r[0] for r in df.select(recode.composite_sign(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert out == [True, False, None]


def test_containment_match_finds_the_passage_at_any_place(spark, monkeypatch):
    from quarry.operators import joins
    line = "wash your hands and stay at home today"            # 38 characters, the first 30 count
    rows = [(10, "who", line + " please"), (4, "who", "RT @x: " + line[:30]), (2, "cdc", line), (7, "who", line[:29] + "!"),
            (20, "who", "stay at"), (21, "who", "caf\u00e9 \U0001f600 open"), (22, "who", "the caf\u00e9 \U0001f600 opens"),
            (30, "far", "z" * 5000 + line), (31, "far", line + " again"), (32, "far", None), (33, None, line), (34, "one", line),
            (40, "void", ""), (41, "void", "anything")]
    df = spark.createDataFrame(rows, "id long, handle string, text string")
    got = {r.id: r.matched_id for r in joins.containment_match(df, df, "handle", "text", "id", 30).collect()}
    assert got == {10: 4, 20: 4, 21: 22, 31: 30, 40: 41}
    monkeypatch.setattr(joins, "PIECE", 64)                     # passages across pieces of a text
    again = {r.id: r.matched_id for r in joins.containment_match(df, df, "handle", "text", "id", 30).collect()}
    assert again == got
    assert joins.containment_match(df.limit(0), df, "handle", "text", "id", 30).count() == 0


def test_short_texts_are_looked_up_together(monkeypatch):
    import numpy as np

    from quarry.operators import joins
    wanted = ["stay at home today", "wash your hands"]
    passages = joins._Passages([len(w) for w in wanted], 17)
    filled = np.zeros((1 << 17) // 8, np.uint8)
    for slot in [s for w in wanted for s in passages.slots(w, 5)]:
        filled[slot >> 3] |= 1 << (slot & 7)
    pieces = [f"{i} {wanted[i % 2]} {i}" for i in range(50)] + ["wash your", " hands", wanted[0]]
    calls, hashes = [], joins._Passages._hashes
    monkeypatch.setattr(joins._Passages, "_hashes", lambda *a: calls.append(1) or hashes(*a))
    text, got = "".join(pieces), []
    for n, places in passages.found(pieces, [5] * 52 + [-5], filled):          # the last by another salt
        got += [text[i:i + n] for i in places.tolist() if text[i:i + n] in wanted]
    assert sorted(got) == sorted(wanted * 25)                                   # none across pieces
    assert len(calls) == 3                                                      # heads and two lengths, not a call a text
