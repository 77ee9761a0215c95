"""Language identification, toxicity and the pipeline."""

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import language_id, queries, simhash_dedup, toxicity
from quarry.llm.common import table

LINES = {"en": "the cat and the dog went with this to that house", "de": "der Hund und die Katze sind nicht mit dem Haus",
         "fr": "le chien et les chats dans la maison est pour une", "es": "el perro y los gatos en una casa para que se"}


def test_codewords_are_distinct_and_far_apart():
    for n in (1, 2, 3, 4, 5, 6, 20):
        code = language_id.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        if n > 2:
            gap = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
            assert gap >= 2 and all(0 < (c > 0).sum() <= n for c in code.T)


def language_rows():
    rows = [(i, f"{LINES[k]} {i} {LINES[k]}", k, "s") for i, k in enumerate(list(LINES) * 30)]
    return rows + [(900, None, "en", "s"), (901, "", None, "s"), (902, "12 %% !", "de", "s"), (903, "LE CHIEN " * 40000, None, "s"),
                   (0, LINES["de"], "de", "again"), (None, LINES["es"], "es", "no id")]


def test_language_of_small_texts(ship_llm):
    rows = language_rows()
    df = ship_llm.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, source string, score double")
    got = language_id.identify(df, language_id.learn(df)).collect()
    assert len(got) == len(rows)
    truth = {(r[0], r[2]) for r in rows if r[2] and r[1]}
    for r in got:
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score, r.ambiguous) == ("und", 0.0, False)
        elif r.doc_id == 903:
            assert r.lang_pred == "fr"
        else:
            assert (r.doc_id, r.lang_pred) in truth and 0 <= r.score <= 1
    nothing = language_id.identify(df, language_id.learn(df.limit(0))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language_id.identify(df.limit(0), language_id.learn(df)).count() == 0


def test_language_learns_only_from_rows_that_are_not_held_out(ship_llm):
    rows = [(i, LINES["en"], "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in range(60)]
    df = ship_llm.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.learn(df).languages == ["en"]


def test_long_text_margin_equals_one_pass():
    model = language_id.fit([LINES[k] * 3 for k in LINES], list(LINES))
    raw = np.frombuffer((LINES["fr"] * 12000).encode(), np.uint8)
    whole, keep = model.margins(raw, np.array([0, len(raw)])), language_id.CHUNK
    language_id.CHUNK = 10 ** 9
    once = model.margins(raw, np.array([0, len(raw)]))
    language_id.CHUNK = keep
    assert np.allclose(whole, once, atol=1e-3)


def test_language_on_held_out_rows(ship_llm, sf):
    rows = queries.op4(ship_llm, sf).join(table(ship_llm, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95


# ------------------------------------------------------------------ toxicity
def toxic_rows(rng, n):
    fine = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [fine[j] for j in rng.integers(0, 300, 40)]
        bad = i % 3 == 0
        if bad:
            for j in rng.integers(0, 40, 3):
                words[j] = ["idiot", "scumbag", "vermin"][int(rng.integers(3))]
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_planted_words(ship_llm):
    rows = toxic_rows(np.random.default_rng(1), 900)
    odd = [(2000, None), (2001, ""), (2002, "!!! 12"), (2003, "w1 w2 " * 60000 + "idiot scumbag vermin"), (0, "again"), (None, "idiot scumbag vermin")]
    df = ship_llm.createDataFrame([(i, t, "c") for i, t, _ in rows] + [(i, t, "c") for i, t in odd], "doc_id long, text string, score string")
    labels = ship_llm.createDataFrame([(i, 1, y) for i, _, y in rows] + [(3, 1, None), (4, 0, 7)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(df, labels)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id in truth and r.doc_id and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(truth[r.doc_id] == r.predicted for r in held) / len(held) > 0.95
    by_id = {r.doc_id: r.predicted for r in got if r.doc_id in (2000, 2001, 2002, 2003, None)}
    assert by_id[2003] == 1 and by_id[None] == 1 and by_id[2000] == by_id[2001] == by_id[2002] == 0
    again = {(r.doc_id, r.score) for r in toxicity.score(df, toxicity.learn(df, labels)).collect()}
    assert again == {(r.doc_id, r.score) for r in got}


def test_toxicity_thresholds_keep_the_mix_of_all_rows():
    """One clean row in ten scores as high as most toxic ones.  At the true mix
    (90 clean : 1 toxic) only the high cut is worth it; trained rows are 1 : 1."""
    at = {s: int(np.searchsorted(toxicity.CUTS, s, "right")) for s in (0.1, 0.6, 0.95)}
    counts = [(1, 0, False, at[0.1], 8100), (1, 0, False, at[0.6], 900), (1, 0, True, at[0.1], 100),
              (1, 1, False, at[0.6], 60), (1, 1, False, at[0.95], 40), (1, 1, True, at[0.95], 100)]
    cuts = toxicity.cuts_of(counts)
    assert 0.6 < cuts[1] <= 0.95 and len(set(cuts)) == 1
    even = [(k, y, t, s, n if y else n // 90) for k, y, t, s, n in counts]
    assert 0.1 < toxicity.cuts_of(even)[1] <= 0.6
    # toxic rows were trained on nine times in ten: the rest stand for them
    assert 0.1 < toxicity.cuts_of([(1, 0, False, at[0.1], 900), (1, 0, False, at[0.6], 100), (1, 1, False, at[0.6], 60),
                                   (1, 1, False, at[0.95], 40), (1, 1, True, at[0.95], 900)])[1] <= 0.6


def test_toxicity_thresholds_are_chosen_on_every_row_not_trained_on(ship_llm, monkeypatch):
    rows = toxic_rows(np.random.default_rng(2), 1500)
    df = ship_llm.createDataFrame([(i, t) for i, t, _ in rows] + [(7, "w1 again")], "doc_id long, text string")
    labels = ship_llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    seen, choose, per_class = [], toxicity.cuts_of, 50
    monkeypatch.setattr(toxicity, "PER_CLASS", per_class)
    monkeypatch.setattr(toxicity, "cuts_of", lambda counts: seen.extend(counts) or choose(counts))
    toxicity.learn(df, labels)
    ids = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 != 1] + [7] * (zlib.crc32(b"7") % 3 != 1)
    assert sum(n for *_, n in seen) == len(ids)
    trained = sum(n for _, _, t, _, n in seen if t)
    assert 0 < trained < 4 * per_class and len(ids) - trained > 700


def test_toxicity_with_one_class_or_no_label(ship_llm):
    df = ship_llm.createDataFrame([(i, "a b") for i in range(9)], "doc_id long, text string")
    ones = ship_llm.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(df, toxicity.learn(df, ones)).collect()} == {1.0}
    assert {r.score for r in toxicity.score(df, toxicity.learn(df, ones.limit(0))).collect()} == {0.0}
    assert toxicity.score(df.limit(0), toxicity.learn(df, ones)).count() == 0


def test_convolution_by_tables_equals_sliding_filters():
    model = toxicity.ToxicityModel()
    blobs = [t.encode() for t in ("one two three four", "", "two", "one one two five six seven")]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    words = toxicity.words_of(np.frombuffer(b"".join(blobs), np.uint8), offsets)
    got = model.pooled(words)
    for row in range(len(blobs)):
        at = np.flatnonzero(words.row == row)
        emb = model.word[words.word[at]] + model.stem[words.stem[at]]
        want = []
        for f in model.filters:
            places = [sum(emb[p + j] @ f[j] for j in range(len(f))) for p in range(len(emb) - len(f) + 1)]
            want.append(np.maximum(np.max(places, axis=0), 0) if places else np.zeros(toxicity.FILTERS))
        assert np.allclose(got[row], np.concatenate(want), atol=1e-5)


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_do_their_work(ship_llm, sf):
    docs = table(ship_llm, sf, "documents").cache()
    columns, text = docs.columns, "some words of a clean document that nobody else has written before"
    extra = ship_llm.createDataFrame([(10 ** 6, None, "en", "s", 0), (10 ** 6 + 1, "12 34", "en", "s", 5), (10 ** 6 + 2, text, "en", "s", len(text)),
                                      (10 ** 6 + 3, text, "en", "s", len(text)), (10 ** 6 + 2, text, "en", "s", len(text))], docs.schema)
    rows = docs.unionByName(extra)
    kept = corpus_pipeline.drop_unknown_language(ship_llm, rows, sf)
    assert kept.columns == columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 10 ** 6 not in ids and 10 ** 6 + 1 not in ids and ids.count(10 ** 6 + 2) == 2 and len(ids) >= docs.count()
    near = corpus_pipeline.drop_near_copies(ship_llm, rows, sf)
    classes = simhash_dedup.near_duplicates(rows)
    want = sorted({r.component_id for r in classes.collect()})
    assert near.columns == columns and sorted(r.doc_id for r in near.select("doc_id").collect()) == want
    cut = corpus_pipeline.drop_repeated_passages(ship_llm, rows, sf)
    assert cut.columns == columns and cut.count() == rows.count()
    bad = cut.where(F.length("text") != F.col("n_chars")).count() - rows.where(F.length("text") != F.col("n_chars")).count()
    assert bad <= 0
    toxic = corpus_pipeline.drop_toxic(ship_llm, rows, sf)
    assert toxic.columns == columns and toxic.count() < rows.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(ship_llm, rows.limit(0), sf).count() == 0


def test_pipeline_runs_through(ship_llm, sf):
    out = corpus_pipeline.run(ship_llm, sf)
    assert out.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset", "doc_tokens"} <= set(out.columns)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_stages_carry_columns_of_any_name(ship_llm, sf):
    docs = table(ship_llm, sf, "documents")
    names = ["predicted", "score", "lang_pred", "ambiguous", "n_words", "n_removed", "kept_text", "__id", "__hash", "id", "body", "own", "digest", "kept",
             "cut", "component_id", "fingerprint", "row"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names}).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = sorted(tuple(r) for r in stage(ship_llm, docs, sf).select("doc_id", "text", "n_chars").collect())
        out = stage(ship_llm, wide, sf)
        assert out.columns == wide.columns, name
        got = out.collect()
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names), name
        assert sorted((r.doc_id, r.text, r.n_chars) for r in got) == plain, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(ship_llm, wide, sf).count() == last(ship_llm, docs, sf).count()


def test_a_sample_draws_rows_that_share_an_id(ship_llm):
    from quarry.llm.training import sample_per_class
    rows = [(None, f"text {i}", "en") for i in range(3000)] + [(4, f"text {i}", "de") for i in range(3000)] + [(9, "same", "fr")] * 3000
    df = ship_llm.createDataFrame(rows, "id long, text string, lang string")
    got = {r.lang: r["count"] for r in sample_per_class(df, ["id", "text"], "lang", 300, 5).groupBy("lang").count().collect()}
    assert 200 < got["en"] < 400 and 200 < got["de"] < 400 and got.get("fr", 0) <= 1
    try:
        sample_per_class(df, ["id", "text"], "lang", 300, 2)
        raise AssertionError
    except ValueError:
        pass
