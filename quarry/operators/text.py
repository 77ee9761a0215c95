"""Text operators: cleaning, tokenising, keyword rules, word counts,
phrases, lexicon polarity and gazetteer entities.

All string work is JVM-side (``regexp_*``, ``split``, higher-order array
functions).  Whole texts are processed; token streams are exploded and
aggregated, so a long document only widens its own rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import col, r6
from quarry.operators.staged import for_lookup, written

WORD_SPLIT = r"(?U)\W+"          # Unicode-aware non-word run (Python's \W)

# Cleaning patterns for posts.
URL_RE = r"https?://[^ \t\n\r]+|www\.[^ \t\n\r]+"
HANDLE_RE = r"@[A-Za-z0-9_]+"
HASHTAG_RE = r"#([A-Za-z0-9_]+)"
ENTITY_RE = r"&(amp|lt|gt|quot|#39);"
EMOJI_RE = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F2FF}]"
CLOCK_RE = r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"
NUMBER_RE = r"^[0-9]+([.,][0-9]+)?$"
TZ_RE = r"^(utc|gmt|eat|cet|cest|est|pst|bst)$"


def clean_post(c: str | Column) -> Column:
    """Strip URLs, handles, '#' marks, HTML entities, emoji and line
    breaks; collapse blanks."""
    x = col(c)
    x = F.regexp_replace(x, URL_RE, " ")
    x = F.regexp_replace(x, HANDLE_RE, " ")
    x = F.regexp_replace(x, HASHTAG_RE, "$1")
    x = F.regexp_replace(x, ENTITY_RE, " ")
    x = F.regexp_replace(x, EMOJI_RE, "")
    x = F.regexp_replace(x, r"[\t\n\r]+", " ")
    x = F.regexp_replace(x, r" {2,}", " ")
    return F.trim(x)


def drop_numbers_times(c: str | Column) -> Column:
    """Whitespace tokens without numbers, clock times and time-zone
    codes, joined back with single blanks."""
    toks = F.split(F.trim(col(c)), r"[ \t\n\r]+")
    keep = F.filter(toks, lambda t: ~(t.rlike(NUMBER_RE) | t.rlike(CLOCK_RE) | F.lower(t).rlike(TZ_RE)) & (t != ""))
    return F.array_join(keep, " ")


def alnum_tokens(c: str | Column) -> Column:
    """ASCII alphanumeric tokens."""
    return F.regexp_extract_all(col(c), F.lit(r"([A-Za-z0-9]+)"), 1)


def split_camel(c: str | Column) -> Column:
    """J13: 'HelloWorld' -> 'Hello World'."""
    return F.regexp_replace(col(c), r"([a-z])([A-Z])", "$1 $2")


def words(c: str | Column, lower: bool = True) -> Column:
    """Unicode word tokens (empty tokens dropped)."""
    x = F.lower(col(c)) if lower else col(c)
    return F.array_remove(F.split(x, WORD_SPLIT), "")


def word_count(df: DataFrame, c: str, unicode: bool = True) -> DataFrame:
    """Word frequencies sorted by count.  ``unicode=False`` is
    the whitespace split with non-ASCII characters stripped."""
    if unicode:
        toks = words(c)
    else:
        toks = F.transform(F.split(col(c), r"[ \t\n\r\f]+"), lambda t: F.regexp_replace(t, r"[^\x00-\x7F]", ""))
        toks = F.filter(toks, lambda t: t != "")
    w = df.select(F.explode(toks).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def tags_text(c: str | Column, sigil: str) -> Column:
    """J16: '#tag' / '@name' occurrences joined by blanks."""
    return F.array_join(F.regexp_extract_all(col(c), F.lit(sigil + r"([A-Za-z0-9_]+)"), 1), " ")


def strip_units(c: str | Column, pattern: str, first_only: bool = True) -> Column:
    """Remove unit text and cast to double; ``first_only`` removes just
    the first match (R ``str_replace``), else every match."""
    x = col(c)
    if first_only:
        x = F.regexp_replace(x, rf"^(.*?)(?:{pattern})", "$1")
    else:
        x = F.regexp_replace(x, pattern, "")
    return F.trim(x).try_cast("double")


def first_integer(c: str | Column) -> Column:
    """The first run of digits, as an integer."""
    return F.regexp_extract(col(c), r"(\d+)", 1).try_cast("int")


def merge_text_fields(cols: Sequence[str | Column], strip: str | None = None, sep: str = ";") -> Column:
    """Join several text fields, strip codes, split, trim, drop blanks,
    de-duplicate (sorted for determinism) and join again."""
    x = F.concat_ws(sep, *[col(c) for c in cols])
    if strip:
        x = F.regexp_replace(x, strip, "")
    parts = F.filter(F.transform(F.split(x, sep), lambda t: F.trim(t)), lambda t: t != "")
    return F.array_join(F.array_sort(F.array_distinct(parts)), sep)


def checkbox_labels(flags: Mapping[str, Column]) -> Column:
    """Check-box columns to the list of ticked labels."""
    arr = F.array(*[F.when(cond, F.lit(label)) for label, cond in flags.items()])
    return F.filter(arr, lambda t: t.isNotNull())


def combine_labels(*arrays: Column) -> Column:
    """Union of several label lists: unique, non-empty, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.array_compact(F.concat(*arrays)), lambda t: t != "")))


def first_match_class(c: str | Column, rules: Sequence[tuple[str, str]], other: str = "Other") -> Column:
    """The label of the first pattern that matches."""
    x = col(c)
    out = None
    for pat, label in rules:
        out = F.when(x.rlike(pat), F.lit(label)) if out is None else out.when(x.rlike(pat), F.lit(label))
    return out.otherwise(F.lit(other))


def keyword_flags(tokens: Column, rules: Mapping[str, str]) -> dict[str, Column]:
    """One flag per label (any token matches its pattern), plus 'Other'
    (some token matched no label) and 'No Diagnosis' (no tokens)."""
    def matcher(p):
        return lambda t: t.rlike(p)

    flags = {label: F.exists(tokens, matcher(pat)) for label, pat in rules.items()}
    any_pat = "|".join(f"(?:{p})" for p in rules.values())
    flags["Other"] = F.exists(tokens, lambda t: ~t.rlike(any_pat))
    flags["No Diagnosis"] = F.size(tokens) == 0
    return flags


def any_column_contains(cols: Sequence[str | Column], pattern: str) -> Column:
    """Keyword found in any of the columns; null when all are null."""
    joined = F.concat_ws(" ", *[col(c) for c in cols])
    all_null = None
    for c in cols:
        t = col(c).isNull()
        all_null = t if all_null is None else all_null & t
    return F.when(all_null, F.lit(None).cast("boolean")).otherwise(joined.rlike(pattern))


def remove_stopwords(tokens: Column, stop: Sequence[str]) -> Column:
    """L1: drop stop words, keeping repeats and order."""
    s = F.array(*[F.lit(w) for w in stop])
    return F.filter(tokens, lambda t: ~F.array_contains(s, t))


def ngrams(tokens: Column, k: int) -> Column:
    """Word n-grams of a token array, built in-row (no shuffle)."""
    n = F.size(tokens) - k + 1
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                        lambda i: F.array_join(F.slice(tokens, i, k), " "))
    return F.when(n >= 1, grams).otherwise(F.array().cast("array<string>"))


def bigram_phrases(docs: DataFrame, id_col: str, text: str, min_count: int = 3,
                   threshold: float = 40.0) -> DataFrame:
    """L2: bigram phrase scores (a, b, n_ab, score) with
    score = (n_ab - min_count) * V / (n_a * n_b), V the vocabulary size;
    phrases are the pairs above ``threshold``.

    One row a word, with the word after it (null after the last), is counted
    by one partial aggregate: a word occurs as often as it begins such a row.
    The counts feed four branches and are written once, so texts are cut into
    words once."""
    toks = docs.select(words(text).alias("t")).where(F.size("t") > 0)
    after = F.concat(F.slice("t", 2, F.size("t")), F.array(F.lit(None).cast("string")))
    pairs = toks.select(F.explode(F.arrays_zip(F.col("t").alias("a"), after.alias("b"))).alias("p")).select("p.a", "p.b")
    counts = written(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    uni = written(counts.groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n")))
    vocab = uni.agg(F.count(F.lit(1)).alias("V"))
    bi = counts.filter(F.col("b").isNotNull() & (F.col("n") >= min_count)).select("a", "b", F.col("n").alias("n_ab"))
    from quarry.operators.aggregate import with_total
    j = (with_total(bi, vocab)
         .join(uni.select(F.col("w").alias("a"), F.col("n").alias("n_a")), "a")
         .join(uni.select(F.col("w").alias("b"), F.col("n").alias("n_b")), "b"))
    score = (F.col("n_ab") - min_count) * F.col("V") / (F.col("n_a") * F.col("n_b"))
    return j.select("a", "b", "n_ab", r6(score).alias("score")).filter(F.col("score") > threshold)


def phrase_positions(docs: DataFrame, id_col: str, tokens: str, phrases: DataFrame) -> DataFrame:
    """L2 (merge, step 1): per document, the 1-based positions i, ascending,
    at which (t[i], t[i+1]) is merged when phrases are merged greedily from
    left to right without overlap.

    Pairs are exploded with their position and joined to the phrase table,
    which is found once and broadcast if its measured size allows: then no pair
    is shuffled, only those that are phrases.  In a run of neighbouring
    candidates the first, third, fifth ... are taken; the runs of a document
    are bounded by its length."""
    after = F.concat(F.slice(tokens, 2, F.size(tokens)), F.array(F.lit(None).cast("string")))
    pairs = F.arrays_zip(tokens.alias("a"), after.alias("b"))       # the last word has none after it
    p = docs.where(F.size(tokens) > 1).select(id_col, F.posexplode(pairs).alias("i", "p"))
    p = p.select(id_col, (F.col("i") + 1).alias("pos"), "p.a", "p.b")
    hits = p.join(for_lookup(written(phrases.select("a", "b"))), ["a", "b"]).select(id_col, "pos")
    run = F.col("pos") - F.row_number().over(Window.partitionBy(id_col).orderBy("pos"))
    first = F.min("pos").over(Window.partitionBy(id_col, "_run"))
    taken = hits.withColumn("_run", run).withColumn("_first", first).where((F.col("pos") - F.col("_first")) % 2 == 0)
    return taken.groupBy(id_col).agg(F.sort_array(F.collect_list("pos")).alias("cand"))


def merge_at_positions(tokens: Column, taken: Column) -> Column:
    """L2 (merge, step 2): the tokens with those at each taken position and
    the next joined by '_': one slice up to each position, then the rest."""
    at = F.coalesce(taken, F.array().cast("array<int>"))
    empty = F.array().cast("array<string>")

    def piece(p: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(1)).otherwise(F.get(at, i - 1) + 2)
        joined = F.concat(F.element_at(tokens, p), F.lit("_"), F.element_at(tokens, p + 1))
        return F.concat(F.slice(tokens, begin, p - begin), F.array(joined))

    end = F.when(F.size(at) > 0, F.element_at(at, -1) + 2).otherwise(F.lit(1))
    rest = F.when(F.size(tokens) >= end, F.slice(tokens, end, F.size(tokens))).otherwise(empty)
    return F.concat(F.flatten(F.transform(at, piece)), rest)


def lexicon_polarity(docs: DataFrame, id_col: str, text: str, lexicon: DataFrame,
                     negators: Sequence[str], alpha: float = 15.0) -> DataFrame:
    """Lexicon polarity per document: sum of word scores (sign flipped
    after a negator), normalised as s / sqrt(s^2 + alpha).

    Each token is paired with its predecessor inside the row (``transform``
    with index), exploded and joined to the lexicon, which is broadcast if its
    measured size allows: tokens are not shuffled, and never broadcast.  The
    per-document sum is a partial aggregate."""
    # tokens are projected once; the lambda then indexes the column
    toks = docs.select(id_col, words(text).alias("_t"))
    t = F.col("_t")
    pairs = F.transform(t, lambda w, i: F.struct(w.alias("w"), F.when(i > 0, F.element_at(t, i)).alias("prev")))
    tok = toks.select(id_col, F.explode(pairs).alias("p")).select(id_col, "p.w", "p.prev")
    lex = for_lookup(lexicon.select(F.col("word").alias("w"), "score"))
    neg = F.array(*[F.lit(n) for n in negators])
    scored = tok.join(lex, "w").select(
        id_col, F.when(F.array_contains(neg, F.coalesce(F.col("prev"), F.lit(""))), -F.col("score"))
        .otherwise(F.col("score")).alias("s"))
    per = scored.groupBy(id_col).agg(F.sum("s").alias("raw"))
    out = docs.select(id_col).join(per, id_col, "left").withColumn("raw", F.coalesce("raw", F.lit(0.0)))
    return out.select(id_col, r6("raw").alias("raw"),
                      r6(F.col("raw") / F.sqrt(F.col("raw") * F.col("raw") + alpha)).alias("compound"))


def gazetteer_entities(docs: DataFrame, id_col: str, text: str, gazetteer: DataFrame,
                       max_words: int = 3) -> DataFrame:
    """Entity mentions found by matching word n-grams (1..max_words) of
    each text against a gazetteer (phrase, type); per document the sorted
    list of mentions and of their types.  N-grams are built in-row; the
    gazetteer is broadcast if its measured size allows, so that n-grams are
    filtered where they are made."""
    toks = docs.select(id_col, words(text).alias("_t"))
    grams = F.flatten(F.array(*[ngrams(F.col("_t"), k) for k in range(1, max_words + 1)]))
    g = toks.select(id_col, F.explode(grams).alias("phrase"))
    gz = for_lookup(gazetteer.select(F.lower("phrase").alias("phrase"), "type"))
    hits = g.join(gz, "phrase")
    return hits.groupBy(id_col).agg(
        F.array_join(F.sort_array(F.collect_list("phrase")), "|").alias("mentions"),
        F.array_join(F.sort_array(F.collect_list("type")), "|").alias("types"))


def polarity_median_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Median polarity per group (exact)."""
    from quarry.operators.aggregate import quantiles_by
    q = quantiles_by(df, keys, value, probs=(0.5,), names=("median",))
    return q.select(*keys, r6("median").alias("median"))
