"""SimHash document fingerprints in DataFrame functions.

Terms are neighbouring word pairs of the lower-cased text (the last word alone
too), weighted by their length in characters; every occurrence votes with its
weight on the 64 bits of its hash.  The votes for two bits share one long
(bit i in the low half, bit i + 32 in the high half), so 32 sums in one hash
aggregate give all 64 counters.  Rows are dealt by document, and a document's
votes are summed where its words are made; words are never shuffled.

``within_radius`` finds all fingerprints within a Hamming radius r by permuted
block tables: the 64 bits are cut into more than r blocks, a table for each
choice of r blocks keeps the others as its key, and two fingerprints that
differ in at most r bits agree on the key of at least one table.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import BLANKS, written

BITS = 64
RANGES = 200              # id ranges in which the next document is found
SPLIT = f"[{BLANKS}]+".replace("\\x20", " ")


def _votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Fingerprint ``fp`` of every row (keys must be unique); rows whose text
    has no word get 0."""
    words = F.split(F.lower(F.regexp_replace(F.col(text), f"^{SPLIT}|{SPLIT}$", "")), SPLIT)
    pairs = F.explode(F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b")))
    terms = rows.select(*keys, pairs.alias("p")).select(*keys, "p.a", "p.b")
    weight = (F.length("a") + F.coalesce(F.length("b"), F.lit(0))).cast("long")
    hashed = terms.select(*keys, F.xxhash64("a", "b").alias("h"), weight.alias("w"))
    lanes = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes) * F.col("w")).alias(f"v{i}") for i in range(32)]
    votes = hashed.groupBy(*keys).agg(F.sum("w").alias("w"), *sums)
    fp = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"v{i}"), 32)
        one = F.lit(1).cast("long")
        fp = fp.bitwiseOR(F.when(2 * low > F.col("w"), F.shiftleft(one, i)).otherwise(F.lit(0).cast("long")))
        fp = fp.bitwiseOR(F.when(2 * high > F.col("w"), F.shiftleft(one, i + 32)).otherwise(F.lit(0).cast("long")))
    return votes.select(*keys, fp.alias("fp"))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``fp`` long) of every distinct id.  Null and blank texts have
    fingerprint 0; of rows that repeat an id the smallest text counts."""
    return _votes(_one_per_id(docs, id_col, text_col), ["id"], "text").withColumnRenamed("id", id_col)


def _one_per_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.groupBy("id").agg(F.min("text").alias("text"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits in which two fingerprints agree."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id): the next smaller id; the smallest id gets the largest.

    Ids are dealt to ranges by approximate quantiles, so no window holds more
    than about one range; what follows a range is read from a table with one
    row per range (``RANGES`` rows at most)."""
    probs = ", ".join(str(i / RANGES) for i in range(1, RANGES))
    edges = ids.agg(F.expr(f"percentile_approx(id, array({probs}), 10000)").alias("e")).first().e
    edges = sorted(set(edges or []))
    place = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in edges]), lambda e: e < F.col("id"))) if edges else F.lit(0)
    placed = ids.select("id", place.alias("range"))
    tops = {r["range"]: r.top for r in placed.groupBy("range").agg(F.max("id").alias("top")).collect()}
    filled = sorted(tops)
    after = F.lit(None).cast("long")
    for lower, here in zip([filled[-1], *filled[:-1]] if filled else [], filled, strict=True):
        after = F.when(F.col("range") == here, F.lit(tops[lower]).cast("long")).otherwise(after)
    following = F.lead("id").over(Window.partitionBy("range").orderBy(F.desc("id")))
    return placed.select("id", F.coalesce(following, after).alias("next_id"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n/2) of n code points replaced by the
    first as many (or all) of the next document's, by descending id; after the
    last document comes the first.  Returns id, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (16 hex digits),
    ``near_edited`` and ``near_next`` (share of equal bits).

    Null texts are empty; texts without a word have fingerprint 0.  A single
    document is its own next one.  Of rows that repeat an id the smallest text
    counts (one result row); rows without an id are left out.  Other columns
    are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.where("id is not null")
    half = rows.groupBy("id").agg(F.floor(F.max(F.length("text")) / 2).cast("int").alias("most"))     # of repeated ids: enough for any
    order = written(next_ids(rows.select("id").distinct()))
    link = half.join(order, "id")
    texts = rows.groupBy("id").agg(F.min("text").alias("text"))
    # what each document lends to the one before it, cut to what that one can take
    lent = (texts.join(link.select(F.col("id").alias("to"), F.col("next_id").alias("id"), "most"), "id")
            .select(F.col("to").alias("id"), F.expr("substring(text, 1, most)").alias("lent"), F.col("id").alias("next_id")))
    n = F.length("text")
    cut = F.floor(n / 2).cast("int")
    whole = texts.join(lent, "id").select(
        "id", "next_id", n.cast("long").alias("n_chars"), "text",
        F.concat(F.substring("text", F.lit(1), n - cut), F.substring("lent", F.lit(1), cut)).alias("edited"))
    both = whole.select("id", "next_id", "n_chars", F.sha2("edited", 256).alias("sha"),
                        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
                                          F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("v"))
    marks = _votes(both.select("id", "next_id", "n_chars", "sha", F.col("v.kind").alias("kind"), F.col("v.body").alias("body")),
                   ["id", "next_id", "n_chars", "sha", "kind"], "body")
    made = written(marks.groupBy("id", "next_id", "n_chars", "sha").agg(
        F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("efp")))
    other = made.select(F.col("id").alias("next_id"), F.col("fp").alias("next_fp"))
    out = made.join(other, "next_id")
    return out.select(F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), as_hex(F.col("fp")).alias("fingerprint"),
                      as_hex(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                      likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of the permuted block tables, one per choice of ``radius`` blocks
    that are left out of the key."""
    edge = [round(i * BITS / blocks) for i in range(blocks + 1)]
    bits = [sum(1 << j for j in range(a, b)) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    full = (1 << BITS) - 1
    return [full & ~sum(bits[i] for i in out) for out in combinations(range(blocks), radius)]


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """All pairs (query_fp, fp, distance) of *distinct* fingerprints within
    ``radius`` bits: a stated query set against an index.  Copies of one
    fingerprint are one node on either side.  Columns ``fp`` are read, nulls
    left out."""
    masks = block_masks(radius, blocks or radius + 2)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]

    def dealt(df: DataFrame, name: str) -> DataFrame:
        tables = F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.col(name).bitwiseAND(F.lit(m)).alias("key"))
                                     for i, m in enumerate(signed)]))
        return df.select(F.col("fp").alias(name)).where(F.col(name).isNotNull()).distinct().select(name, tables.alias("t")).select(
            name, F.col("t.table").alias("table"), F.col("t.key").alias("key"))

    distance = F.bit_count(F.col("query_fp").bitwiseXOR(F.col("fp")))
    pairs = dealt(queries, "query_fp").join(dealt(index, "fp"), ["table", "key"]).where(distance <= radius)
    return pairs.select("query_fp", "fp", distance.cast("int").alias("distance")).distinct()
