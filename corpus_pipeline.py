"""The training-data pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
rows that its predecessor kept.  Every stage but the last returns the columns
of ``documents``.  ``run`` writes each stage's result as Parquet in the shared
checkpoint folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import language_id, packing, simhash_dedup, substring_dedup, toxicity
from quarry.llm.common import table, written
from quarry.session import ship

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ORACLE_SQL = None         # classifiers, fingerprints and encodings are beyond SQL; tested against the operators' brute force


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but those that the operators read under names
    that none of their result columns has; positions stay."""
    return docs.toDF(*[c if c in ("doc_id", "text", "lang") else f"column_{i}_of_documents" for i, c in enumerate(docs.columns)])


def _again(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``_apart`` under the names they have in ``docs``."""
    return rows.select(_apart(docs).columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    ship(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    plain = _apart(docs)
    judged = toxicity.score(plain, model, keep=plain.columns)
    return _again(judged.where("predicted = 0"), docs)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go, and those whose
    best language is both a near tie and below one half."""
    ship(spark)
    plain = _apart(docs)
    told = language_id.identify(plain, language_id.learn(plain), keep=plain.columns)
    reject = (F.col("lang_pred") == language_id.UNKNOWN) | (F.col("ambiguous") & (F.col("score") < 0.5))
    return _again(told.where(~reject), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the smallest id
    (one row of it, if the id repeats).  Rows without an id all stay: they
    cannot be named as a class's document."""
    ship(spark)
    plain = _apart(docs)
    classes = simhash_dedup.near_duplicates(plain.where("doc_id is not null"))
    stay = classes.where("doc_id = component_id").select("doc_id").distinct()
    # of a repeated id the row with the least hash, so that a task that runs again keeps the same one
    whole = F.struct(*plain.columns)
    one = plain.join(stay, "doc_id").groupBy("doc_id").agg(F.min_by(whole, F.xxhash64(*plain.columns)).alias("row")).select("row.*")
    return _again(one.unionByName(plain.where("doc_id is null")), docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; texts that lose none
    stay as they are, ``n_chars`` follows the text."""
    ship(spark)
    plain = _apart(docs)
    cut = substring_dedup.remove_repeats(plain, keep=plain.columns)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        n = plain.columns[docs.columns.index("n_chars")]
        new[n] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col(n))
    return _again(cut.withColumns(new), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 4096 ids, one row per piece."""
    ship(spark)
    return packing.pack_documents(docs, VOCABULARY).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
