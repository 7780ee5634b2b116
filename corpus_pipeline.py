"""A corpus from raw documents to packed sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import langid, mixing, ngram_join, packing, secrets
from lodestone.llm._common import stored, table
from lodestone.llm.queries import tokenizer_files

#: A document whose language is less probable than this, or that has no letter, is rejected.
LEAST_SCORE = 0.5
#: Ids up to this many are broadcast; beyond, documents are shuffled by id.
BROADCAST_IDS = 1_000_000


def _held(docs: DataFrame, *columns: F.Column) -> DataFrame:
    """docs' columns in one struct, so that no name can clash, beside what a stage needs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"), *columns)


def _columns(held: DataFrame, docs: DataFrame, **changed: F.Column) -> DataFrame:
    return held.select(*[changed.get(c, F.col("held").getField(c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; where lang is null it becomes the predicted one.  Null texts go."""
    named = langid.predict(_held(docs, F.col("text")), langid.train(docs.select("doc_id", "text", "lang")))
    kept = named.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return _columns(kept, docs, lang=F.coalesce(F.col("held.lang"), F.col("lang_pred")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike ones: that with the smallest doc_id.

    Where ids repeat or are null, id and text together count as the id: one of equal rows stays, and rows of one id
    with different texts are documents of their own.
    """
    own = F.xxhash64("doc_id", "text")
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null").select(F.col("doc_id").alias("again"))
    ids = stored(ids, "repeated")
    n_ids = ids.count()
    near = lambda d, n: F.broadcast(d) if n <= BROADCAST_IDS else d
    keyed = _held(docs, F.col("doc_id").cast("long").alias("key"), F.col("text"))
    if n_ids:
        marked = _held(docs, F.col("doc_id"), own.alias("own"), F.col("text")).join(near(ids, n_ids), F.col("doc_id").eqNullSafe(F.col("again")), "left")
        keyed = marked.select("held", F.when(F.col("doc_id").isNull() | F.col("again").isNotNull(), F.col("own")).otherwise(F.col("doc_id").cast("long")).alias("key"), "text")
    found = stored(ngram_join.similar(keyed.select(F.col("key").alias("doc_id"), "text")), "groups")
    gone = stored(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    kept = keyed.join(near(gone, gone.count()), F.col("key") == F.col("gone"), "left_anti")
    if n_ids:  # equal rows have one key
        kept = kept.select("key", "held").dropDuplicates(["key"])
    return _columns(kept, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return secrets.mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(packing.token_pieces(docs, **tokenizer_files()))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("mixture", mixture), ("packed", packed)]

#: A trained network and evolved packings aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
