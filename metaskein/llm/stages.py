"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, language, pii, queries, shingles, tokenizing
from .runtime import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a null text or one without a letter is rejected.

    Where ``lang`` is null it becomes the language found; a given label stays. Repeated rows stay, each judged by its text alone, and
    equal scores go to the language first by name. Columns other than those of documents are dropped, whatever their names. Empty tables stay empty.
    """
    docs = docs.select(COLUMNS)
    samples = language.sample(docs.where(~language.held_out("doc_id")))
    found = language.identify(docs, samples).where(F.col("lang_pred") != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Null and empty texts have no words and stay; so do repeated rows, null ids and all rows where the benchmark is empty. Very long texts are
    scanned whole. Columns other than those of documents are dropped, whatever their names.
    """
    rest = F.struct([c for c in COLUMNS if c != "text"]).alias("row")  # the text passes through Python once
    found = decontamination.find_contamination(docs.select(rest, "text"), table(spark, sf_dir, "benchmark"), id_col="row", keep_text=True)
    return found.where(F.col("n_hit") == 0).select("row.*", "text").select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text; ``exact`` says that decoding gives back its bytes.

    One row per row, repeated ones and null ids included; null and empty texts have no ids. Columns other than those named are dropped.
    """
    ranks, pattern = queries.vocabulary()
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest")
    coded = tokenizing.encode(docs.select(F.struct("doc_id", "lang", "source", digest).alias("row"), "text"), ranks, pattern, id_col="row")
    return coded.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids",
                        (F.sha2("decoded", 256) == F.col("row.digest")).alias("exact"))


def keep_first_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest id, for each component of near duplicates. Repeated rows of it are dropped too."""
    found = stored(shingles.near_duplicates(docs.select(COLUMNS)).select("doc_id", "text_hash", "kept"))
    same = [F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), F.col("d.text_hash").eqNullSafe(F.col("k.text_hash"))]
    by_row = found.groupBy("doc_id", "text_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    changed = stored(by_row.where("not kept or rows > 1"))
    hashed = shingles.with_text_hash(docs.select(COLUMNS))
    whole = hashed.alias("d").join(shingles.few(changed).alias("k"), same, "left_anti")
    # Rows that repeat an id and its text, of which one stays: seldom any.
    repeated = stored(changed.where("kept"))
    if not repeated.isEmpty():
        again = hashed.alias("d").join(shingles.few(repeated).alias("k"), same, "left_semi")
        whole = whole.union(again.dropDuplicates(["doc_id", "text_hash"]))
    return whole.select(COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without personal data and the terms that disclose it; ``n_chars`` is that of the new text."""
    found = pii.find_personal_data(docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text"), id_col="row")
    changed = stored(found.where("sanitized is not null").select("row.*", "text_hash", "sanitized"))
    keys = stored(changed.select("doc_id", "text_hash").distinct())
    same = [F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")), F.col("d.text_hash") == F.col("k.text_hash")]
    clean = shingles.with_text_hash(docs.select(COLUMNS)).alias("d").join(shingles.few(keys).alias("k"), same, "left_anti")
    new = changed.select("doc_id", F.col("sanitized").alias("text"), "lang", "source", F.length("sanitized").cast("long").alias("n_chars"))
    return clean.select(COLUMNS).union(new.select(COLUMNS))
