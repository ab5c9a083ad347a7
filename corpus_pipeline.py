"""A cleaning pipeline over documents: language ID, toxicity, near-dedup, substring dedup, packing.

Each stage takes what the one before it kept. run() writes each stage's result as Parquet below the session's checkpoint
folder and reads it again, so a stage never runs twice and no lineage crosses stages; what a stage wrote is deleted once the
next one has read it. Rows of one id with different texts are decided each by itself: a decision belongs to the id and the
text. All stages take docs with doc_id and text and any other columns, whatever their names, and give empty tables for empty
tables; null texts count as empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import common, langid, minhash, packing, substring, toxicity


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned, all columns as they are; those without text or letters (`und`) go. Repeated rows are judged alike."""
    return langid.known_only(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic, all columns as they are. Without labels of both kinds none are. Repeated rows are judged alike."""
    return toxicity.clean_only(docs, common.table(spark, sf_dir, "labels"))


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_md5): whole rows as one column, so that no name of theirs meets one of ours."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies (five-word shingles, similarity 0.8 or more).

    Equal rows of that id all stay; rows without an id, and texts without words, are in no component and stay.
    """
    gone = minhash.near_duplicates(docs, hashed=True).where("not kept").select("doc_id", "text_md5").distinct()
    return _rows(docs).join(gone, ["doc_id", "text_md5"], "left_anti").select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of windows that a document with a smaller id has; n_chars, if there, follows the text.

    Equal rows lose the same words; rows without an id lose none.
    """
    cut = substring.kept_texts(docs).where("n_removed > 0").select("doc_id", "text_md5", F.col("text").alias("new_text")).dropDuplicates(["doc_id", "text_md5"])
    out = _rows(docs).join(cut, ["doc_id", "text_md5"], "left")
    changed = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}

    def value(c: str):
        was = F.col("row")[c]
        return F.when(F.col("new_text").isNotNull(), changed[c]).otherwise(was).alias(c) if c in changed else was.alias(c)

    return out.select(*(value(c) for c in docs.columns))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they are packed (packing.pack); of a row, only doc_id and text are read. An empty table has no pieces."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language),
    ("toxicity", clean),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit),
]

#: No SQL: two stages are trained models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result. The folder of its table, below the shared folder, is the caller's to delete."""
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, function in STAGES:
        out = f"{folder}/{name.replace(' ', '_')}"
        with common.steps(spark):
            function(spark, docs, sf_dir).write.parquet(out)
        if before:
            common.discard(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
