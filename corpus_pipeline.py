"""A corpus pipeline: five stages, each an operator of ``tablewright.llm``.

Each stage is a function of (spark, docs, sf_dir) and works on all that its predecessor kept; all
but the last return the columns of documents. ``run`` writes every stage's result as Parquet in
the shared folder and hands the reread table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import packing, quality, simhash, substring
from tablewright.llm import toxicity as tagger
from tablewright.llm.common import column, shared_folder, table
from tablewright.llm.queries import BYTE_BPE


def _rows(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and all but the text in a struct, out of reach of names that
    operators add."""
    rest = [column(c) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "doc_id", "text")


def _documents(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again."""
    given = {"text": F.col("text")} | changed
    return rows.select(
        *[given.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    )


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. NULL and empty texts are scored as empty."""
    settings = tagger.Settings()
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    field = tagger.fit(tagger.training_rows(docs, labels, settings.documents), settings)
    return _documents(tagger.score(_rows(docs), field).filter("predicted = 0"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the rules. NULL and empty texts have too few words and go."""
    return _documents(quality.judged(_rows(docs)).filter("kept"), docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with the smallest id of each near-duplicate class. An id repeated with different texts
    is judged for each of them; rows without an id cannot be named and stay."""
    classes = simhash.near_duplicates(docs.select("doc_id", "text"))
    # Repeats are no matter to the anti join; without a grouping here the join before it can be split.
    gone = classes.filter("doc_id <> component_id").select("doc_id", "fingerprint")
    rows = simhash.fingerprinted(_rows(docs).withColumn("doc_id", F.col("doc_id").cast("long")))
    return _documents(rows.join(gone, ["doc_id", "fingerprint"], "left_anti"), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that a document with a smaller id has; a text that
    loses words is joined by single spaces and may become empty. ``n_chars`` follows the text."""
    cut = substring.remove_repeats(_rows(docs))
    if "n_chars" not in docs.columns:
        return _documents(cut, docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    n_chars = F.when(F.col("n_removed") > 0, length).otherwise(F.col("row.n_chars"))
    return _documents(cut, docs, n_chars=n_chars)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the texts' ids, each with its sequence and the place there. A NULL or empty text has
    one piece, its end."""
    return packing.packed(packing.pieces(docs, BYTE_BPE))


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Tagging, fingerprint classes and packing are not expressible in SQL; tests compare the stages with
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus_pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
