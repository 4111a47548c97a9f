"""Training-corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of ``documents``; the last returns the
packed pieces. ``run`` writes every stage's result to the shared folder and
reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import decontaminate, packing, simhash, substrings, toxicity
from finlake.llm.storage import materialize, release


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict to be toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, at most 2 bits): the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of 20 words or more that start earlier; n_chars follows the text."""
    cut = substrings.dedup_texts(docs, window=20)
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of the benchmark."""
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed in sequences of the permitted lengths."""
    return packing.pack_documents(packing.word_counts(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: Fingerprints, label models and packing are not SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
