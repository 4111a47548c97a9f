"""Registered queries of the training-data operators: opN_<name>(spark, sf_dir) over whole tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, exact_dedup, hard_negatives, licenses, neighbours, packing, resampling, sharding, simhash, substrings, suffix_dedup, toxicity, warc
from .oracles import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_neighbours(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_decontaminate(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items).drop("row")


def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_pack(spark, sf_dir):
    return packing.pack_documents(packing.word_counts(_table(spark, sf_dir, "documents")))


def op5_shard(spark, sf_dir):
    shards = [f"shard-{i:03d}" for i in range(sharding.N_SHARDS)]
    return sharding.shard_rows(_table(spark, sf_dir, "documents").select("doc_id"), "doc_id", shards)


def op6_substrings(spark, sf_dir):
    return substrings.dedup_digest(_table(spark, sf_dir, "documents"), window=20)


def op7_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_licenses(spark, sf_dir):
    return licenses.license_scan(_table(spark, sf_dir, "documents")).drop("spans")


def op9_warc(spark, sf_dir):
    back = warc.archive(_table(spark, sf_dir, "pages"), payloads=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_suffixes(spark, sf_dir):
    return suffix_dedup.dedup_digest(_table(spark, sf_dir, "documents"), length=100).drop("spans")


def op11_resampling(spark, sf_dir):
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", label=label)


def op13_exact(spark, sf_dir):
    return exact_dedup.copies(_table(spark, sf_dir, "documents"), keep="largest").drop("row")


QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_decontaminate": op2_decontaminate,
    "op3_simhash": op3_simhash,
    "op4_pack": op4_pack,
    "op5_shard": op5_shard,
    "op6_substrings": op6_substrings,
    "op7_toxicity": op7_toxicity,
    "op8_licenses": op8_licenses,
    "op9_warc": op9_warc,
    "op10_suffixes": op10_suffixes,
    "op11_resampling": op11_resampling,
    "op12_negatives": op12_negatives,
    "op13_exact": op13_exact,
    "pipeline": corpus_pipeline.run,
}
