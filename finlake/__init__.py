"""finlake: a Spark-native finance ingestion and enrichment engine.

Layout:
  functions/  column expressions (fiscal type, dates, period digits, ...)
  operators/  reusable DataFrame operators (lookup_join, fill-down, hierarchy, ...)
  sources/    file listing, typed CSV/Parquet reads, dims, ledger, gold sink
  plans/      pipelines composed from the operators (dims, feeds, gold, import)
  streaming/  incremental once-per-file ingest with Structured Streaming
"""

from finlake.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
