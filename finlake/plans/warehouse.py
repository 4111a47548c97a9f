"""Storage layout of one warehouse under a root folder (any Hadoop path):

  <root>/bronze/<feed>/attempt=<id>/bronze_month=<yyyy-MM>/   feed tables; the ledger says which attempts count
  <root>/schema/<feed>/                      columns and types of each feed table
  <root>/meta/<table>/v-<time>/              versions of the refreshed dimension tables
  <root>/ledger/                             ingested base names
  <root>/quarantine/                         rejected files and reasons
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.sources.ledger import read_ledger, visible_rows
from finlake.sources.store import new_version, notes, publish, put_note, versions

#: Partition columns of the feed tables: the import attempt, and the month of PartitionDate (null without one).
ATTEMPT, MONTH = "attempt", "bronze_month"


def month_of(day: str) -> str:
    """'2024/01/31' or '2024-01-31' -> '2024-01'."""
    return datetime.strptime(day.replace("-", "/"), "%Y/%m/%d").strftime("%Y-%m")


@dataclass(frozen=True)
class Warehouse:
    root: str
    ledger: str | None = None  # ledger folder, default <root>/ledger

    def feed_path(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/bronze/{feed}"

    def meta_path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/meta/{table}"

    @property
    def ledger_path(self) -> str:
        return self.ledger or f"{self.root.rstrip('/')}/ledger"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root.rstrip('/')}/quarantine"

    def schema_path(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/schema/{feed}"

    def read_feed(
        self, spark: SparkSession, feed: str, start: str | None = None, end: str | None = None, ledger: DataFrame | None = None
    ) -> DataFrame | None:
        """A feed table: the rows of files the ledger holds, or None when nothing was ever
        ingested into it. With ``start`` and ``end`` (first day included, first day excluded)
        only the folders of the months they touch are read. ``ledger`` is the ledger
        when already read."""
        schema = self.feed_schema(spark, feed)
        if schema is None:
            return None
        stored = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType()), T.StructField(MONTH, T.StringType())])
        df = spark.read.schema(stored).parquet(self.feed_path(feed))
        df = visible_rows(df, read_ledger(spark, self.ledger_path) if ledger is None else ledger)
        if start and end:
            month = F.col(MONTH)
            df = df.filter((month >= month_of(start)) & (month <= month_of(end)))
        return df.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])

    def read_feed_or_empty(
        self, spark: SparkSession, feed: str, start: str | None = None, end: str | None = None, ledger: DataFrame | None = None
    ) -> DataFrame:
        """A feed table, or an empty frame of the feed's needed columns when
        nothing was ingested into it yet (D8, D9)."""
        df = self.read_feed(spark, feed, start, end, ledger)
        if df is None:
            from finlake.schemas import feed_schema

            df = spark.createDataFrame([], feed_schema(feed))
        return df

    def feed_schema(self, spark: SparkSession, feed: str) -> T.StructType | None:
        """Columns of a feed table (``source_file`` last), as its first file set them."""
        first = next(iter(notes(spark, self.schema_path(feed)).values()), None)
        return None if first is None else T.StructType.fromJson(json.loads(first))

    def set_feed_schema(self, spark: SparkSession, feed: str, schema: T.StructType) -> None:
        put_note(spark, self.schema_path(feed), schema.json())

    def read_meta(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The last published version of a dimension table, or None."""
        found = versions(spark, self.meta_path(table))
        return spark.read.parquet(found[-1]) if found else None

    def write_meta(self, spark: SparkSession, table: str, df: DataFrame) -> tuple[DataFrame, int]:
        """Replace a dimension table (S12): a new version is written beside the old one, which
        stays what readers see until the new one is whole. Returns the table and its rows."""
        version, seen = new_version(self.meta_path(table)), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(version)
        publish(spark, version)
        return spark.read.parquet(version), seen.get["rows"]
