"""Role mapping of the TPC-H-like driver tables onto the finance warehouse
shapes, so the gold rules can run (and be checked) on data that grows with the
scale factor:

  part      -> WBS elements (file order = p_partkey) and WBS codification
  supplier  -> cost centres, nation -> node-to-compass and signatures
  region    -> compass texts, part.p_size -> G/L accounts
  customer  -> profit centres
  lineitem  -> actuals / cost-centre details; orders -> commitments
  events    -> forecasts (PERIOD text from ``props``)
  region -> nation -> supplier -> one statement hierarchy

Nulls are introduced on purpose (the driver keys have none) so the null-safe
lookups are exercised: part 0 becomes the WBS row with a null code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.columns import month_start, period_digits, route_feed
from finlake.plans.dims import ORDINAL, TYPE_SOURCE, GoldDims, build_gold_dims  # noqa: F401

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------


def wbs_elements(part: DataFrame) -> DataFrame:
    return part.select(
        F.nullif(F.col("p_partkey"), F.lit(0)).alias("WBS Element Code"),
        F.col("p_name").alias("WBS Element Name"),
        F.when(F.col("p_size") % 5 == 1, F.lit(1)).otherwise(F.lit(2)).alias("WBS Level"),
        F.when(F.col("p_size") % 3 == 0, F.lit(None)).otherwise(F.col("p_size")).cast("bigint").alias("WBS G/L Account"),
        F.when(F.col("p_partkey") % 4 == 0, F.lit(None)).otherwise(F.col("p_partkey")).alias("WBS Profit Center Code"),
        F.col("p_partkey").alias(ORDINAL),
        F.col("p_type").alias(TYPE_SOURCE),
    )


def wbs_codification(part: DataFrame) -> DataFrame:
    return (
        part.filter(F.col("p_type") != "PROMO")
        .groupBy(F.substring("p_type", 1, 1).alias("WBS Type Char"))
        .agg(F.min("p_type").alias("WBS Type"))
        .withColumn("WBS Typ Local", F.lower(F.col("WBS Type")))
    )


def cost_centers(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("Cost Center Code"),
        F.col("s_suppkey").alias("Profit Center Code"),
        F.col("s_nationkey").alias("Standard Hierarchy Node"),
    )


def node_to_compass(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").alias("Standard Hierarchy Node"), F.col("n_regionkey").alias("Compass Code")
    )


def compass_codes(region: DataFrame) -> DataFrame:
    return region.filter(F.col("r_regionkey") < 4).select(
        F.col("r_regionkey").alias("Compass Code"), F.col("r_name").alias("P&L Line Text")
    )


def gl_accounts(part: DataFrame) -> DataFrame:
    return (
        part.select(F.col("p_size").cast("bigint").alias("G/L Account"))
        .distinct()
        .withColumn("G/L Acct Long Text", F.concat(F.lit("Account "), F.col("G/L Account").cast("string")))
    )


def gl_accounts_to_compass(part: DataFrame) -> DataFrame:
    return (
        part.filter(F.col("p_size") < 40)
        .select(F.col("p_size").cast("bigint").alias("G/L Account"), (F.col("p_size") % 5).alias("Compass Code"))
        .distinct()
        .select("Compass Code", "G/L Account")
    )


def profit_centers(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("Profit Center Code"),
        F.substring("c_mktsegment", 1, 3).alias("Division Abbreviation"),
        F.col("c_mktsegment").alias("Division"),
        F.col("c_nationkey").alias("Standard Hierarchy Node"),
        F.col("c_nationkey").alias("Signature Code"),
    )


def signatures(nation: DataFrame) -> DataFrame:
    return nation.filter(F.col("n_nationkey") < 20).select(
        F.col("n_nationkey").alias("Signature Code"), F.col("n_name").alias("Signature Description")
    )


def lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: table(spark, sf_dir, n) for n in ("part", "supplier", "nation", "region", "customer")}
    return {
        "wbs_elements": wbs_elements(t["part"]),
        "wbs_codification": wbs_codification(t["part"]),
        "cost_centers": cost_centers(t["supplier"]),
        "node_to_compass": node_to_compass(t["nation"]),
        "compass_codes": compass_codes(t["region"]),
        "gl_accounts": gl_accounts(t["part"]),
        "gl_accounts_to_compass": gl_accounts_to_compass(t["part"]),
        "profit_centers": profit_centers(t["customer"]),
        "signatures": signatures(t["nation"]),
    }


_DIMS_CACHE: dict[tuple[int, str], GoldDims] = {}


def gold_dims(spark: SparkSession, sf_dir: str) -> GoldDims:
    """Gold lookups of one table folder, built, validated and cached once per
    session (they are reference data; the driver tables are read-only)."""
    key = (id(spark), sf_dir.rstrip("/"))
    dims = _DIMS_CACHE.get(key)
    if dims is None or not _alive(dims):
        dims = _DIMS_CACHE[key] = build_gold_dims(lookups(spark, sf_dir))
    return dims


def _alive(dims: GoldDims) -> bool:
    try:
        return dims.compass_codes.sparkSession.sparkContext._jsc is not None
    except Exception:
        return False


# ---------------------------------------------------------------------------
# Feeds (raw column names, as they would sit in the bronze tables)
# ---------------------------------------------------------------------------


def ledger_feed(lineitem: DataFrame) -> DataFrame:
    """Lineitem as a ledger extract."""
    fy = F.year("l_shipdate").cast("bigint")
    fp = F.month("l_shipdate").cast("bigint")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Amount in Company Code Currency"),
        _when(F.col("l_linenumber") % 3 != 0, F.col("l_partkey")).alias("WBS Element"),
        _when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("Cost Center"),
        _when(F.col("l_linenumber") == 5, F.col("l_suppkey")).alias("Partner Cost Center"),
        _when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("Product"),
        F.col("l_quantity").cast("bigint").alias("G/L Account"),
        _when(F.col("l_linenumber") < 4, F.floor(F.col("l_orderkey") / 10).cast("bigint")).alias("Profit Center"),
        fy.alias("Fiscal Year"),
        fp.alias("Period"),
        month_start(fy, fp).alias("PartitionDate"),
    )


def commit_wbs_feed(orders: DataFrame) -> DataFrame:
    fy = F.year("o_orderdate").cast("bigint")
    fp = F.when(F.col("o_orderkey") % 11 == 0, 0).otherwise(F.month("o_orderdate")).cast("bigint")
    return orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("Amount in Company Code Currency"),
        _when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("WBS Element"),
        (F.col("o_orderkey") % 50 + 1).cast("bigint").alias("G/L Account"),
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
        .alias("Posting Date"),
        fy.alias("Fiscal Year"),
        fp.alias("Period"),
        month_start(fy, fp, strict=False).alias("PartitionDate"),
    )


def commit_cc_feed(orders: DataFrame) -> DataFrame:
    fy = F.year("o_orderdate").cast("bigint")
    fp = F.when(F.col("o_orderkey") % 11 == 0, 0).otherwise(F.month("o_orderdate")).cast("bigint")
    return orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").alias("Amount in Company Code Currency"),
        _when(F.col("o_orderkey") % 3 != 0, F.floor(F.col("o_custkey") / 15).cast("bigint")).alias("Cost Center"),
        (F.col("o_orderkey") % 50 + 1).cast("bigint").alias("G/L Account"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
        .alias("Delivery Date"),
        fy.alias("Fiscal Year"),
        fp.alias("Period"),
        month_start(fy, fp, strict=False).alias("PartitionDate"),
    )


def forecast_source_file(event_id: Column) -> Column:
    k = event_id % 4
    trend = F.element_at(
        F.array(F.lit("fc_T03_2024.csv"), F.lit("fc_T05_2024.csv"), F.lit("fc_T09_2024.csv"), F.lit("fc_t03_2024.csv")),
        ((event_id / 4).cast("bigint") % 4 + 1).cast("int"),
    )
    return (
        F.when(k == 0, F.lit("fc_LE_2024.csv"))
        .when(k == 1, F.lit("fc_prebud_2024.csv"))
        .when(k == 2, F.lit("fc_bud_2024.csv"))
        .otherwise(trend)
    )


def forecast_bronze(events: DataFrame) -> DataFrame:
    """Events as forecast extracts, as ingest leaves them: raw names, plus
    ``source_file``, ``Fiscal Period`` and ``PartitionDate`` (G5, refresh
    branch: month from the digits of PERIOD, month 0 -> no date)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    period = (
        F.when(F.col("event_type") == "error", F.lit("TOTAL"))
        .when(F.col("event_type") == "signup", F.lit("TOTAL_B"))
        .when(F.col("event_id") % 17 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("M"), F.lpad((k % 13).cast("string"), 2, "0"), F.lit("_T")))
    )
    df = events.select(
        "event_id",
        (F.lit(2023) + k % 2).cast("bigint").alias("YEAR"),
        period.alias("PERIOD"),
        F.lit("2024-02-01").alias("Last Refresh"),
        F.col("event_type").alias("SPEND TYPE"),
        F.col("value").cast("decimal(18,2)").alias("Value"),
        _when(F.col("event_id") % 4 != 0, F.col("user_id")).alias("CODE (L1_CC_Oth)"),
        _when(F.col("event_id") % 6 != 0, F.concat(F.lit("cc-"), F.col("event_type"))).alias(
            "CODE DESCRIPTION  (L1_CC_Oth)"
        ),
        _when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("CODE (L2)"),
        F.lit("wbs").alias("CODE DESCRIPTION (L2)"),
        _when(F.col("event_id") % 3 != 0, F.col("event_id") % 5).alias("P&L LINE COMPASS CODE_FS"),
        _when(F.col("event_id") % 2 != 0, (F.floor("value").cast("bigint") % 50)).alias("P&L DESTINATION ACCOUNT"),
        forecast_source_file(F.col("event_id")).alias("source_file"),
    )
    fp = period_digits("PERIOD")
    return df.withColumn("Fiscal Period", fp).withColumn(
        "PartitionDate", F.when(fp != 0, month_start(F.col("YEAR"), fp))
    )


def forecast_feeds(events: DataFrame) -> dict[str, DataFrame]:
    """Route each row to its forecast feed by its file name."""
    b = forecast_bronze(events).withColumn("__feed", route_feed("source_file"))
    feeds = ["forecast_live_estimate", "forecast_pre_budget", "forecast_budget", "forecast_trend"]
    return {f: b.filter(F.col("__feed") == f).drop("__feed") for f in feeds}


def orders_extract(orders: DataFrame) -> DataFrame:
    """Orders as a ledger CSV extract: every value as text, some integers
    written as '7.0', empty cost centres and 'NA' item texts."""
    month = F.month("o_orderdate").cast("string")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("Purchasing Document"),
        F.year("o_orderdate").cast("string").alias("Fiscal Year"),
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(month, F.lit(".0"))).otherwise(month).alias("Period"),
        F.col("o_totalprice").cast("string").alias("Amount in Company Code Currency"),
        F.col("o_custkey").cast("string").alias("WBS Element"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.floor(F.col("o_custkey") / 15).cast("bigint").cast("string")).alias("Cost Center"),
        (F.col("o_orderkey") % 10).cast("string").alias("Reference Item"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Posting Date"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("NA")).otherwise(F.col("o_orderpriority")).alias(
            "Journal Entry Item Text"
        ),
        F.col("o_orderstatus").alias("Order Status"),
    )


#: Rows of an extract's part file, about.
ROWS_PER_PART = 500_000


def write_csv(df: DataFrame, path: str, files: int | None = 4) -> None:
    """Write text columns as header CSV files (quotes doubled): at least ``files``
    part files in the output folder, and so many that none has much more than
    ``ROWS_PER_PART`` rows. With ``files`` None AQE cuts and merges them by size."""
    if files is None:
        dealt = df.hint("rebalance")
    else:
        dealt = df.repartition(max(files, -(-df.count() // ROWS_PER_PART)))
    (
        dealt.write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("encoding", "ISO-8859-1")
        .csv(path)
    )


def hierarchy_nodes(region: DataFrame, nation: DataFrame, supplier: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(statement items, parent links): regions under no parent, nations under
    their region, suppliers under their nation."""
    items = (
        region.select(F.concat(F.lit("R"), F.col("r_regionkey")).alias("Financial Statement Item"), F.col("r_name").alias("Text"))
        .unionByName(
            nation.select(
                F.concat(F.lit("N"), F.col("n_nationkey")).alias("Financial Statement Item"),
                F.when(F.col("n_nationkey") % 7 == 3, F.lit(None)).otherwise(F.col("n_name")).alias("Text"),
            )
        )
        .unionByName(
            supplier.select(F.concat(F.lit("S"), F.col("s_suppkey")).alias("Financial Statement Item"), F.col("s_name").alias("Text"))
        )
    )
    links = (
        region.select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("ID"),
            F.concat(F.lit("R"), F.col("r_regionkey")).alias("Financial Statement Item"),
            F.lit(0).cast("bigint").alias("ID2"),
        )
        .unionByName(
            nation.select(
                (F.col("n_nationkey") + 100).cast("bigint").alias("ID"),
                F.concat(F.lit("N"), F.col("n_nationkey")).alias("Financial Statement Item"),
                (F.col("n_regionkey") + 1).cast("bigint").alias("ID2"),
            )
        )
        .unionByName(
            supplier.select(
                (F.col("s_suppkey") + 1000).cast("bigint").alias("ID"),
                F.concat(F.lit("S"), F.col("s_suppkey")).alias("Financial Statement Item"),
                (F.col("s_nationkey") + 100).cast("bigint").alias("ID2"),
            )
        )
    )
    return items, links


def chart_inputs(customer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(statement item -> account links, G/L accounts) from customers: each
    customer is an account under its nation's statement item."""
    links = customer.select(
        F.concat(F.lit("N"), F.col("c_nationkey")).alias("Financial Statement Item"),
        F.col("c_custkey").alias("Account To"),
    )
    accounts = customer.select(
        F.col("c_custkey").alias("G/L Account"),
        F.col("c_name").alias("Short Text"),
        F.col("c_mktsegment").alias("G/L Acct Long Text"),
    )
    return links, accounts


__all__ = [
    "TABLES",
    "chart_inputs",
    "commit_cc_feed",
    "commit_wbs_feed",
    "forecast_bronze",
    "forecast_feeds",
    "gold_dims",
    "hierarchy_nodes",
    "ledger_feed",
    "lookups",
    "table",
]
