"""Catalogue queries on named extract files (derived by Spark from the driver
tables): what loads, what is quarantined and why, and gold written twice."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.columns import col
from finlake.plans import driver_tables as dt
from finlake.plans.ingest import import_files
from finlake.plans.warehouse import Warehouse
from finlake.session import scratch_path
from finlake.sources.files import list_files
from finlake.sources.ledger import read_ledger
from finlake.sources.store import AT_ONCE

COLUMNS = ["Purchasing Document", "Fiscal Year", "Period", "G/L Account", "Amount in Company Code Currency", "Note"]
AMOUNT = "Amount in Company Code Currency"


def _move_part(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one part file of a written folder its extract name."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(folder).getFileSystem(conf)
    [part] = [s.getPath() for s in fs.globStatus(path(f"{folder}/part-*"))]
    fs.mkdirs(path(target).getParent())
    if not fs.rename(part, path(target)):
        raise RuntimeError(f"cannot name {target}")


def _bad_extracts(spark: SparkSession, sf: str) -> str:
    """Orders in eight extracts by key; the row whose key is the extract's number is odd.

    0 good, 1 open quote, 2 integer overflow, 3 fraction, 4 month 13, 5 hidden
    name, 6 quoted line breaks, 7 bare quotes; an empty file; and a bad file
    whose path sorts before the good one of its name."""
    src = scratch_path(spark, "bad-extracts")
    o = dt.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    odd = k == k % 8
    note = (
        F.when(odd & (k == 1), F.lit('"never closed'))
        .when(k % 8 == 6, F.concat(F.lit('"two\nlines "" '), F.col("o_orderpriority"), F.lit('"')))
        .when(k % 8 == 7, F.concat(F.col("o_orderpriority"), F.lit(' 5" pipe')))
        .otherwise(F.col("o_orderpriority"))
    )
    account = F.when(odd & (k == 2), F.lit("99999999999999999999")).when(odd & (k == 3), F.lit("100.0000001")).otherwise((k % 50).cast("string"))
    month = F.when(odd & (k == 4), F.lit("13")).otherwise(F.month("o_orderdate").cast("string"))
    fields = [k.cast("string"), F.year("o_orderdate").cast("string"), month, account, F.col("o_totalprice").cast("string"), note]
    lines = o.select(k.alias("k"), F.concat_ws(",", *fields).alias("value"))
    header = spark.createDataFrame([(-1, ",".join(COLUMNS))], "k long, value string")

    def write(number: int, target: str) -> None:
        folder = scratch_path(spark, "lines") + "/text"
        one = lines.filter((F.col("k") % 8 == number) & (F.col("k") >= 0)).unionByName(header)
        one.orderBy("k").coalesce(1).select("value").write.text(folder)
        _move_part(spark, folder, target)

    for n in range(8):
        name = "_LE_5.csv" if n == 5 else f"ledger_{n}.csv"
        write(n, f"{src}/b/{name}")
    write(1, f"{src}/a/ledger_0.csv")  # the smaller path of this name is bad
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{src}/b/ledger_empty.csv")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    return src


_BAD: dict[tuple[int, str], Warehouse] = {}


def _bad_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """The extracts imported, once per session and folder."""
    key = (id(spark), sf.rstrip("/"))
    if key not in _BAD:
        wh = Warehouse(scratch_path(spark, "warehouse"))
        import_files(spark, wh, [_bad_extracts(spark, sf)])
        _BAD[key] = wh
    return _BAD[key]


def _loaded(wh: Warehouse, spark: SparkSession) -> DataFrame:
    feeds = ["actuals", "forecast_live_estimate"]
    parts = [wh.read_feed(spark, f).withColumn("feed", F.lit(f)) for f in feeds]
    return parts[0].unionByName(parts[1])


SQL_BAD_FILES = """
select 'row' kind, case when o_orderkey % 8 = 5 then '_LE_5.csv' else 'ledger_' || (o_orderkey % 8) || '.csv' end file_name,
  case when o_orderkey % 8 = 5 then 'forecast_live_estimate' else 'actuals' end feed,
  o_orderkey, cast(o_orderkey % 50 as bigint) gl, o_totalprice amount,
  case o_orderkey % 8 when 6 then 'two' || chr(10) || 'lines " ' || o_orderpriority
       when 7 then o_orderpriority || ' 5" pipe' else o_orderpriority end note,
  make_timestamp(cast(extract(year from o_orderdate) as bigint), cast(extract(month from o_orderdate) as bigint), 1, 0, 0, 0)
    partition_date
from orders where o_orderkey % 8 in (0, 5, 6, 7)
union all
select 'rejected', f.file_name, null, null, null, null, f.reason, null from (values
  ('ledger_0.csv', 'open quote'), ('ledger_1.csv', 'open quote'), ('ledger_2.csv', 'value of G/L Account'),
  ('ledger_3.csv', 'value of G/L Account'), ('ledger_4.csv', 'month'), ('ledger_empty.csv', 'empty')) f(file_name, reason)
"""


def ingest_bad_files(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that load and files that do not, with why."""
    wh = _bad_warehouse(spark, sf)
    rows = _loaded(wh, spark).select(
        F.lit("row").alias("kind"),
        col("source_file").alias("file_name"),
        "feed",
        col("Purchasing Document").cast("bigint").alias("o_orderkey"),
        col("G/L Account").alias("gl"),
        col(AMOUNT).alias("amount"),
        col("Note").alias("note"),
        col("PartitionDate").alias("partition_date"),
    )
    reason = (
        F.when(F.col("reason").contains("not closed"), "open quote")
        .when(F.col("reason").contains("G/L Account"), "value of G/L Account")
        .when(F.col("reason").contains("month"), "month")
        .when(F.col("reason").contains("empty"), "empty")
        .otherwise(F.col("reason"))
    )
    rejected = spark.read.parquet(wh.quarantine_path).select(F.lit("rejected").alias("kind"), "file_name", reason.alias("note"))
    return rows.unionByName(rejected, allowMissingColumns=True)


SQL_LEDGER_ROWS = """
select case when o_orderkey % 8 = 5 then '_LE_5.csv' else 'ledger_' || (o_orderkey % 8) || '.csv' end file_name,
  true stamped, cast(1 as bigint) entries, count(*) n_rows
from orders where o_orderkey % 8 in (0, 5, 6, 7) group by 1
"""


def ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One stamped entry per loaded base name, with the rows its file has in bronze."""
    wh = _bad_warehouse(spark, sf)
    counts = _loaded(wh, spark).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    entries = read_ledger(spark, wh.ledger_path).groupBy("filename").agg(
        F.count(F.lit(1)).alias("entries"), F.every(F.col("ingested_at").isNotNull()).alias("stamped")
    )
    joined = entries.join(counts, F.col("filename") == F.col("source_file"), "full")
    return joined.select(F.coalesce("filename", "source_file").alias("file_name"), "stamped", "entries", "n_rows")


SQL_PARQUET = """
select 'row' kind, case o_orderkey % 3 when 0 then 'ledger_a.parquet' else 'ledger_b.parquet' end file_name, o_orderkey,
  cast(o_orderkey % 50 as bigint) gl, o_totalprice amount,
  case o_orderkey % 3 when 0 then 'A' || (o_orderkey % 9) else cast(o_orderkey % 9 as varchar) end code
from orders where o_orderkey % 3 in (0, 1)
union all
select 'rejected', 'ledger_c.parquet', null, null, null, 'column ''G/L Account'': 7.5'
"""


def ingest_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet extracts; an undeclared column that is text in the feed and long in a
    later file becomes text, a value that its column cannot hold rejects its file."""
    src = scratch_path(spark, "parquet-extracts")
    o, k = dt.table(spark, sf, "orders"), F.col("o_orderkey")
    base = [
        k.cast("string").alias("Purchasing Document"),
        F.year("o_orderdate").cast("long").alias("Fiscal Year"),
        F.month("o_orderdate").alias("Period"),
        F.col("o_totalprice").alias(AMOUNT),
    ]
    code = k % 9
    files = {
        "ledger_a": [(k % 50).cast("long").alias("G/L Account"), F.concat(F.lit("A"), code).alias("Code")],
        "ledger_b": [(k % 50).cast("double").alias("G/L Account"), code.alias("Code")],
        "ledger_c": [F.when(k == 2, 7.5).otherwise((k % 50).cast("double")).alias("G/L Account"), code.alias("Code")],
    }
    for number, (name, more) in enumerate(files.items()):
        folder = scratch_path(spark, "rows") + "/parquet"
        o.filter(k % 3 == number).select(*base, *more).coalesce(1).write.parquet(folder)
        _move_part(spark, folder, f"{src}/{name}.parquet")
    wh = Warehouse(scratch_path(spark, "warehouse"))
    import_files(spark, wh, [src], "parquet")
    rows = wh.read_feed(spark, "actuals").select(
        F.lit("row").alias("kind"),
        col("source_file").alias("file_name"),
        col("Purchasing Document").cast("bigint").alias("o_orderkey"),
        col("G/L Account").alias("gl"),
        col(AMOUNT).alias("amount"),
        col("Code").alias("code"),
    )
    rejected = spark.read.parquet(wh.quarantine_path).select(
        F.lit("rejected").alias("kind"), "file_name", F.col("reason").alias("code")
    )
    return rows.unionByName(rejected, allowMissingColumns=True)


#: Orders per extract file, so the number of files grows with the table.
ROWS_PER_FILE = 4096
BREAK_COLUMN = "Item\nText"
RAGGED_NAMES = ["ledger_0", "ledger_1", "x_ccdet_2", "ledger_3", "ledger_4", "ledger_5"]


def _write_files(spark: SparkSession, lines: DataFrame, folder: str, line_end: str) -> None:
    """``lines`` (name, k, value) as one text file per name, rows by k; each file is one task's."""
    written = scratch_path(spark, "lines") + "/text"
    dealt = lines.repartition("name").sortWithinPartitions("name", "k").select("name", "value")
    dealt.write.partitionBy("name").option("lineSep", line_end).text(written)
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(written).getFileSystem(conf)
    for status in fs.globStatus(path(f"{written}/name=*")):
        name = status.getPath().getName().partition("=")[2]
        _move_part(spark, f"{written}/name={name}", f"{folder}/{name}")


def _ragged_extracts(spark: SparkSession, sf: str) -> str:
    """Orders in six families of files by key, ``ROWS_PER_FILE`` keys each.

    0 good; 1 lines end with CR alone; 2 a header with a quoted line break; 3 and 4 the row
    whose key is the family's number has a field too many or lacks two; 5 CRLF, a delimiter at
    the end of every row, and line breaks inside quotes."""
    src = scratch_path(spark, "ragged-extracts")
    o = dt.table(spark, sf, "orders").filter("o_orderkey >= 0")
    k, n = F.col("o_orderkey"), len(RAGGED_NAMES)
    family = (k % n).cast("int")
    stem = F.element_at(F.array(*map(F.lit, RAGGED_NAMES)), family + 1)
    name = F.concat(stem, F.lit("_"), F.floor(k / n / ROWS_PER_FILE).cast("string"), F.lit(".csv"))
    odd = k == family
    note = F.when(family == 5, F.concat(F.lit('"two\r\nlines, '), F.col("o_orderpriority"), F.lit('"'))).otherwise(F.col("o_orderpriority"))
    fields = [k.cast("string"), F.year("o_orderdate").cast("string"), F.month("o_orderdate").cast("string"), (k % 50).cast("string")]
    fields += [F.col("o_totalprice").cast("string"), note]
    value = F.concat_ws(",", *fields)
    value = (
        F.when(odd & (family == 4), F.concat_ws(",", *fields[:4]))
        .when(odd & (family == 3), F.concat(value, F.lit(",11")))
        .when(family == 2, F.concat(value, F.lit(",item")))
        .when(family == 5, F.concat(value, F.lit(",")))
        .otherwise(value)
    )
    rows = o.select(name.alias("name"), family.alias("family"), k.alias("k"), value.alias("value"))
    plain = ",".join(COLUMNS)
    header = F.when(F.col("family") == 2, F.lit(f'{plain},"{BREAK_COLUMN}"')).otherwise(F.lit(plain))
    heads = rows.select("name", "family").distinct().select("name", "family", F.lit(-1).cast("long").alias("k"), header.alias("value"))
    lines = rows.unionByName(heads)
    for families, line_end in (([0, 2, 3, 4], "\n"), ([1], "\r"), ([5], "\r\n")):
        _write_files(spark, lines.filter(F.col("family").isin(families)), src, line_end)
    return src


SQL_RAGGED = """
with o as (select *, o_orderkey % 6 f, (o_orderkey // 6) // 4096 part from orders),
n as (select *, case f when 2 then 'x_ccdet_2' else 'ledger_' || f end || '_' || part || '.csv' file_name from o)
select 'row' kind, file_name, case f when 2 then 'cost_center_details' else 'actuals' end feed, o_orderkey,
  cast(o_orderkey % 50 as bigint) gl, o_totalprice amount,
  case f when 5 then 'two' || chr(13) || chr(10) || 'lines, ' || o_orderpriority else o_orderpriority end note,
  case f when 2 then 'item' end item,
  make_timestamp(cast(extract(year from o_orderdate) as bigint), cast(extract(month from o_orderdate) as bigint), 1, 0, 0, 0)
    partition_date
from n where f not in (3, 4) or part > 0
union all
select distinct 'rejected', file_name, null, null, null, null, 'not the 6 fields of the header: ' || f, null, null
from n where f in (3, 4) and part = 0
"""


def ingest_ragged(spark: SparkSession, sf: str) -> DataFrame:
    """No row shifts or drops values, any line end, headers over lines; a row of another shape rejects its file."""
    wh = Warehouse(scratch_path(spark, "warehouse"))
    import_files(spark, wh, [_ragged_extracts(spark, sf)])
    feeds = [wh.read_feed_or_empty(spark, f).withColumn("feed", F.lit(f)) for f in ("actuals", "cost_center_details")]
    loaded = feeds[0].unionByName(feeds[1], allowMissingColumns=True)
    rows = loaded.select(
        F.lit("row").alias("kind"),
        col("source_file").alias("file_name"),
        "feed",
        col("Purchasing Document").cast("bigint").alias("o_orderkey"),
        col("G/L Account").alias("gl"),
        col(AMOUNT).alias("amount"),
        col("Note").alias("note"),
        F.col(f"`{BREAK_COLUMN}`").alias("item"),
        col("PartitionDate").alias("partition_date"),
    )
    reason = F.regexp_extract("reason", r"^(not the \d+ fields of the header: \d+),", 1)
    rejected = spark.read.parquet(wh.quarantine_path).select(F.lit("rejected").alias("kind"), "file_name", reason.alias("note"))
    return rows.unionByName(rejected, allowMissingColumns=True)


SQL_CRASH = """
with o as (select *, 'ledger_' || (o_orderkey // 4096) || '.csv' file_name from orders)
select 'row' kind, file_name, o_orderkey, make_timestamp(2031, 2, 1, 0, 0, 0) partition_date, o_totalprice amount, null n from o
union all
select 'run ' || r, 'actuals', null, null, null, case r when 1 then 0 when 2 then (select count(*) from orders) else 0 end
from (values (1), (2), (3)) t(r)
union all
select 'commits', null, null, null, null, (select count(distinct file_name) from o)
"""


def crash_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A run stops between bronze and the ledger, its files change month and amount, two more runs follow.

    Rows as read in the end, rows visible after the first run and loaded by the next ones
    (as the writes counted them), and ledger entries."""
    from finlake.plans.ingest import frames_of, publish_group

    o, k = dt.table(spark, sf, "orders"), F.col("o_orderkey")
    name = F.concat(F.lit("ledger_"), F.floor(k / ROWS_PER_FILE).cast("string"), F.lit(".csv"))

    def extract(month: int, factor: int) -> str:
        folder = scratch_path(spark, "crash-extracts")
        fields = [k, F.lit(2031), F.lit(month), k % 50, F.col("o_totalprice") * factor, F.col("o_orderpriority")]
        value = F.concat_ws(",", *[f.cast("string") for f in fields])
        rows = o.select(name.alias("name"), k.alias("k"), value.alias("value"))
        heads = rows.select("name").distinct().select("name", F.lit(-1).cast("long").alias("k"), F.lit(",".join(COLUMNS)).alias("value"))
        _write_files(spark, rows.unionByName(heads), folder, "\n")
        return folder

    wh, work = Warehouse(scratch_path(spark, "warehouse")), scratch_path(spark, "work")
    before = [r["path"] for r in list_files(spark, [extract(1, 2)], "csv").select("path").collect()]
    for df, paths in frames_of(spark, before, "csv", None, work)[0]:
        publish_group(spark, wh, "actuals", df, paths, work)  # written, and never committed
    counts = [wh.read_feed(spark, "actuals").count()]
    after = extract(2, 1)
    counts += [import_files(spark, wh, [after]).rows["actuals"] for _ in range(2)]
    entries = read_ledger(spark, wh.ledger_path).count()
    told = [(f"run {i}", "actuals", n) for i, n in enumerate(counts, 1)] + [("commits", None, entries)]
    rows = wh.read_feed(spark, "actuals").select(
        F.lit("row").alias("kind"),
        col("source_file").alias("file_name"),
        col("Purchasing Document").cast("bigint").alias("o_orderkey"),
        col("PartitionDate").alias("partition_date"),
        col(AMOUNT).alias("amount"),
    )
    return rows.unionByName(spark.createDataFrame(told, "kind string, file_name string, n long"), allowMissingColumns=True)


FILE_QUERIES = {
    "crash_replay": (crash_replay, SQL_CRASH),
    "ingest_ragged": (ingest_ragged, SQL_RAGGED),
    "ingest_bad_files": (ingest_bad_files, SQL_BAD_FILES),
    "ledger_rows": (ledger_rows, SQL_LEDGER_ROWS),
    "ingest_parquet": (ingest_parquet, SQL_PARQUET),
}


# ---------------------------------------------------------------------------
# Every feed through files: extracts -> import -> transform -> gold re-read
# ---------------------------------------------------------------------------

RANGE = ("1997/01/01", "2024/01/01")


def _text(c) -> F.Column:
    return c.cast("string")


def _wbs_of(df: DataFrame, key: str, part: DataFrame) -> DataFrame:
    """``df`` with the WBS code (type letter and part key) of a key column as ``__wbs``."""
    codes = part.select(F.col("p_partkey").alias("__k"), F.concat(F.substring("p_type", 1, 1), _text(F.col("p_partkey"))).alias("__wbs"))
    return df.join(codes.filter("__k <> 0"), F.col(key) == F.col("__k"), "left")


def feed_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """File name -> rows of text: all nine feeds, with a column that a lookup supplies
    (WBS Type in the ledger), a Fiscal Period without Period (cost centre details), a Last
    Refresh with months from PERIOD (cost centre commitments, month 0 where it has no
    digits; forecasts, with total rows), and dates."""
    from finlake.plans.driver_files import lineitem_extract

    part, orders, events = (dt.table(spark, sf, t) for t in ("part", "orders", "events"))
    ledger = lineitem_extract(spark, sf)
    k = F.col("o_orderkey")
    common = [
        _text(k).alias("Purchasing Document"),
        _text(F.year("o_orderdate")).alias("Fiscal Year"),
        _text(k % 50 + 1).alias("G/L Account"),
        _text(F.col("o_totalprice")).alias(AMOUNT),
    ]
    wbs_rows = _wbs_of(orders, "o_custkey", part).select(
        *common,
        _text(F.month("o_orderdate")).alias("Period"),
        F.when(k % 7 != 0, F.col("__wbs")).alias("WBS Element"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("Posting Date"),
    )
    cc_rows = orders.select(
        *common,
        _text(F.year("o_orderdate")).alias("YEAR"),
        F.when(k % 11 == 0, F.lit("NONE")).otherwise(F.date_format("o_orderdate", "'M'MM'_T'")).alias("PERIOD"),
        F.lit("x").alias("Last Refresh"),
        F.when(k % 3 != 0, _text(F.floor(F.col("o_custkey") / 15))).alias("Cost Center"),
    )
    fc = _wbs_of(dt.forecast_bronze(events).withColumn("__user", F.col("CODE (L2)")), "__user", part)
    fc = fc.withColumn("CODE (L2)", F.col("__wbs")).drop("__user", "__k", "__wbs", "Fiscal Period", "PartitionDate")
    out = {
        "ledger_1.csv": ledger.withColumn("WBS Type", F.lit("not this")),
        "x_ccdet_1.csv": ledger.withColumnRenamed("Period", "Fiscal Period"),
        "commit_wbs_1.csv": wbs_rows,
        "commit_cc_1.csv": cc_rows,
        "wbs_budget_1.csv": wbs_rows,
    }
    for name in ("LE", "prebud", "bud", "T03", "T05", "T09", "t03"):
        rows = fc.filter(F.col("source_file") == f"fc_{name}_2024.csv").drop("source_file")
        out[f"fc_{name}_2024.csv"] = rows.select(*[_text(col(c)).alias(c) for c in rows.columns])
    return out


def _all_feeds_warehouse(spark: SparkSession, sf: str) -> Warehouse:
    from finlake.plans.driver_files import write_dimensions
    from finlake.plans.jobs import metadata_job

    root = scratch_path(spark, "all-feeds")
    wh = Warehouse(f"{root}/warehouse")
    write_dimensions(spark, sf, f"{root}/metadata")
    metadata_job(spark, wh, f"{root}/metadata", parquet_copies=False)
    extracts = feed_extracts(spark, sf)
    with ThreadPoolExecutor(AT_ONCE) as pool:  # the writes run side by side
        list(pool.map(lambda name: dt.write_csv(extracts[name], f"{root}/extracts/{name}", files=None), extracts))
    report = import_files(spark, wh, [f"{root}/extracts"])
    if report.rejected:
        raise RuntimeError(f"unexpected rejections: {report.rejected[:3]}")
    return wh


def warehouse_gold_all(spark: SparkSession, sf: str) -> DataFrame:
    """G1, G4, G5 and the sink over all feeds, with a range narrower than the data."""
    from finlake.plans.jobs import transform_job

    gold = transform_job(spark, _all_feeds_warehouse(spark, sf), scratch_path(spark, "gold"), *RANGE)
    # Range, months, lookup-supplied columns and the last column are all compared
    return gold.select(
        col("Purchasing Document").alias("document"),
        col("Reference Item").alias("item"),
        col("Scenario").alias("scenario"),
        col("source_file"),
        col(AMOUNT).alias("amount"),
        col("G/L Account").alias("gl"),
        col("Profit Center Code").alias("pc"),
        col("Compass Code").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("WBS Type").alias("wbs_type"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Posting Date").alias("posting_date"),
        col("Code 1 Concatenated").alias("code1"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
        F.col(gold.columns[-1]).alias("partition_date"),
    )
