"""Query catalogue: one Spark query per operator family of the warehouse, each
over the whole driver tables, with an equivalent DuckDB SQL oracle.

Spark queries are built from the finlake operators and plans; the SQL text is
only the independent check (run by the driver on sf0.01).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.file_queries import FILE_QUERIES, warehouse_gold_all
from finlake.functions.columns import (
    col,
    concat_codes,
    month_start,
    parse_date,
    period_digits,
    route_feed,
    trend_scenario,
)
from finlake.operators.frames import cast_by_type, union_by_name
from finlake.operators.lookup import duplicate_keys, key_stats
from finlake.plans import driver_tables as dt
from finlake.plans.dims import (
    chart_of_accounts,
    custom_wbs_elements,
    enhance_wbs_elements,
    fs_hierarchy,
    link_cost_center_to_compass,
    link_gl_to_compass,
    link_profit_center_to_signatures,
    ordered_hierarchy,
)
from finlake.plans.driver_files import lineitem_extract, write_dimensions
from finlake.plans.gold import assemble_gold, exclude_totals
from finlake.plans.jobs import import_job, metadata_job, transform_job
from finlake.plans.ingest import import_files
from finlake.plans.warehouse import Warehouse
from finlake.session import conf_override, scratch_path
from finlake.sources.gold_sink import read_gold, write_gold
from finlake.sources.ledger import new_files
from finlake.streaming.ingest_stream import ingest_available

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

AMOUNT = "Amount in Company Code Currency"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return register


# ---------------------------------------------------------------------------
# Shared oracle CTEs (DuckDB)
# ---------------------------------------------------------------------------

SQL_DIMS = """
wbs0 as (
  select nullif(p_partkey,0) wbs_code, p_name wbs_name,
         case when p_size%5=1 then 1 else 2 end wbs_level,
         cast(case when p_size%3=0 then null else p_size end as bigint) wbs_gl,
         case when p_partkey%4=0 then null else p_partkey end wbs_pc,
         p_partkey ord, substr(p_type,1,1) type_char from part),
cod as (select substr(p_type,1,1) type_char, min(p_type) wbs_type
        from part where p_type<>'PROMO' group by 1),
wbs as (select w.wbs_code, w.wbs_name, w.wbs_level, w.wbs_gl, w.wbs_pc, w.type_char, cod.wbs_type,
    last_value(case when wbs_level=1 then wbs_code end ignore nulls) over
      (order by ord rows between unbounded preceding and current row) parent_code,
    last_value(case when wbs_level=1 then wbs_name end ignore nulls) over
      (order by ord rows between unbounded preceding and current row) parent_name
  from wbs0 w left join cod on w.type_char is not distinct from cod.type_char),
cc as (select s.s_suppkey cc_code, s.s_suppkey cc_pc, n.n_regionkey compass_cc
       from supplier s join nation n on s.s_nationkey=n.n_nationkey),
comp as (select r_regionkey compass, r_name pl_text from region where r_regionkey<4),
glc as (select cast(g.gl as bigint) gl, m.compass gl_compass
        from (select distinct p_size gl from part) g
        left join (select distinct p_size gl, p_size%5 compass from part where p_size<40) m on g.gl=m.gl),
pcs as (select c.c_custkey pc, c.c_mktsegment division, c.c_nationkey sig_code, n.n_name sig_desc
        from customer c left join (select * from nation where n_nationkey<20) n on c.c_nationkey=n.n_nationkey)
"""


def _sql_ledger_fact(lo: str, hi: str, name: str = "fact") -> str:
    return f"""
{name} as (select l_orderkey, l_linenumber, l_partkey,
    cast(l_extendedprice as decimal(18,2)) amount,
    case when l_linenumber%3=0 then null else l_partkey end wbs_code,
    case when l_linenumber%2=0 then l_suppkey end cc_code,
    case when l_linenumber=5 then l_suppkey end partner_cc,
    case when l_returnflag='R' then l_partkey end product_code,
    cast(l_quantity as bigint) gl,
    case when l_linenumber<4 then l_orderkey // 10 end pc,
    cast(extract(year from l_shipdate) as bigint) fy,
    cast(extract(month from l_shipdate) as bigint) fp
  from lineitem
  where l_shipdate >= timestamp '{lo}' and l_shipdate < timestamp '{hi}')
"""


def _sql_ledger_gold(scenario: str, m_rule: bool, fact: str = "fact", p: str = "") -> str:
    m = "coalesce(type_char='M',false)" if m_rule else "false"
    return f"""
{p}a as (select f.l_orderkey, f.l_linenumber, f.l_partkey, -f.amount amount, f.wbs_code, f.cc_code,
    f.partner_cc, f.product_code, f.gl native_gl, coalesce(w.wbs_gl,f.gl) gl,
    coalesce(w.wbs_pc,f.pc) pc, w.type_char, w.wbs_type, w.parent_code, f.fy, f.fp
  from {fact} f left join wbs w on f.wbs_code is not distinct from w.wbs_code),
{p}b as (select a.*, coalesce(cc.compass_cc, glc.gl_compass) compass, coalesce(a.pc,cc.cc_pc) pc2
  from {p}a a left join glc on a.gl is not distinct from glc.gl
         left join cc on a.cc_code is not distinct from cc.cc_code),
{p}g as (select b.l_orderkey, b.l_linenumber, b.l_partkey, '{scenario}' scenario, b.amount, b.native_gl, b.gl,
  cast(b.compass as bigint) compass, comp.pl_text, b.pc2 pc, pcs.division, pcs.sig_desc,
  b.wbs_type, b.parent_code,
  case when wbs_code is not null and not {m} then 'WBS'
       when cc_code is not null or partner_cc is not null then 'COST CENTER'
       when (wbs_code is null or {m}) and product_code is not null then 'NO WBS'
       else 'FINANCE' end fiscal_type,
  b.fy as yr, b.fp as mon
from {p}b b left join comp on b.compass is not distinct from comp.compass
       left join pcs on b.pc2 is not distinct from pcs.pc
where b.fp<>0)
"""


def _ledger_gold_columns(g: DataFrame) -> DataFrame:
    return g.filter(col("Month") != 0).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("Native G/L Account").alias("native_gl"),
        col("G/L Account").alias("gl"),
        col("Compass Code").cast("bigint").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("Profit Center Code").alias("pc"),
        col("Division").alias("division"),
        col("Signature Description").alias("sig_desc"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Parent Code").alias("parent_code"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


# ---------------------------------------------------------------------------
# Gold feeds
# ---------------------------------------------------------------------------


@query(
    "gold_actuals",
    "with " + SQL_DIMS + "," + _sql_ledger_fact("1998-01-01", "1999-01-01") + "," + _sql_ledger_gold("Actuals", True)
    + "select * from g",
)
def q_gold_actuals(spark: SparkSession, sf: str) -> DataFrame:
    dims = dt.gold_dims(spark, sf)
    feed = dt.ledger_feed(dt.table(spark, sf, "lineitem"))
    g = assemble_gold(dims, actuals=feed, start="1998/01/01", end="1999/01/01")
    return _ledger_gold_columns(g)


@query(
    "gold_actuals_shuffle",
    "with " + SQL_DIMS + "," + _sql_ledger_fact("1998-01-01", "1999-01-01") + "," + _sql_ledger_gold("Actuals", True)
    + "select * from g",
)
def q_gold_actuals_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """Q1 with every lookup on the path for dimensions too large to
    broadcast: sort-merge joins (null-safe keys), skewed partitions such as
    the null WBS code split by AQE at run time."""
    with conf_override(spark, **{"finlake.broadcast.maxBytes": "0"}):
        dims = dt.build_gold_dims(dt.lookups(spark, sf))
        feed = dt.ledger_feed(dt.table(spark, sf, "lineitem"))
        g = assemble_gold(dims, actuals=feed, start="1998/01/01", end="1999/01/01")
        return _ledger_gold_columns(g)


@query(
    "gold_actuals_reduced",
    "with " + SQL_DIMS + "," + _sql_ledger_fact("1998-03-01", "1998-04-01") + "," + _sql_ledger_gold("Actuals", True)
    + "select * from g",
)
def q_gold_actuals_reduced(spark: SparkSession, sf: str) -> DataFrame:
    """J8-J11 with WBS elements too large to broadcast (the limit is half their measured size):
    cut to the codes that a month's facts hold, they fit, so no fact is shuffled."""
    dims = dt.gold_dims(spark, sf)
    limit = key_stats(dims.wbs_enhanced, ["WBS Element Code"]).bytes // 2
    with conf_override(spark, **{"finlake.broadcast.maxBytes": str(limit)}):
        feed = dt.ledger_feed(dt.table(spark, sf, "lineitem"))
        g = assemble_gold(dims, actuals=feed, start="1998/03/01", end="1998/04/01")
        return _ledger_gold_columns(g)


@query(
    "gold_cc_details",
    "with " + SQL_DIMS + "," + _sql_ledger_fact("1997-01-01", "1998-01-01")
    + "," + _sql_ledger_gold("Cost Center Details", False) + "select * from g",
)
def q_gold_cc_details(spark: SparkSession, sf: str) -> DataFrame:
    dims = dt.gold_dims(spark, sf)
    feed = dt.ledger_feed(dt.table(spark, sf, "lineitem"))
    g = assemble_gold(dims, cc_details=feed, start="1997/01/01", end="1998/01/01")
    return _ledger_gold_columns(g)


# ---------------------------------------------------------------------------
# Dimension operators
# ---------------------------------------------------------------------------


@query(
    "wbs_parent_fill",
    "with " + SQL_DIMS + """
select wbs_code, wbs_name, wbs_level, type_char, wbs_type, lower(wbs_type) wbs_typ_local, parent_code, parent_name
from wbs
""",
)
def q_wbs_parent_fill(spark: SparkSession, sf: str) -> DataFrame:
    part = dt.table(spark, sf, "part")
    w = enhance_wbs_elements(dt.wbs_elements(part), dt.wbs_codification(part))
    return w.select(
        col("WBS Element Code").alias("wbs_code"),
        col("WBS Element Name").alias("wbs_name"),
        col("WBS Level").alias("wbs_level"),
        col("WBS Type Char").alias("type_char"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Typ Local").alias("wbs_typ_local"),
        col("WBS Parent Code").alias("parent_code"),
        col("WBS Parent Name").alias("parent_name"),
    )


@query(
    "wbs_parent_fill_bucketed",
    "with " + SQL_DIMS + """
select wbs_code, wbs_name, wbs_level, type_char, wbs_type, lower(wbs_type) wbs_typ_local, parent_code, parent_name
from wbs
""",
)
def q_wbs_parent_fill_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """W1 through the scalable path: buckets of 16 rows, so the bucket
    summaries need a second, recursive level at every scale factor."""
    part = dt.table(spark, sf, "part")
    w = enhance_wbs_elements(dt.wbs_elements(part), dt.wbs_codification(part), bucket_rows=16)
    return w.select(
        col("WBS Element Code").alias("wbs_code"),
        col("WBS Element Name").alias("wbs_name"),
        col("WBS Level").alias("wbs_level"),
        col("WBS Type Char").alias("type_char"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Typ Local").alias("wbs_typ_local"),
        col("WBS Parent Code").alias("parent_code"),
        col("WBS Parent Name").alias("parent_name"),
    )


@query(
    "validate_many_to_one",
    """
select s_nationkey as nation_key, count(*) as n from supplier group by 1 having count(*) > 1
""",
)
def q_validate_many_to_one(spark: SparkSession, sf: str) -> DataFrame:
    sup = dt.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation_key"))
    return duplicate_keys(sup, "nation_key")


# ---------------------------------------------------------------------------
# Scalar functions and predicates
# ---------------------------------------------------------------------------

SQL_FORECAST_PERIOD = """
ev as (select event_id, event_type, cast(json_extract_string(props, '$.k') as bigint) k from events),
fp as (select event_id,
  case when event_type='error' then 'TOTAL'
       when event_type='signup' then 'TOTAL_B'
       when event_id % 17 = 0 then null
       else 'M' || lpad(cast(k % 13 as varchar), 2, '0') || '_T' end as period
  from ev)
"""


@query(
    "period_extract",
    "with " + SQL_FORECAST_PERIOD + """
select event_id, period,
  coalesce(try_cast(nullif(regexp_extract(period, '(\\d+)', 1), '') as bigint), 0) as fiscal_period
from fp
""",
)
def q_period_extract(spark: SparkSession, sf: str) -> DataFrame:
    fc = dt.forecast_bronze(dt.table(spark, sf, "events"))
    return fc.select("event_id", col("PERIOD").alias("period"), period_digits("PERIOD").alias("fiscal_period"))


@query(
    "period_date",
    """
select o_orderkey, cast(extract(year from o_orderdate) as bigint) fiscal_year, o_orderkey % 14 as period,
  case when o_orderkey % 14 between 1 and 12
       then make_timestamp(cast(extract(year from o_orderdate) as bigint), o_orderkey % 14, 1, 0, 0, 0) end as partition_date
from orders
""",
)
def q_period_date(spark: SparkSession, sf: str) -> DataFrame:
    o = dt.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("bigint").alias("fiscal_year"),
        (F.col("o_orderkey") % 14).alias("period"),
    )
    return o.withColumn("partition_date", month_start("fiscal_year", "period", strict=False))


@query(
    "not_in_null",
    "with " + SQL_FORECAST_PERIOD + """
select event_id, period from fp where period not in ('TOTAL', 'TOTAL_B', 'TOTAL_T')
""",
)
def q_not_in_null(spark: SparkSession, sf: str) -> DataFrame:
    fc = dt.forecast_bronze(dt.table(spark, sf, "events")).select("event_id", "PERIOD")
    return exclude_totals(fc).select("event_id", col("PERIOD").alias("period"))


SQL_ROUTE_NAMES = """
named as (select doc_id,
  ['x_CCDET_', 'commit_cc_', 'COMMIT_WBS_', 'wbs_budget_', 'f_LE_', 'f_prebud_', 'f_bud_', 'f_T03_', 'plain_', 'f_t05_'][doc_id % 10 + 1]
    || source || '.csv' as file_name
  from documents)
"""

ROUTE_PREFIXES = [
    "x_CCDET_",
    "commit_cc_",
    "COMMIT_WBS_",
    "wbs_budget_",
    "f_LE_",
    "f_prebud_",
    "f_bud_",
    "f_T03_",
    "plain_",
    "f_t05_",
]


@query(
    "route_feed",
    "with " + SQL_ROUTE_NAMES + """
select doc_id, file_name,
  case when contains(lower(file_name), 'ccdet') then 'cost_center_details'
       when contains(lower(file_name), 'commit_cc') then 'commit_cc'
       when contains(lower(file_name), 'commit_wbs') then 'commit_wbs'
       when contains(lower(file_name), 'wbs_budget') then 'wbs_budget'
       when contains(lower(file_name), '_le_') then 'forecast_live_estimate'
       when contains(lower(file_name), '_prebud_') then 'forecast_pre_budget'
       when contains(lower(file_name), '_bud_') then 'forecast_budget'
       when contains(lower(file_name), '_t0') then 'forecast_trend'
       else 'actuals' end as feed
from named
""",
)
def q_route_feed(spark: SparkSession, sf: str) -> DataFrame:
    docs = dt.table(spark, sf, "documents")
    prefix = F.element_at(F.array(*[F.lit(p) for p in ROUTE_PREFIXES]), (F.col("doc_id") % 10 + 1).cast("int"))
    named = docs.select("doc_id", F.concat(prefix, F.col("source"), F.lit(".csv")).alias("file_name"))
    return named.withColumn("feed", route_feed("file_name"))


@query(
    "trend_scenario",
    """
with named as (select doc_id,
  source || '_' || ['T03', 'T05', 'T09', 't03', 'X'][doc_id % 5 + 1] || '.csv' as source_file from documents)
select doc_id, source_file,
  case when contains(source_file, 'T03') then 'Trend 3'
       when contains(source_file, 'T05') then 'Trend 5'
       when contains(source_file, 'T09') then 'Trend 9' end as scenario
from named
""",
)
def q_trend_scenario(spark: SparkSession, sf: str) -> DataFrame:
    docs = dt.table(spark, sf, "documents")
    tok = F.element_at(F.array(*[F.lit(t) for t in ("T03", "T05", "T09", "t03", "X")]), (F.col("doc_id") % 5 + 1).cast("int"))
    named = docs.select("doc_id", F.concat(F.col("source"), F.lit("_"), tok, F.lit(".csv")).alias("source_file"))
    return named.withColumn("scenario", trend_scenario("source_file"))


@query(
    "code_concat",
    """
select c_custkey, case when c_custkey % 7 = 0 then null else c_name end || c_mktsegment as code_concat from customer
""",
)
def q_code_concat(spark: SparkSession, sf: str) -> DataFrame:
    c = dt.table(spark, sf, "customer")
    code = F.when(F.col("c_custkey") % 7 != 0, F.col("c_name"))
    return c.select("c_custkey", concat_codes(code, F.col("c_mktsegment")).alias("code_concat"))


@query(
    "union_missing",
    """
select o_orderkey as "key", o_totalprice as amount, 'Orders' as scenario, o_orderdate as posted from orders
union all by name
select c_custkey as "key", c_mktsegment as segment, 'Customers' as scenario from customer
""",
)
def q_union_missing(spark: SparkSession, sf: str) -> DataFrame:
    o = dt.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_totalprice").alias("amount"),
        F.lit("Orders").alias("scenario"),
        F.col("o_orderdate").alias("posted"),
    )
    c = dt.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit("Customers").alias("scenario")
    )
    return union_by_name([o, c])


@query(
    "cast_by_type",
    """
select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) l_linenumber,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
from lineitem
""",
)
def q_cast_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return cast_by_type(dt.table(spark, sf, "lineitem"), T.IntegerType(), T.LongType())


SQL_DATE_TEXT = """
dt as (select o_orderkey,
  case when o_orderstatus = 'O' then strftime(o_orderdate, '%m/%d/%Y')
       else strftime(o_orderdate, '%-m/%-d/%Y') end as date_text,
  o_orderstatus from orders)
"""


def _date_text(spark: SparkSession, sf: str) -> DataFrame:
    o = dt.table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(
        F.date_format("o_orderdate", "M/d/yyyy")
    )
    return o.select("o_orderkey", text.alias("date_text"), "o_orderstatus")


@query(
    "strict_dates",
    "with " + SQL_DATE_TEXT + """
select o_orderkey, date_text, strptime(date_text, '%m/%d/%Y') as parsed from dt
""",
)
def q_strict_dates(spark: SparkSession, sf: str) -> DataFrame:
    d = _date_text(spark, sf)
    return d.select("o_orderkey", "date_text", parse_date("date_text", strict=True).alias("parsed"))


@query(
    "soft_dates",
    "with " + SQL_DATE_TEXT + """
, bad as (select o_orderkey, case when o_orderstatus = 'P' then 'n/a ' || date_text else date_text end date_text from dt)
select o_orderkey, date_text, try_strptime(date_text, '%m/%d/%Y') as parsed from bad
""",
)
def q_soft_dates(spark: SparkSession, sf: str) -> DataFrame:
    d = _date_text(spark, sf)
    d = d.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a "), F.col("date_text")))
        .otherwise(F.col("date_text"))
        .alias("date_text"),
    )
    return d.select("o_orderkey", "date_text", parse_date("date_text", strict=False).alias("parsed"))


# ---------------------------------------------------------------------------
# Ingest ledger
# ---------------------------------------------------------------------------


@query(
    "new_files",
    """
with files as (select distinct 'in/' || lang || '/' || source || '.csv' as path, source || '.csv' as file_name from documents),
ledger as (select distinct d.source || '.csv' as filename
           from documents d join labels l on d.doc_id = l.doc_id
           where l.toxic = 1 and l.quality = 0 and d.lang = 'de')
select path, file_name from files where file_name not in (select filename from ledger)
""",
)
def q_new_files(spark: SparkSession, sf: str) -> DataFrame:
    docs = dt.table(spark, sf, "documents")
    labels = dt.table(spark, sf, "labels")
    files = docs.select(
        F.concat(F.lit("in/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit(".csv")).alias("path"),
        F.concat(F.col("source"), F.lit(".csv")).alias("file_name"),
    ).distinct()
    ledger = (
        docs.join(labels, "doc_id")
        .filter((F.col("toxic") == 1) & (F.col("quality") == 0) & (F.col("lang") == "de"))
        .select(F.concat(F.col("source"), F.lit(".csv")).alias("filename"))
        .distinct()
    )
    return new_files(files, ledger).select("path", "file_name")


# ---------------------------------------------------------------------------
# Hierarchy
# ---------------------------------------------------------------------------

SQL_TREE = """
items as (
  select 'R' || r_regionkey as fsi, r_name as text from region
  union all select 'N' || n_nationkey, case when n_nationkey % 7 = 3 then null else n_name end from nation
  union all select 'S' || s_suppkey, s_name from supplier),
links as (
  select cast(r_regionkey + 1 as bigint) as id, 'R' || r_regionkey as fsi, cast(0 as bigint) as parent from region
  union all select cast(n_nationkey + 100 as bigint), 'N' || n_nationkey, cast(n_regionkey + 1 as bigint) from nation
  union all select cast(s_suppkey + 1000 as bigint), 'S' || s_suppkey, cast(s_nationkey + 100 as bigint) from supplier),
nodes as (select l.id, l.fsi, coalesce(i.text, l.fsi) as text, l.parent from links l join items i on l.fsi = i.fsi),
walk as (
  select id, parent as cur, text as path, 0 as lvl from nodes
  union all
  select w.id, p.parent, p.text || ' > ' || w.path, w.lvl + 1
  from walk w join nodes p on p.id = w.cur where w.cur is not null and w.cur <> 0),
tree as (select n.id, n.fsi, n.text, n.parent, w.path as hierarchy, cast(w.lvl as bigint) as level
         from nodes n join walk w on w.id = n.id where w.cur is null or w.cur = 0)
"""


def _tree(spark: SparkSession, sf: str, widen: bool) -> DataFrame:
    items, links = dt.hierarchy_nodes(
        dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"), dt.table(spark, sf, "supplier")
    )
    return fs_hierarchy(items, links, widen=widen)


@query("hierarchy_paths", "with recursive " + SQL_TREE + " select * from tree")
def q_hierarchy_paths(spark: SparkSession, sf: str) -> DataFrame:
    h = _tree(spark, sf, widen=False)
    return h.select(
        col("ID").alias("id"),
        col("Financial Statement Item").alias("fsi"),
        col("Text").alias("text"),
        col("ID2").alias("parent"),
        col("Hierarchy").alias("hierarchy"),
        col("Level").alias("level"),
    )


@query(
    "hierarchy_levels",
    "with recursive " + SQL_TREE + """
select id, hierarchy, level,
  string_split(hierarchy, ' > ')[1] as level_0_text,
  string_split(hierarchy, ' > ')[2] as level_1_text,
  string_split(hierarchy, ' > ')[3] as level_2_text
from tree
""",
)
def q_hierarchy_levels(spark: SparkSession, sf: str) -> DataFrame:
    h = _tree(spark, sf, widen=True)
    levels = [c for c in h.columns if c.startswith("Level ") and c.endswith(" Text")]
    return h.select(
        col("ID").alias("id"),
        col("Hierarchy").alias("hierarchy"),
        col("Level").alias("level"),
        *[col(c).alias(c.lower().replace(" ", "_")) for c in levels],
    )


@query(
    "hierarchy_order",
    "with recursive " + SQL_TREE + " select row_number() over (order by id) as position, id, hierarchy from tree",
)
def q_hierarchy_order(spark: SparkSession, sf: str) -> DataFrame:
    """O1: the hierarchy in ID order, as consecutive numbers."""
    h = ordered_hierarchy(_tree(spark, sf, widen=False), position="Position")
    return h.select(col("Position").alias("position"), col("ID").alias("id"), col("Hierarchy").alias("hierarchy"))


@query(
    "chart_of_accounts",
    "with recursive " + SQL_TREE + """,
fs_and_gl as (select 'N' || c_nationkey as fsi, c_custkey as gl, c_name as short_text, c_mktsegment as long_text from customer)
select t.id, t.fsi, t.text, g.gl as gl_account, g.short_text, g.long_text, t.hierarchy, t.level,
  string_split(t.hierarchy, ' > ')[1] as level_0_text,
  string_split(t.hierarchy, ' > ')[2] as level_1_text,
  string_split(t.hierarchy, ' > ')[3] as level_2_text
from tree t left join fs_and_gl g on t.fsi = g.fsi
""",
)
def q_chart_of_accounts(spark: SparkSession, sf: str) -> DataFrame:
    h = _tree(spark, sf, widen=True)
    links, accounts = dt.chart_inputs(dt.table(spark, sf, "customer"))
    chart = chart_of_accounts(h, links, accounts)
    names = {
        "ID": "id",
        "Financial Statement Item": "fsi",
        "Text": "text",
        "G/L Account": "gl_account",
        "Short Text": "short_text",
        "G/L Acct Long Text": "long_text",
        "Hierarchy": "hierarchy",
        "Level": "level",
    }
    return chart.select(*[col(c).alias(names.get(c, c.lower().replace(" ", "_"))) for c in chart.columns])


SQL_COMMIT_WBS = """
cw as (select o_orderkey, cast(o_totalprice as decimal(18,2)) amount,
   case when o_orderkey % 7 <> 0 then o_custkey end wbs_code,
   cast(o_orderkey % 50 + 1 as bigint) gl,
   case when o_orderstatus = 'P' then 'not a date' else strftime(o_orderdate, '%m/%d/%Y') end posting_text,
   cast(extract(year from o_orderdate) as bigint) fy, cast(case when o_orderkey % 11 = 0 then 0 else extract(month from o_orderdate) end as bigint) fp
 from orders),
cwa as (select c.o_orderkey, 'Committed' scenario, c.amount, c.gl native_gl, coalesce(w.wbs_gl, c.gl) gl,
    w.wbs_pc pc, w.wbs_type, w.parent_code, 'WBS' fiscal_type,
    try_strptime(c.posting_text, '%m/%d/%Y') posting_date, c.fy yr, c.fp mon
  from cw c left join wbs w on c.wbs_code is not distinct from w.wbs_code),
cwg as (select g.*, cast(glc.gl_compass as bigint) compass, comp.pl_text, pcs.division, pcs.sig_desc
  from cwa g left join glc on g.gl is not distinct from glc.gl
   left join pcs on g.pc is not distinct from pcs.pc
   left join comp on glc.gl_compass is not distinct from comp.compass
  where g.mon <> 0)
"""

SQL_COMMIT_CC = """
ccf as (select o_orderkey, cast(o_totalprice as decimal(18,2)) amount,
   case when o_orderkey % 3 <> 0 then o_custkey // 15 end cc_code,
   cast(o_orderkey % 50 + 1 as bigint) gl,
   case when o_orderpriority = '5-LOW' then null else strftime(o_orderdate, '%-m/%-d/%Y') end delivery_text,
   cast(extract(year from o_orderdate) as bigint) fy, cast(case when o_orderkey % 11 = 0 then 0 else extract(month from o_orderdate) end as bigint) fp
 from orders),
ccg as (select f.o_orderkey, 'Committed' scenario, f.amount, f.gl,
   cast(coalesce(cc.compass_cc, glc.gl_compass) as bigint) compass, comp.pl_text, cc.cc_pc pc,
   pcs.division, pcs.sig_desc, 'COST CENTER' fiscal_type,
   try_strptime(f.delivery_text, '%m/%d/%Y') delivery_date, f.fy yr, f.fp mon
  from ccf f left join glc on f.gl is not distinct from glc.gl
   left join cc on f.cc_code is not distinct from cc.cc_code
   left join pcs on cc.cc_pc is not distinct from pcs.pc
   left join comp on coalesce(cc.compass_cc, glc.gl_compass) is not distinct from comp.compass
  where f.fp <> 0)
"""


def _sql_forecast(lo: str, hi: str) -> str:
    return f"""
ev2 as (select event_id, cast(json_extract_string(props, '$.k') as bigint) k, event_type, user_id, value from events),
fb as (select event_id,
   cast(2023 + k % 2 as bigint) yr,
   case when event_type = 'error' then 'TOTAL' when event_type = 'signup' then 'TOTAL_B'
        when event_id % 17 = 0 then null
        else 'M' || lpad(cast(k % 13 as varchar), 2, '0') || '_T' end period,
   event_type spend_type,
   cast(value as decimal(18,2)) amount,
   case when event_id % 4 <> 0 then user_id end code1,
   case when event_id % 6 <> 0 then 'cc-' || event_type end code1_desc,
   case when event_id % 5 <> 0 then user_id end code2,
   'wbs' code2_desc,
   case when event_id % 3 <> 0 then event_id % 5 end compass_native,
   case when event_id % 2 <> 0 then cast(floor(value) as bigint) % 50 end gl_native,
   case event_id % 4 when 0 then 'fc_LE_2024.csv' when 1 then 'fc_prebud_2024.csv' when 2 then 'fc_bud_2024.csv'
     else ['fc_T03_2024.csv', 'fc_T05_2024.csv', 'fc_T09_2024.csv', 'fc_t03_2024.csv'][(event_id // 4) % 4 + 1]
   end source_file
  from ev2),
fc as (select *, coalesce(try_cast(nullif(regexp_extract(period, '(\\d+)', 1), '') as bigint), 0) fp from fb),
fcd as (select *, case when fp <> 0 then make_timestamp(yr, fp, 1, 0, 0, 0) end pdate from fc),
routed as (select *,
   case when contains(lower(source_file), '_le_') then 'Live Estimate'
        when contains(lower(source_file), '_prebud_') then 'Pre-Budget'
        when contains(lower(source_file), '_bud_') then 'Budget'
        when contains(source_file, 'T03') then 'Trend 3'
        when contains(source_file, 'T05') then 'Trend 5'
        when contains(source_file, 'T09') then 'Trend 9' end scenario
  from fcd
  where period not in ('TOTAL', 'TOTAL_B', 'TOTAL_T')
    and pdate >= timestamp '{lo}' and pdate < timestamp '{hi}'),
fcg as (select r.event_id, r.scenario, -r.amount amount, coalesce(r.gl_native, w.wbs_gl) gl,
   cast(coalesce(cc.cc_pc, w.wbs_pc) as varchar) pc,
   cast(coalesce(r.compass_native, cc.compass_cc) as varchar) compass,
   cast(r.code1 as varchar) || r.code1_desc code1_concat,
   cast(r.code2 as varchar) || r.code2_desc code2_concat,
   w.wbs_pc, r.spend_type fiscal_type, r.yr, r.fp mon
 from routed r left join cc on r.code1 is not distinct from cc.cc_code
   left join wbs w on r.code2 is not distinct from w.wbs_code
 where r.fp <> 0)
"""


@query("gold_commit_wbs", "with " + SQL_DIMS + "," + SQL_COMMIT_WBS + " select * from cwg")
def q_gold_commit_wbs(spark: SparkSession, sf: str) -> DataFrame:
    dims = dt.gold_dims(spark, sf)
    g = assemble_gold(dims, commit_wbs=dt.commit_wbs_feed(dt.table(spark, sf, "orders")))
    return g.filter(col("Month") != 0).select(
        "o_orderkey",
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("Native G/L Account").alias("native_gl"),
        col("G/L Account").alias("gl"),
        col("Profit Center Code").alias("pc"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Parent Code").alias("parent_code"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Posting Date").alias("posting_date"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
        col("Compass Code").cast("bigint").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("Division").alias("division"),
        col("Signature Description").alias("sig_desc"),
    )


@query("gold_commit_cc", "with " + SQL_DIMS + "," + SQL_COMMIT_CC + " select * from ccg")
def q_gold_commit_cc(spark: SparkSession, sf: str) -> DataFrame:
    dims = dt.gold_dims(spark, sf)
    g = assemble_gold(dims, commit_cc=dt.commit_cc_feed(dt.table(spark, sf, "orders")))
    return g.filter(col("Month") != 0).select(
        "o_orderkey",
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("G/L Account").alias("gl"),
        col("Compass Code").cast("bigint").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("Profit Center Code").alias("pc"),
        col("Division").alias("division"),
        col("Signature Description").alias("sig_desc"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Delivery Date").alias("delivery_date"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


FORECAST_RANGE = ("2023-01-01", "2025-01-01")


@query("gold_forecast", "with " + SQL_DIMS + "," + _sql_forecast(*FORECAST_RANGE) + " select * from fcg")
def q_gold_forecast(spark: SparkSession, sf: str) -> DataFrame:
    dims = dt.gold_dims(spark, sf)
    forecasts = dt.forecast_bronze(dt.table(spark, sf, "events"))  # one scan; feed from file name
    g = assemble_gold(dims, forecasts=forecasts, start="2023/01/01", end="2025/01/01")
    return _forecast_columns(g)


def _forecast_columns(g: DataFrame) -> DataFrame:
    return g.filter(col("Month") != 0).select(
        "event_id",
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("G/L Account").alias("gl"),
        col("Profit Center Code").alias("pc"),
        col("Compass Code").alias("compass"),
        col("Code 1 Concatenated").alias("code1_concat"),
        col("Code 2 Concatenated").alias("code2_concat"),
        col("WBS Profit Center Code").alias("wbs_pc"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


#: Wider than any table: gold_all keeps every month.
ALL_RANGE = ("1900-01-01", "2200-01-01")

SQL_GOLD_ALL = (
    "with "
    + SQL_DIMS
    + ","
    + _sql_ledger_fact(*ALL_RANGE, name="fact")
    + ","
    + _sql_ledger_gold("Actuals", True, "fact", "act_")
    + ","
    + _sql_ledger_gold("Cost Center Details", False, "fact", "ccd_")
    + ","
    + SQL_COMMIT_WBS
    + ","
    + SQL_COMMIT_CC
    + ","
    + _sql_forecast(*ALL_RANGE)
    + """
select l_orderkey, l_linenumber, null::bigint o_orderkey, null::bigint event_id, scenario, fiscal_type, amount, gl,
       cast(pc as varchar) pc, cast(compass as varchar) compass, pl_text, yr, mon from act_g
union all
select l_orderkey, l_linenumber, null, null, scenario, fiscal_type, amount, gl,
       cast(pc as varchar), cast(compass as varchar), pl_text, yr, mon from ccd_g
union all
select null, null, o_orderkey, null, scenario, fiscal_type, amount, gl,
       cast(pc as varchar), cast(compass as varchar), pl_text, yr, mon from cwg
union all
select null, null, o_orderkey, null, scenario, fiscal_type, amount, gl,
       cast(pc as varchar), cast(compass as varchar), pl_text, yr, mon from ccg
union all
select null, null, null, event_id, scenario, fiscal_type, amount, gl,
       pc, compass, null, yr, mon from fcg
"""
)


def gold_all_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Every feed through its gold rule, unioned by name, with Year/Month."""
    dims = dt.gold_dims(spark, sf)
    lineitem = dt.table(spark, sf, "lineitem")
    orders = dt.table(spark, sf, "orders")
    return assemble_gold(
        dims,
        actuals=dt.ledger_feed(lineitem),
        cc_details=dt.ledger_feed(lineitem),
        commit_wbs=dt.commit_wbs_feed(orders),
        commit_cc=dt.commit_cc_feed(orders),
        forecasts=dt.forecast_bronze(dt.table(spark, sf, "events")),
        start=ALL_RANGE[0].replace("-", "/"),
        end=ALL_RANGE[1].replace("-", "/"),
    )


def _gold_all_columns(g: DataFrame) -> DataFrame:
    return g.filter(col("Month") != 0).select(
        "l_orderkey",
        "l_linenumber",
        "o_orderkey",
        "event_id",
        col("Scenario").alias("scenario"),
        col("Fiscal Type").alias("fiscal_type"),
        col(AMOUNT).alias("amount"),
        col("G/L Account").alias("gl"),
        col("Profit Center Code").cast("string").alias("pc"),
        col("Compass Code").cast("string").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


@query("gold_all", SQL_GOLD_ALL)
def q_gold_all(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_all_columns(gold_all_frame(spark, sf))


# ---------------------------------------------------------------------------
# Sinks and ingest round trips (files derived by Spark from the driver tables)
# ---------------------------------------------------------------------------


@query(
    "gold_roundtrip",
    "with " + SQL_DIMS + "," + _sql_ledger_fact("1998-01-01", "1999-01-01") + "," + _sql_ledger_gold("Actuals", True)
    + "select * from g",
)
def q_gold_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S14 + S15: gold actuals written partitioned by Year/Month, re-read."""
    dims = dt.gold_dims(spark, sf)
    feed = dt.ledger_feed(dt.table(spark, sf, "lineitem"))
    out = scratch_path(spark, "gold")
    write_gold(assemble_gold(dims, actuals=feed, start="1998/01/01", end="1999/01/01"), out)
    return _ledger_gold_columns(read_gold(spark, out))


SQL_ORDERS_EXTRACT = """
select o_orderkey, cast(extract(year from o_orderdate) as bigint) fiscal_year,
  cast(extract(month from o_orderdate) as bigint) period, o_totalprice amount,
  cast(o_custkey as varchar) wbs_element,
  case when o_orderkey % 3 = 0 then null else cast(o_custkey // 15 as varchar) end cost_center,
  o_orderkey % 10 reference_item, o_orderdate posting_date,
  case when o_orderpriority = '5-LOW' then null else o_orderpriority end item_text,
  o_orderstatus order_status,
  make_timestamp(cast(extract(year from o_orderdate) as bigint), cast(extract(month from o_orderdate) as bigint), 1, 0, 0, 0)
    partition_date
from orders
"""


def _bronze_orders(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        col("Purchasing Document").cast("bigint").alias("o_orderkey"),
        col("Fiscal Year").alias("fiscal_year"),
        col("Period").alias("period"),
        col("Amount in Company Code Currency").alias("amount"),
        col("WBS Element").alias("wbs_element"),
        col("Cost Center").alias("cost_center"),
        col("Reference Item").alias("reference_item"),
        col("Posting Date").alias("posting_date"),
        col("Journal Entry Item Text").alias("item_text"),
        col("Order Status").alias("order_status"),
        col("PartitionDate").alias("partition_date"),
    )


def _orders_source(spark: SparkSession, sf: str) -> str:
    """Orders written as CSV extracts in three folders (one per status)."""
    src = scratch_path(spark, "extracts")
    extract = dt.orders_extract(dt.table(spark, sf, "orders"))
    for status in ("F", "O", "P"):
        dt.write_csv(extract.filter(F.col("Order Status") == status), f"{src}/status_{status}")
    return src


@query("ingest_roundtrip", SQL_ORDERS_EXTRACT)
def q_ingest_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """List, ledger anti-join, route, header-grouped typed CSV read,
    partition date, strict dates, bronze write + ledger; then a second run
    (which must load nothing) and the bronze table read back."""
    src = _orders_source(spark, sf)
    wh = Warehouse(scratch_path(spark, "warehouse"))
    first = import_files(spark, wh, [src])
    if first.rejected:
        raise RuntimeError(f"unexpected rejections: {first.rejected[:3]}")
    second = import_files(spark, wh, [src])
    if second.ingested_count:
        raise RuntimeError("second import loaded files again")
    return _bronze_orders(wh.read_feed(spark, "actuals"))


@query("stream_ingest", SQL_ORDERS_EXTRACT)
def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same extracts through the file stream (availableNow)."""
    src = _orders_source(spark, sf)
    wh = Warehouse(scratch_path(spark, "warehouse"))
    ingest_available(spark, wh, src, checkpoint=scratch_path(spark, "stream-checkpoint"))
    return _bronze_orders(wh.read_feed(spark, "actuals"))


# ---------------------------------------------------------------------------
# End to end through files: metadata refresh -> import -> transform
# ---------------------------------------------------------------------------

SQL_FILE_DIMS = """
wbs0 as (
  select case when p_partkey = 0 then null else substr(p_type,1,1) || cast(p_partkey as varchar) end wbs_code,
         p_name wbs_name,
         case when p_size%5=1 then 1 else 2 end wbs_level,
         cast(case when p_size%3=0 then null else p_size end as bigint) wbs_gl,
         case when p_partkey%4=0 then null else cast(p_partkey as varchar) end wbs_pc,
         p_partkey ord,
         substr(case when p_partkey = 0 then null else substr(p_type,1,1) || cast(p_partkey as varchar) end, 1, 1)
           type_char from part),
cod as (select substr(p_type,1,1) type_char, min(p_type) wbs_type
        from part where p_type<>'PROMO' group by 1),
wbs as (select w.wbs_code, w.wbs_name, w.wbs_level, w.wbs_gl, w.wbs_pc, w.type_char, cod.wbs_type,
    last_value(case when wbs_level=1 then wbs_code end ignore nulls) over
      (order by ord rows between unbounded preceding and current row) parent_code
  from wbs0 w left join cod on w.type_char is not distinct from cod.type_char),
cc as (select cast(s.s_suppkey as varchar) cc_code, cast(s.s_suppkey as varchar) cc_pc,
              cast(n.n_regionkey as varchar) compass_cc
       from supplier s join nation n on s.s_nationkey=n.n_nationkey),
comp as (select cast(r_regionkey as varchar) compass, r_name pl_text from region),
glc as (select cast(g.gl as bigint) gl, m.compass gl_compass
        from (select distinct p_size gl from part) g
        left join (select distinct p_size gl, cast(p_size%6 as varchar) compass from part where p_size<40) m on g.gl=m.gl),
pcs as (select cast(c.c_custkey as varchar) pc, c.c_mktsegment division, n.n_name sig_desc
        from customer c left join (select * from nation where n_nationkey<20) n on c.c_nationkey=n.n_nationkey),
fact as (select l_orderkey, cast(l_linenumber as bigint) l_linenumber, l_partkey,
    l_extendedprice amount,
    case when l_linenumber%3=0 or l_partkey = 0 then null
         else substr(p.p_type,1,1) || cast(l_partkey as varchar) end wbs_code,
    case when l_linenumber%2=0 then cast(l_suppkey as varchar) end cc_code,
    case when l_linenumber=5 then cast(l_suppkey as varchar) end partner_cc,
    case when l_returnflag='R' then cast(l_partkey as varchar) end product_code,
    cast(l_quantity as bigint) gl,
    case when l_linenumber<4 then cast(l_orderkey // 10 as varchar) end pc,
    cast(extract(year from l_shipdate) as bigint) fy,
    cast(extract(month from l_shipdate) as bigint) fp
  from lineitem left join part p on l_partkey = p.p_partkey
  where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1999-01-01'),
a as (select f.l_orderkey, f.l_linenumber, f.l_partkey, -f.amount amount, f.wbs_code, f.cc_code,
    f.partner_cc, f.product_code, f.gl native_gl, coalesce(w.wbs_gl,f.gl) gl,
    coalesce(w.wbs_pc,f.pc) pc, w.type_char, w.wbs_type, w.parent_code, f.fy, f.fp
  from fact f left join wbs w on f.wbs_code is not distinct from w.wbs_code),
b as (select a.*, coalesce(cc.compass_cc, glc.gl_compass) compass, coalesce(a.pc,cc.cc_pc) pc2
  from a left join glc on a.gl is not distinct from glc.gl
         left join cc on a.cc_code is not distinct from cc.cc_code)
"""

SQL_WAREHOUSE_GOLD = "with " + SQL_FILE_DIMS + """
select b.l_orderkey, b.l_linenumber, b.l_partkey, 'Actuals' scenario, b.amount, b.native_gl, b.gl,
  b.compass, comp.pl_text, b.pc2 pc, pcs.division, pcs.sig_desc, b.wbs_type, b.parent_code,
  case when wbs_code is not null and not coalesce(type_char='M',false) then 'WBS'
       when cc_code is not null or partner_cc is not null then 'COST CENTER'
       when (wbs_code is null or coalesce(type_char='M',false)) and product_code is not null then 'NO WBS'
       else 'FINANCE' end fiscal_type,
  b.fy as yr, b.fp as mon
from b left join comp on b.compass is not distinct from comp.compass
       left join pcs on b.pc2 is not distinct from pcs.pc
where b.fp<>0
"""


_FILE_WAREHOUSES: dict[tuple[int, str], tuple[Warehouse, str]] = {}


def _file_warehouse(spark: SparkSession, sf: str) -> tuple[Warehouse, str]:
    """Write dimension files and a ledger extract, then refresh the
    dimensions and import the extract (once per session and folder)."""
    key = (id(spark), sf.rstrip("/"))
    if key not in _FILE_WAREHOUSES:
        _FILE_WAREHOUSES[key] = _build_file_warehouse(spark, sf)
    return _FILE_WAREHOUSES[key]


def _build_file_warehouse(spark: SparkSession, sf: str) -> tuple[Warehouse, str]:
    root = scratch_path(spark, "file-warehouse")
    wh = Warehouse(f"{root}/warehouse")
    write_dimensions(spark, sf, f"{root}/metadata")
    dt.write_csv(lineitem_extract(spark, sf), f"{root}/extracts/ledger", files=None)
    metadata_job(spark, wh, f"{root}/metadata")
    report = import_job(spark, wh, [f"{root}/extracts"])
    if report.rejected:
        raise RuntimeError(f"unexpected rejections: {report.rejected[:3]}")
    return wh, root


@query("warehouse_gold", SQL_WAREHOUSE_GOLD)
def q_warehouse_gold(spark: SparkSession, sf: str) -> DataFrame:
    """G1 through files: dimension CSVs (WBS file order kept across part
    files) -> metadata job -> CSV import -> transform -> gold re-read."""
    wh, root = _file_warehouse(spark, sf)
    gold = transform_job(spark, wh, scratch_path(spark, "gold"), "1998/01/01", "1999/01/01")
    return gold.select(
        col("Purchasing Document").cast("bigint").alias("l_orderkey"),
        col("Reference Item").alias("l_linenumber"),
        col("Material Code").cast("bigint").alias("l_partkey"),
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("Native G/L Account").alias("native_gl"),
        col("G/L Account").alias("gl"),
        col("Compass Code").alias("compass"),
        col("P&L Line Text").alias("pl_text"),
        col("Profit Center Code").alias("pc"),
        col("Division").alias("division"),
        col("Signature Description").alias("sig_desc"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Parent Code").alias("parent_code"),
        col("Fiscal Type").alias("fiscal_type"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


SQL_META_HIERARCHY = """
with recursive items as (
  select cast(r_regionkey as varchar) fsi, r_name text from region
  union all
  select 'N' || n_nationkey, case when n_nationkey % 7 = 3 then null else n_name end from nation),
links as (
  select cast(r_regionkey + 1 as bigint) id, cast(r_regionkey as varchar) fsi, cast(0 as bigint) parent
  from region
  union all
  select cast(n_nationkey + 100 as bigint), 'N' || n_nationkey, cast(n_regionkey + 1 as bigint)
  from nation),
nodes as (select l.id, l.fsi, coalesce(i.text, l.fsi) as text, l.parent from links l join items i on l.fsi = i.fsi),
walk as (
  select id, parent as cur, text as path, 0 as lvl from nodes
  union all
  select w.id, p.parent, p.text || ' > ' || w.path, w.lvl + 1
  from walk w join nodes p on p.id = w.cur where w.cur is not null and w.cur <> 0)
select n.id, n.fsi, n.text, n.parent, w.path as hierarchy, cast(w.lvl as bigint) as level,
  string_split(w.path, ' > ')[1] as level_0_text, string_split(w.path, ' > ')[2] as level_1_text
from nodes n join walk w on w.id = n.id where w.cur is null or w.cur = 0
"""


@query("metadata_hierarchy", SQL_META_HIERARCHY)
def q_metadata_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """S5 + S12 + H1/H2: the statement hierarchy table the metadata job
    built from the item and parent-link files, read back."""
    wh, _ = _file_warehouse(spark, sf)
    h = wh.read_meta(spark, "meta_fs_hierachy")
    return h.select(
        col("ID").alias("id"),
        col("Financial Statement Item").alias("fsi"),
        col("Text").alias("text"),
        col("ID2").alias("parent"),
        col("Hierarchy").alias("hierarchy"),
        col("Level").alias("level"),
        col("Level 0 Text").alias("level_0_text"),
        col("Level 1 Text").alias("level_1_text"),
    )


# ---------------------------------------------------------------------------
# Single dimension links (J5, J6, J7) and custom WBS elements (H4)
# ---------------------------------------------------------------------------


@query(
    "cost_center_compass",
    """
select s.s_suppkey cc_code, s.s_suppkey pc, n.n_regionkey compass
from supplier s join nation n on s.s_nationkey is not distinct from n.n_nationkey
""",
)
def q_cost_center_compass(spark: SparkSession, sf: str) -> DataFrame:
    """Cost centres joined (inner, m:1) to their node's compass code."""
    cc = link_cost_center_to_compass(
        dt.cost_centers(dt.table(spark, sf, "supplier")), dt.node_to_compass(dt.table(spark, sf, "nation"))
    )
    return cc.select(
        col("Cost Center Code").alias("cc_code"), col("Profit Center Code").alias("pc"), col("Compass Code").alias("compass")
    )


@query(
    "gl_compass",
    """
select g.gl, 'Account ' || cast(g.gl as varchar) long_text, m.compass
from (select distinct cast(p_size as bigint) gl from part) g
left join (select distinct cast(p_size as bigint) gl, p_size % 5 compass from part where p_size < 40) m
  on g.gl is not distinct from m.gl
""",
)
def q_gl_compass(spark: SparkSession, sf: str) -> DataFrame:
    """Every account with its compass code (left, 1:1)."""
    part = dt.table(spark, sf, "part")
    g = link_gl_to_compass(dt.gl_accounts(part), dt.gl_accounts_to_compass(part))
    return g.select(
        col("G/L Account").alias("gl"), col("G/L Acct Long Text").alias("long_text"), col("Compass Code").alias("compass")
    )


@query(
    "profit_center_signatures",
    """
select c.c_custkey pc, substr(c.c_mktsegment, 1, 3) division_abbreviation, c.c_mktsegment division,
  c.c_nationkey sig_code, n.n_name sig_desc
from customer c left join (select * from nation where n_nationkey < 20) n
  on c.c_nationkey is not distinct from n.n_nationkey
""",
)
def q_profit_center_signatures(spark: SparkSession, sf: str) -> DataFrame:
    """Profit centres with their signature description (left, m:1)."""
    pcs = link_profit_center_to_signatures(
        dt.profit_centers(dt.table(spark, sf, "customer")), dt.signatures(dt.table(spark, sf, "nation"))
    )
    return pcs.select(
        col("Profit Center Code").alias("pc"),
        col("Division Abbreviation").alias("division_abbreviation"),
        col("Division").alias("division"),
        col("Signature Code").alias("sig_code"),
        col("Signature Description").alias("sig_desc"),
    )


@query(
    "custom_wbs_elements",
    """
with w as (
  select case when p_partkey = 0 then null else substr(p_type,1,1) || cast(p_partkey as varchar) end code,
         p_name name, case when p_size % 5 = 1 then 1 else 2 end lvl,
         cast(case when p_size % 3 = 0 then null else p_size end as bigint) gl,
         case when p_partkey % 4 = 0 then null else cast(p_partkey as varchar) end pc,
         p_partkey ord from part),
cod as (select substr(p_type,1,1) type_char, min(p_type) wbs_type, lower(min(p_type)) type_local
        from part where p_type <> 'PROMO' group by 1)
select w.code wbs_code, w.name wbs_name, cast(w.lvl as bigint) wbs_level, w.gl wbs_gl, w.pc wbs_pc,
  last_value(case when w.lvl = 1 then w.code end ignore nulls)
    over (order by w.ord rows between unbounded preceding and current row) parent_code,
  last_value(case when w.lvl = 1 then w.name end ignore nulls)
    over (order by w.ord rows between unbounded preceding and current row) parent_name,
  substr(w.code, 1, 1) type_char, cod.wbs_type, cod.type_local wbs_type_local
from w left join cod on substr(w.code, 1, 1) is not distinct from cod.type_char
""",
)
def q_custom_wbs_elements(spark: SparkSession, sf: str) -> DataFrame:
    """H4 over the refreshed file dimensions: the WBS file (order kept) with
    parents, type char and codification under their lookup names."""
    wh, _ = _file_warehouse(spark, sf)
    w = custom_wbs_elements(wh.read_meta(spark, "meta_wbs_elements"), wh.read_meta(spark, "meta_wbs_codification"))
    return w.select(
        col("WBS Element Code").alias("wbs_code"),
        col("WBS Element Name").alias("wbs_name"),
        col("WBS Level").alias("wbs_level"),
        col("WBS G/L Account").alias("wbs_gl"),
        col("WBS Profit Center Code").alias("wbs_pc"),
        col("WBS Parent Code").alias("parent_code"),
        col("WBS Parent Name").alias("parent_name"),
        col("WBS Type Char").alias("type_char"),
        col("WBS Type").alias("wbs_type"),
        col("WBS Type Local").alias("wbs_type_local"),
    )


SQL_META_TABLES = """
select 'meta_company_divisions' tbl, c_mktsegment k, substr(c_mktsegment, 1, 3) v from (select distinct c_mktsegment from customer)
union all
select 'meta_fiscal_periods', cast(m as varchar), 'Period ' || m
from (select distinct cast(extract(month from o_orderdate) as bigint) m from orders)
union all
select 'meta_fiscal_scenarios', cast(r_regionkey as varchar), r_name from region
"""


@query("meta_tables", SQL_META_TABLES)
def q_meta_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Three small dimensions from the Parquet copies beside the inputs."""
    _, root = _file_warehouse(spark, sf)
    keys = {
        "meta_company_divisions": ("Division", "Abbreviation"),
        "meta_fiscal_periods": ("Fiscal Period", "Fiscal Period Text"),
        "meta_fiscal_scenarios": ("Fiscal Order", "Scenario"),
    }
    parts = [
        spark.read.parquet(f"{root}/metadata/{t}.parquet").select(
            F.lit(t).alias("tbl"), col(k).cast("string").alias("k"), col(v).alias("v")
        )
        for t, (k, v) in keys.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SQL_GOLD_RERUN = (
    "with "
    + SQL_DIMS
    + ","
    + _sql_ledger_fact("1997-01-01", "1999-01-01", name="fact")
    + ","
    + _sql_ledger_gold("Actuals", True, "fact", "act_")
    + ","
    + SQL_COMMIT_WBS
    + """
select l_orderkey, l_linenumber, null::bigint o_orderkey, scenario, amount, gl, yr, mon from act_g
union all
select null, null, o_orderkey, scenario, amount, gl, yr, mon from cwg
"""
)


@query("gold_rerun", SQL_GOLD_RERUN)
def q_gold_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over different ranges; the first run's actuals stay, the
    commitments (which ignore the range) are replaced, not doubled."""
    dims = dt.gold_dims(spark, sf)
    lineitem, orders = dt.table(spark, sf, "lineitem"), dt.table(spark, sf, "orders")
    out = scratch_path(spark, "gold")
    for start, end in (("1997/01/01", "1998/01/01"), ("1998/01/01", "1999/01/01")):
        gold = assemble_gold(
            dims, actuals=dt.ledger_feed(lineitem), commit_wbs=dt.commit_wbs_feed(orders), start=start, end=end
        )
        write_gold(gold, out)
    return read_gold(spark, out).select(
        "l_orderkey",
        "l_linenumber",
        "o_orderkey",
        col("Scenario").alias("scenario"),
        col(AMOUNT).alias("amount"),
        col("G/L Account").alias("gl"),
        col("Year").alias("yr"),
        col("Month").alias("mon"),
    )


for _name, (_run, _sql) in FILE_QUERIES.items():
    query(_name, _sql)(_run)


def _sql_file_ledger(p: str, scenario: str, source: str, m_rule: bool) -> str:
    m = "coalesce(type_char='M',false)" if m_rule else "false"
    return f"""
{p}a as (select f.*, -f.amount neg, coalesce(w.wbs_gl, f.gl) gl2, coalesce(w.wbs_pc, f.pc) pc1, w.type_char, w.wbs_type
  from fact f left join wbs w on f.wbs_code is not distinct from w.wbs_code),
{p}b as (select a.*, coalesce(cc.compass_cc, glc.gl_compass) compass, coalesce(a.pc1, cc.cc_pc) pc2
  from {p}a a left join glc on a.gl2 is not distinct from glc.gl left join cc on a.cc_code is not distinct from cc.cc_code),
{p}g as (select cast(l_orderkey as varchar) document, l_linenumber item, '{scenario}' scenario, '{source}' source_file, neg amount,
   gl2 gl, pc2 pc, b.compass, comp.pl_text, wbs_type,
   case when wbs_code is not null and not {m} then 'WBS' when cc_code is not null or partner_cc is not null then 'COST CENTER'
        when product_code is not null then 'NO WBS' else 'FINANCE' end fiscal_type,
   null::timestamp posting_date, null::varchar code1, fy yr, fp mon
  from {p}b b left join comp on b.compass is not distinct from comp.compass)
"""


SQL_WAREHOUSE_GOLD_ALL = (
    "with "
    + SQL_FILE_DIMS.split(",\nfact as")[0]
    + """,
fact as (select l_orderkey, cast(l_linenumber as bigint) l_linenumber, l_extendedprice amount,
    case when l_linenumber%3<>0 and l_partkey <> 0 then substr(p.p_type,1,1) || l_partkey end wbs_code,
    case when l_linenumber%2=0 then cast(l_suppkey as varchar) end cc_code,
    case when l_linenumber=5 then cast(l_suppkey as varchar) end partner_cc,
    case when l_returnflag='R' then cast(l_partkey as varchar) end product_code,
    cast(l_quantity as bigint) gl, case when l_linenumber<4 then cast(l_orderkey // 10 as varchar) end pc,
    cast(extract(year from l_shipdate) as bigint) fy, cast(extract(month from l_shipdate) as bigint) fp
  from lineitem left join part p on l_partkey = p.p_partkey
  where l_shipdate >= timestamp '1997-01-01' and l_shipdate < timestamp '2024-01-01'),
"""
    + _sql_file_ledger("act_", "Actuals", "ledger_1.csv", True)
    + ","
    + _sql_file_ledger("ccd_", "Cost Center Details", "x_ccdet_1.csv", False)
    + """,
ord as (select o_orderkey, o_totalprice amount, cast(o_orderkey % 50 + 1 as bigint) gl, o_orderdate, o_custkey,
   cast(extract(year from o_orderdate) as bigint) yr, cast(extract(month from o_orderdate) as bigint) mon from orders),
cwa as (select o.*, case when o_orderkey % 7 <> 0 and o_custkey <> 0 then substr(p.p_type,1,1) || o_custkey end wbs_code
  from ord o left join part p on o.o_custkey = p.p_partkey),
cwb as (select c.*, coalesce(w.wbs_gl, c.gl) gl2, w.wbs_pc, w.wbs_type
  from cwa c left join wbs w on c.wbs_code is not distinct from w.wbs_code),
cwg as (select cast(o_orderkey as varchar) document, null::bigint item, 'Committed' scenario, 'commit_wbs_1.csv' source_file, amount,
   gl2 gl, wbs_pc pc, glc.gl_compass compass, comp.pl_text, wbs_type, 'WBS' fiscal_type, o_orderdate posting_date, null::varchar code1,
   yr, mon
  from cwb left join glc on gl2 is not distinct from glc.gl left join comp on glc.gl_compass is not distinct from comp.compass),
cca as (select o.*, case when o_orderkey % 3 <> 0 then cast(o_custkey // 15 as varchar) end cc_code,
   case when o_orderkey % 11 = 0 then 0 else mon end fp from ord o),
ccg as (select cast(o_orderkey as varchar) document, null::bigint item, 'Committed' scenario, 'commit_cc_1.csv' source_file, amount,
   a.gl, cc.cc_pc pc, coalesce(cc.compass_cc, glc.gl_compass) compass, comp.pl_text, null::varchar wbs_type, 'COST CENTER' fiscal_type,
   null::timestamp posting_date, null::varchar code1, yr, cast(fp as bigint) mon
  from cca a left join glc on a.gl is not distinct from glc.gl left join cc on a.cc_code is not distinct from cc.cc_code
   left join comp on coalesce(cc.compass_cc, glc.gl_compass) is not distinct from comp.compass where fp <> 0),
ev as (select event_id, cast(json_extract_string(props, '$.k') as bigint) k, event_type, user_id, value from events),
fb as (select *, cast(2023 + k % 2 as bigint) yr,
   case when event_type = 'error' then 'TOTAL' when event_type = 'signup' then 'TOTAL_B' when event_id % 17 = 0 then null
        else 'M' || lpad(cast(k % 13 as varchar), 2, '0') || '_T' end period,
   case event_id % 4 when 0 then 'fc_LE_2024.csv' when 1 then 'fc_prebud_2024.csv' when 2 then 'fc_bud_2024.csv'
     else ['fc_T03_2024.csv', 'fc_T05_2024.csv', 'fc_T09_2024.csv', 'fc_t03_2024.csv'][(event_id // 4) % 4 + 1] end source_file
  from ev),
fc as (select *, coalesce(try_cast(nullif(regexp_extract(period, '(\\d+)', 1), '') as bigint), 0) fp from fb),
fcr as (select f.*, case when event_id % 4 <> 0 then cast(user_id as varchar) end code1,
   case when event_id % 5 <> 0 and user_id <> 0 then substr(p.p_type,1,1) || user_id end code2
  from fc f left join part p on f.user_id = p.p_partkey
  where period not in ('TOTAL', 'TOTAL_B', 'TOTAL_T') and fp between 1 and 12 and yr = 2023),
fcg as (select null::varchar document, null::bigint item,
   case when contains(source_file, '_LE_') then 'Live Estimate' when contains(source_file, '_prebud_') then 'Pre-Budget'
        when contains(source_file, '_bud_') then 'Budget' when contains(source_file, 'T03') then 'Trend 3'
        when contains(source_file, 'T05') then 'Trend 5' when contains(source_file, 'T09') then 'Trend 9' end scenario,
   source_file, -cast(cast(value as decimal(18,2)) as double) amount,
   coalesce(case when event_id % 2 <> 0 then cast(floor(value) as bigint) % 50 end, w.wbs_gl) gl,
   coalesce(cc.cc_pc, w.wbs_pc) pc, coalesce(case when event_id % 3 <> 0 then cast(event_id % 5 as varchar) end, cc.compass_cc) compass,
   null::varchar pl_text, w.wbs_type, event_type fiscal_type, null::timestamp posting_date,
   code1 || case when event_id % 6 <> 0 then 'cc-' || event_type end code1, yr, fp mon
  from fcr left join cc on code1 is not distinct from cc.cc_code left join wbs w on code2 is not distinct from w.wbs_code),
u as (select * from act_g union all select * from ccd_g union all select * from cwg union all select * from ccg
  union all select * from fcg)
select *, make_timestamp(yr, mon, 1, 0, 0, 0) partition_date from u
"""
)
query("warehouse_gold_all", SQL_WAREHOUSE_GOLD_ALL)(warehouse_gold_all)
