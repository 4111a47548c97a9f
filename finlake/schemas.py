"""Registries: raw column types, rename maps, feed names, dimension schemas.

Everything in the FIXED VALUES blocks must equal the source system's names for
results to line up; they are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
TS = T.TimestampNTZType()

# ---------------------------------------------------------------------------
# FIXED VALUES: declared types of raw fact columns (any other column is text).
# ---------------------------------------------------------------------------
RAW_TYPES: dict[str, T.DataType] = {
    "Accounting doc type": STRING,
    "Amount in Company Code Currency": DOUBLE,
    "Business Transaction": STRING,
    "CO Object Name": STRING,
    "Company Code": STRING,
    "Cost Center": STRING,
    "Cost Center Name": STRING,
    "Cost element": LONG,
    "Cost element descr.": STRING,
    "Distribution Channel": LONG,
    "Fiscal Period": LONG,
    "Fiscal Year": LONG,
    "G/L Account": LONG,
    "G/L Account Name": STRING,
    "G/L Account Type": STRING,
    "JE Type Name": STRING,
    "Journal Entry Item Text": STRING,
    "Journal Entry Type": STRING,
    "Ledger": STRING,
    "Material": STRING,
    "Name": STRING,
    "Object": STRING,
    "Object Currency": STRING,
    "Object Type": STRING,
    "Partner Cost Center": STRING,
    "Period": LONG,
    "Product": STRING,
    "Profit Center": STRING,
    "Profit Center Name": STRING,
    "Project": STRING,
    "Project External ID": STRING,
    "Project Name": STRING,
    "Project definition": STRING,
    "Purchasing Doc. Item": STRING,
    "Purchasing Document": STRING,
    "Quantity/Plan": DOUBLE,
    "Ref. document number": STRING,
    "Reference Doc. Type": STRING,
    "Reference Document Category": STRING,
    "Reference Item": LONG,
    "Semantic Tag": STRING,
    "Signature": STRING,
    "Signature Code": STRING,
    "Signature2": STRING,
    "Structure": STRING,
    "Supplier": STRING,
    "Total Quantity": DOUBLE,
    "Unit of Measure": STRING,
    "User Name": STRING,
    "Val.in rep.cur.": DOUBLE,
    "Val/COArea Crcy": DOUBLE,
    "Value TranCurr": DOUBLE,
    "Value in Obj. Crcy": DOUBLE,
    "WBS Element": STRING,
    "WBS Element Name": STRING,
    "WBS Element External ID": STRING,
    "YEAR": LONG,
    "PERIOD": STRING,
    "P&L DESTINATION ACCOUNT": LONG,
}
# Design decision: the forecast amount is typed as a number (it is text in the
# source system, where the sign flip then yields an empty string).
RAW_TYPES["Value"] = DOUBLE

# ---------------------------------------------------------------------------
# FIXED VALUES: renames applied to ledger-system feeds (exact case).
# ---------------------------------------------------------------------------
SAP_RENAME: dict[str, str] = {
    "Cost Center": "Cost Center Code",
    "Cost element": "G/L Account",
    "G/L Account Long Name": "G/L Account Name",
    "Material": "Material Code",
    "Partner Cost Center": "Partner Cost Center Code",
    "Profit Center": "Profit Center Code",
    "Product": "Product Code",
    "Product Description": "Product Name",
    "Project External ID": "Project Code",
    "Period": "Fiscal Period",
    "Signature": "Signature Code",
    "Value in Obj. Crcy": "Amount in Company Code Currency",
    "WBS Element": "WBS Element Code",
    "WBS Element External ID": "WBS Element Code",
    "WBS element": "WBS Element Code",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: renames applied to forecast feeds (note the double space in
# the first description header).
# ---------------------------------------------------------------------------
FORECAST_RENAME: dict[str, str] = {
    "AXE": "Axe",
    "BRAND": "Brand",
    "BUDGET OWNER": "Budget Owner",
    "CODE (L1_CC_Oth)": "Code 1",
    "CODE DESCRIPTION  (L1_CC_Oth)": "Code 1 Description",
    "CODE (L2)": "Code 2",
    "CODE DESCRIPTION (L2)": "Code 2 Description",
    "COMPANY CODE": "Company Code",
    "P&L LINE COMPASS CODE_FS": "Compass Code",
    "TYPE": "Detailed Type",
    "YEAR": "Fiscal Year",
    "P&L DESTINATION ACCOUNT": "G/L Account",
    "SIGNATURE CODE": "Signature Code",
    "SUB BRAND": "Sub Brand",
    "SUB-AXE": "Sub-Axe",
    "Value": "Amount in Company Code Currency",
    "PRODUCT CODE": "Product Code",
    "SPEND TYPE": "Spend Type",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: feed tables, and the routing of a file to its feed by the
# first token found in its lower-cased base name (fallback: actuals).
# ---------------------------------------------------------------------------
FEEDS = [
    "actuals",
    "commit_cc",
    "commit_wbs",
    "cost_center_details",
    "wbs_budget",
    "forecast_budget",
    "forecast_live_estimate",
    "forecast_pre_budget",
    "forecast_trend",
]
ROUTES: list[tuple[str, str]] = [
    ("ccdet", "cost_center_details"),
    ("commit_cc", "commit_cc"),
    ("commit_wbs", "commit_wbs"),
    ("wbs_budget", "wbs_budget"),
    ("_le_", "forecast_live_estimate"),
    ("_prebud_", "forecast_pre_budget"),
    ("_bud_", "forecast_budget"),
    ("_t0", "forecast_trend"),
]
DEFAULT_FEED = "actuals"

# ---------------------------------------------------------------------------
# FIXED VALUES: columns each feed family needs (raw names, before renames).
# A feed table that does not exist yet is read as an empty frame of these
# columns, so the gold schema does not depend on which feeds have data.
# ---------------------------------------------------------------------------
LEDGER_FEED_COLUMNS = [
    "Fiscal Year",
    "Period",
    "G/L Account",
    "Amount in Company Code Currency",
    "WBS Element",
    "Cost Center",
    "Partner Cost Center",
    "Product",
    "Profit Center",
]
FEED_COLUMNS: dict[str, list[str]] = {
    "actuals": LEDGER_FEED_COLUMNS,
    "cost_center_details": LEDGER_FEED_COLUMNS,
    "commit_wbs": ["WBS Element", "G/L Account", "Amount in Company Code Currency", "Fiscal Year", "Period"],
    "commit_cc": ["Cost Center", "G/L Account", "Amount in Company Code Currency", "Fiscal Year", "Period"],
}
FORECAST_FEED_COLUMNS = [
    "YEAR",
    "PERIOD",
    "Last Refresh",
    "SPEND TYPE",
    "Value",
    "CODE (L1_CC_Oth)",
    "CODE DESCRIPTION  (L1_CC_Oth)",
    "CODE (L2)",
    "CODE DESCRIPTION (L2)",
    "P&L LINE COMPASS CODE_FS",
    "P&L DESTINATION ACCOUNT",
    "Fiscal Period",
]
for _f in ("forecast_budget", "forecast_live_estimate", "forecast_pre_budget", "forecast_trend"):
    FEED_COLUMNS[_f] = FORECAST_FEED_COLUMNS


def feed_schema(feed: str) -> T.StructType:
    """Schema of an empty feed table: its needed columns, the ingest-added
    ``PartitionDate`` and ``source_file``."""
    fields = [T.StructField(c, LONG if c == "Fiscal Period" else raw_type(c), True) for c in FEED_COLUMNS[feed]]
    fields.append(T.StructField("PartitionDate", TS, True))
    fields.append(T.StructField("source_file", STRING, True))
    return T.StructType(fields)


# FIXED VALUES: forecast scenarios, trend scenario tokens, excluded periods.
FORECAST_SCENARIOS = {
    "forecast_live_estimate": "Live Estimate",
    "forecast_pre_budget": "Pre-Budget",
    "forecast_budget": "Budget",
}
TREND_SCENARIOS: list[tuple[str, str]] = [
    ("T03", "Trend 3"),
    ("T05", "Trend 5"),
    ("T09", "Trend 9"),
]
TOTAL_PERIODS = ["TOTAL", "TOTAL_B", "TOTAL_T"]

# FIXED VALUES: CSV text read as missing (pandas' default missing-value set).
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# FIXED VALUES: date text format of "date" columns, hierarchy separator.
DATE_FORMAT = "M/d/yyyy"
PATH_SEPARATOR = " > "

# Ingest ledger: one row per ingested base name.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("filename", STRING, False),
        T.StructField("ingested_at", TS, True),
        # the attempt whose rows this entry makes visible
        T.StructField("attempt", STRING, True),
    ]
)


def raw_type(name: str) -> T.DataType:
    return RAW_TYPES.get(name, STRING)


# ---------------------------------------------------------------------------
# FIXED VALUES: dimension files, output tables and their non-text columns.
# Any column not listed is text. ``columns`` restricts the read when given.
# ---------------------------------------------------------------------------
DIMENSIONS: dict[str, dict] = {
    "meta_company_divisions": {"file": "company_divisions.csv", "types": {}},
    "meta_fs_items": {"file": "FAGL_011QT.csv", "types": {}},
    "meta_fs_parent_children": {"file": "FAGL_011PC.csv", "types": {"ID": LONG, "ID2": LONG}},
    "meta_gl_accounts": {"file": "SKAT.csv", "types": {"G/L Account": LONG}},
    "meta_gl_to_compass": {"file": "FAGL_011ZC.csv", "types": {"Account To": LONG}},
    "meta_wbs_elements": {
        "file": "wbs_elements.csv",
        "types": {"Level": LONG, "P&L_Destination": LONG},
        "ordered": True,
    },
    "meta_wbs_codification": {"file": "wbs_codification.csv", "types": {}},
    "meta_profit_centers": {"file": "profit_centers.csv", "types": {}},
    "meta_signatures": {
        "file": "signature_codes.csv",
        "types": {},
        "columns": ["Signature Code", "Signature Description"],
    },
    "meta_cost_centers": {"file": "cost_centers.csv", "types": {}},
    "meta_node_to_compass": {"file": "REFSAP06.csv", "types": {}},
    "meta_fiscal_periods": {"file": "fiscal_periods.csv", "types": {"Fiscal Period": LONG}},
    "meta_fiscal_scenarios": {"file": "fiscal_scenarios.csv", "types": {"Fiscal Order": LONG}},
}
HIERARCHY_TABLE = "meta_fs_hierachy"  # spelled as the downstream consumers expect
