"""Dimension plans: lookup projections of the meta tables and the derived
dimensions the gold rules join against."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.columns import col, first_char
from finlake.operators.filldown import fill_down, with_row_number
from finlake.operators.frames import ordered_columns, rename_columns
from finlake.operators.hierarchy import hierarchy_paths, widen_levels
from finlake.operators.lookup import known_rows, lookup_join, prefetch_key_stats
from finlake.session import scratch_path

ORDINAL = "Source Row"  # file order of ordered dimension files


def _project(df: DataFrame, spec: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[col(src).alias(dst) for src, dst in spec])


# FIXED VALUES: (source column, lookup column) pairs of each lookup projection.
PROJECTIONS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "compass_codes": (
        "meta_fs_items",
        [("Financial Statement Item", "Compass Code"), ("Text", "P&L Line Text")],
    ),
    "cost_centers": (
        "meta_cost_centers",
        [
            ("Cost Center", "Cost Center Code"),
            ("Profit Center", "Profit Center Code"),
            ("Standard Hierarchy Node", "Standard Hierarchy Node"),
        ],
    ),
    "node_to_compass": (
        "meta_node_to_compass",
        [("Group cost center code", "Standard Hierarchy Node"), ("P&L line code", "Compass Code")],
    ),
    "fiscal_periods": (
        "meta_fiscal_periods",
        [("Fiscal Period", "Fiscal Period"), ("Fiscal Period Text", "Fiscal Period Text")],
    ),
    "gl_accounts": (
        "meta_gl_accounts",
        [("G/L Account", "G/L Account"), ("G/L Acct Long Text", "G/L Acct Long Text")],
    ),
    "gl_accounts_to_compass": (
        "meta_gl_to_compass",
        [("Financial Statement Item", "Compass Code"), ("Account To", "G/L Account")],
    ),
    "profit_centers": (
        "meta_profit_centers",
        [
            ("Profit Center", "Profit Center Code"),
            ("Segment", "Division Abbreviation"),
            ("Segment (2)", "Division"),
            ("Standard Hierarchy Node", "Standard Hierarchy Node"),
            ("SAP Signature", "Signature Code"),
        ],
    ),
    "signatures": (
        "meta_signatures",
        [("Signature Code", "Signature Code"), ("Signature Description", "Signature Description")],
    ),
    "wbs_codification": (
        "meta_wbs_codification",
        [("Type Char", "WBS Type Char"), ("Type", "WBS Type"), ("Type Local", "WBS Typ Local")],
    ),
    "wbs_elements": (
        "meta_wbs_elements",
        [
            ("WBS Element", "WBS Element Code"),
            ("WBS Element Name", "WBS Element Name"),
            ("Level", "WBS Level"),
            ("P&L_Destination", "WBS G/L Account"),
            ("Profit Center", "WBS Profit Center Code"),
        ],
    ),
}


def lookup_tables(meta: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The ten lookup projections. ``wbs_elements`` keeps its file order
    column so the fill-down can use it."""
    out = {}
    for name, (table, spec) in PROJECTIONS.items():
        if table not in meta:
            continue
        src = meta[table]
        extra = [(c, c) for c in (ORDINAL, TYPE_SOURCE) if name == "wbs_elements" and c in src.columns]
        out[name] = _project(src, spec + extra)
    return out


TYPE_SOURCE = "WBS Type Source"


def enhance_wbs_elements(
    wbs_elements: DataFrame,
    wbs_codification: DataFrame,
    ordinal: str = ORDINAL,
    keep_ordinal: bool = False,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Parent code/name filled down from the latest level-1 row above (in
    file order), first character of the code as type char, and the
    codification lookup. A ``WBS Type Source`` column, when present, is used
    in place of the code for the type char (and then dropped)."""
    level_one = col("WBS Level") == F.lit(1)
    filled = fill_down(
        wbs_elements,
        ordinal,
        {
            "WBS Parent Code": F.when(level_one, col("WBS Element Code")),
            "WBS Parent Name": F.when(level_one, col("WBS Element Name")),
        },
        bucket_rows=bucket_rows,
        rows=known_rows(wbs_elements),
    )
    source = TYPE_SOURCE if TYPE_SOURCE in filled.columns else "WBS Element Code"
    typed = filled.withColumn("WBS Type Char", first_char(source)).drop(TYPE_SOURCE)
    out = lookup_join(typed, wbs_codification, "WBS Type Char", how="left", validate="many_to_one")
    return out if keep_ordinal else out.drop(ordinal)


def link_profit_center_to_signatures(profit_centers: DataFrame, signatures: DataFrame) -> DataFrame:
    """J5."""
    return lookup_join(profit_centers, signatures, "Signature Code", how="left", validate="many_to_one")


def link_cost_center_to_compass(cost_centers: DataFrame, node_to_compass: DataFrame) -> DataFrame:
    """Cost centres without a mapped node drop out."""
    return lookup_join(
        cost_centers, node_to_compass, "Standard Hierarchy Node", how="inner", validate="many_to_one"
    ).drop("Standard Hierarchy Node")


def link_gl_to_compass(gl_accounts: DataFrame, gl_to_compass: DataFrame) -> DataFrame:
    """J7."""
    return lookup_join(gl_accounts, gl_to_compass, "G/L Account", how="left", validate="one_to_one")


@dataclass
class GoldDims:
    wbs_enhanced: DataFrame
    gl_to_compass: DataFrame
    cost_center_to_compass: DataFrame
    compass_codes: DataFrame
    profit_centers_to_signatures: DataFrame


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "dimension") + "/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_gold_dims(lookups: dict[str, DataFrame]) -> GoldDims:
    """The five lookups of the gold rules. Each is a dimension (bounded by the
    reference data, not by the facts); it is written once to the shared scratch
    folder, so its validation job and every lookup read the same small table,
    and a plan with several lookups against one broadcasts it once. All
    cardinality checks of one stage run as one job."""
    prefetch_key_stats(
        [
            (lookups["wbs_elements"], ["WBS Element Code"]),  # its size feeds the fill-down
            (lookups["wbs_codification"], ["WBS Type Char"]),
            (lookups["gl_accounts"], ["G/L Account"]),
            (lookups["gl_accounts_to_compass"], ["G/L Account"]),
            (lookups["node_to_compass"], ["Standard Hierarchy Node"]),
            (lookups["signatures"], ["Signature Code"]),
        ]
    )
    linked = [
        enhance_wbs_elements(lookups["wbs_elements"], lookups["wbs_codification"]),
        link_gl_to_compass(lookups["gl_accounts"], lookups["gl_accounts_to_compass"]),
        link_cost_center_to_compass(lookups["cost_centers"], lookups["node_to_compass"]),
        lookups["compass_codes"],
        link_profit_center_to_signatures(lookups["profit_centers"], lookups["signatures"]),
    ]
    with ThreadPoolExecutor(len(linked)) as pool:  # the small writes run side by side
        dims = GoldDims(*pool.map(_stored, linked))
    prefetch_key_stats(
        [
            (dims.wbs_enhanced, ["WBS Element Code"]),
            (dims.gl_to_compass, ["G/L Account"]),
            (dims.cost_center_to_compass, ["Cost Center Code"]),
            (dims.compass_codes, ["Compass Code"]),
            (dims.profit_centers_to_signatures, ["Profit Center Code"]),
        ]
    )
    return dims


# ---------------------------------------------------------------------------
# Financial statement hierarchy and chart of accounts
# ---------------------------------------------------------------------------


def fs_hierarchy(fs_items: DataFrame, fs_parent_children: DataFrame, widen: bool = True) -> DataFrame:
    """H1 + H2: items joined to their parent links (1:1), text falling back to
    the item code, path and level by pointer doubling, one column per level.
    Rows come back in ID order only when the caller sorts (O1)."""
    items = fs_items.select(col("Financial Statement Item"), col("Text"))
    levels = fs_parent_children.select(col("ID"), col("Financial Statement Item"), col("ID2"))
    joined = lookup_join(levels, items, "Financial Statement Item", how="inner", validate="one_to_one")
    joined = joined.withColumn("Text", F.coalesce(col("Text"), col("Financial Statement Item")))
    paths = hierarchy_paths(joined, id_col="ID", parent_col="ID2", text_col="Text")
    return widen_levels(paths) if widen else paths


# First columns of the chart of accounts.
CHART_PREFIX = [
    "ID",
    "Financial Statement Item",
    "Text",
    "G/L Account",
    "Short Text",
    "G/L Acct Long Text",
    "Hierarchy",
]


def chart_of_accounts(hierarchy: DataFrame, gl_to_compass_raw: DataFrame, gl_accounts: DataFrame) -> DataFrame:
    """H3: statement items linked to their G/L accounts (inner 1:1), then the
    hierarchy left-joined to that (1:m); fixed column order, then every column
    whose name contains 'Level'."""
    fs_to_gl = rename_columns(gl_to_compass_raw, {"Account To": "G/L Account"})
    fs_and_gl = lookup_join(fs_to_gl, gl_accounts, "G/L Account", how="inner", validate="one_to_one")
    tcoa = lookup_join(hierarchy, fs_and_gl, "Financial Statement Item", how="left", validate="one_to_many")
    return ordered_columns(tcoa, CHART_PREFIX, contains="Level")


# Names of the custom WBS elements.
CUSTOM_WBS_RENAME = {
    "WBS Element": "WBS Element Code",
    "P&L_Destination": "WBS G/L Account",
    "Level": "WBS Level",
    "Profit Center": "WBS Profit Center Code",
}
CUSTOM_CODIFICATION_RENAME = {"Type Char": "WBS Type Char", "Type": "WBS Type", "Type Local": "WBS Type Local"}


def custom_wbs_elements(wbs_elements_raw: DataFrame, wbs_codification_raw: DataFrame, ordinal: str = ORDINAL) -> DataFrame:
    """H4: every column of the WBS file under lookup names, with parents,
    type char and codification (column ``WBS Type Local`` here)."""
    w = rename_columns(wbs_elements_raw, CUSTOM_WBS_RENAME)
    cod = rename_columns(wbs_codification_raw, CUSTOM_CODIFICATION_RENAME)
    return enhance_wbs_elements(w, cod, ordinal=ordinal)


def ordered_hierarchy(h: DataFrame, position: str | None = None) -> DataFrame:
    """O1: hierarchy rows sorted by ID (for output only), or with their number in
    that order as column ``position``, which outlives a write."""
    return with_row_number(h, ["ID"], position) if position else h.orderBy(col("ID"))


__all__ = [
    "GoldDims",
    "build_gold_dims",
    "chart_of_accounts",
    "custom_wbs_elements",
    "enhance_wbs_elements",
    "fs_hierarchy",
    "link_cost_center_to_compass",
    "link_gl_to_compass",
    "link_profit_center_to_signatures",
    "lookup_tables",
    "ordered_columns",
    "ordered_hierarchy",
]
