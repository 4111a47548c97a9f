import datetime as dt

import pytest

from finlake.functions.columns import (
    concat_codes,
    fiscal_type,
    month_start,
    null_tokens,
    parse_date,
    period_digits,
    route_feed,
    strict_long,
    trend_scenario,
)
from finlake.plans.gold import exclude_totals, in_range
from finlake.plans.ingest import with_partition_date
from tests.conftest import rows


def test_fiscal_type_branches(spark):
    df = spark.createDataFrame(
        [
            (1, "W1", "C1", None, "P", "S"),  # WBS wins
            (2, None, "C1", None, "P", None),  # cost centre
            (3, None, None, "PC", None, None),  # partner cost centre
            (4, None, None, None, "P", None),  # product only
            (5, None, None, None, None, None),  # nothing
            (6, "M1", "C1", None, "P", "M"),  # M: code ignored -> cost centre
            (7, "M2", None, None, "P", "M"),  # M: code ignored -> product
            (8, "M3", None, None, None, "M"),  # M: nothing else -> finance
            (9, "X1", None, None, None, None),  # null type char is not M
        ],
        "i int, wbs string, cc string, pcc string, prod string, t string",
    )
    out = df.select(
        "i",
        fiscal_type("wbs", "cc", "pcc", "prod", type_char="t").alias("m"),
        fiscal_type("wbs", "cc", "pcc", "prod").alias("plain"),
    )
    assert rows(out) == [
        (1, "WBS", "WBS"),
        (2, "COST CENTER", "COST CENTER"),
        (3, "COST CENTER", "COST CENTER"),
        (4, "NO WBS", "NO WBS"),
        (5, "FINANCE", "FINANCE"),
        (6, "COST CENTER", "WBS"),
        (7, "NO WBS", "WBS"),
        (8, "FINANCE", "WBS"),
        (9, "WBS", "WBS"),
    ]


def test_period_digits(spark):
    df = spark.createDataFrame([("M04_T",), ("TOTAL",), (None,), ("M12_B",), ("x7y8",)], "p string")
    assert rows(df.select("p", period_digits("p").alias("m"))) == [
        ("M04_T", 4),
        ("M12_B", 12),
        ("TOTAL", 0),
        ("x7y8", 7),
        (None, 0),
    ]


def test_dates_strict_and_soft(spark):
    df = spark.createDataFrame([("1/2/2024",), ("01/02/2024",), (None,)], "d string")
    strict = rows(df.select(parse_date("d", strict=True).alias("t")))
    assert strict == [(dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 2),), (None,)]
    bad = spark.createDataFrame([("2024-01-02",), ("1/2/2024",)], "d string")
    assert rows(bad.select(parse_date("d", strict=False).alias("t"))) == [(dt.datetime(2024, 1, 2),), (None,)]
    with pytest.raises(Exception):
        bad.select(parse_date("d", strict=True)).collect()


def test_month_start_soft_and_strict(spark):
    df = spark.createDataFrame([(2024, 4), (2024, 13), (2024, 0), (2024, None)], "y long, m long")
    assert rows(df.select(month_start("y", "m", strict=False).alias("t"))) == [
        (dt.datetime(2024, 4, 1),),
        (None,),
        (None,),
        (None,),
    ]


def test_null_tokens_and_strict_long(spark):
    df = spark.createDataFrame(
        [("NA",), ("NULL",), ("None",), ("none",), ("",), ("  ",), ("1.0",), ("1.5",), ("1,234",), ("12",)], "s string"
    )
    out = df.select("s", null_tokens("s").alias("t"), strict_long(null_tokens("s")).alias("n"))
    got = {r["s"]: (r["t"], r["n"]) for r in out.collect()}
    assert got["NA"] == (None, None) and got["NULL"] == (None, None) and got["None"] == (None, None)
    assert got[""] == (None, None)
    assert got["none"] == ("none", None)  # not a missing-value token
    assert got["  "] == ("  ", None)  # blanks are kept in text
    assert got["1.0"][1] == 1 and got["12"][1] == 12
    assert got["1.5"][1] is None and got["1,234"][1] is None


def test_route_feed_first_token_wins(spark):
    names = [
        "A_CCDET_commit_cc.csv",
        "commit_cc_1.csv",
        "x_COMMIT_WBS.csv",
        "wbs_budget.csv",
        "fc_LE_2024.csv",
        "fc_prebud_.csv",
        "fc_bud_.csv",
        "fc_T03.csv",
        "ledger.csv",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict((r["n"], r["f"]) for r in df.select("n", route_feed("n").alias("f")).collect())
    assert got == {
        "A_CCDET_commit_cc.csv": "cost_center_details",
        "commit_cc_1.csv": "commit_cc",
        "x_COMMIT_WBS.csv": "commit_wbs",
        "wbs_budget.csv": "wbs_budget",
        "fc_LE_2024.csv": "forecast_live_estimate",
        "fc_prebud_.csv": "forecast_pre_budget",
        "fc_bud_.csv": "forecast_budget",
        "fc_T03.csv": "forecast_trend",
        "ledger.csv": "actuals",
    }


def test_trend_scenario_is_case_sensitive(spark):
    df = spark.createDataFrame([("x_T03_y",), ("x_t03_y",), ("x_T07_y",), ("a_T09",)], "f string")
    got = dict((r["f"], r["s"]) for r in df.select("f", trend_scenario("f").alias("s")).collect())
    assert got == {"x_T03_y": "Trend 3", "x_t03_y": None, "x_T07_y": None, "a_T09": "Trend 9"}


def test_concat_codes_null_propagates(spark):
    df = spark.createDataFrame([("A", "x"), (None, "x"), ("A", None)], "c string, d string")
    assert rows(df.select(concat_codes("c", "d").alias("v"))) == [("Ax",), (None,), (None,)]


def test_range_is_half_open_and_null_bound_empty(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 2, 1),), (None,)], "PartitionDate timestamp_ntz"
    )
    assert in_range(df, "2024/01/01", "2024/02/01").count() == 1
    assert in_range(df, None, "2024/02/01").count() == 0


def test_exclude_totals_drops_null_period(spark):
    df = spark.createDataFrame([("TOTAL",), ("TOTAL_B",), ("TOTAL_T",), (None,), ("M01_T",)], "PERIOD string")
    assert rows(exclude_totals(df)) == [("M01_T",)]


def test_partition_date_rules(spark):
    # Period and Fiscal Period both present: Period wins.
    a = spark.createDataFrame([(2024, 3, 5)], "`Fiscal Year` long, Period long, `Fiscal Period` long")
    out, bad = with_partition_date(a)
    r = out.select("PartitionDate", bad.alias("bad")).collect()[0]
    assert r["PartitionDate"] == dt.datetime(2024, 3, 1) and r["bad"] is False
    # Month 13 and a null month are flagged (quarantine).
    b = spark.createDataFrame([(2024, 13), (2024, None)], "`Fiscal Year` long, `Fiscal Period` long")
    out, bad = with_partition_date(b)
    assert [x["bad"] for x in out.select(bad.alias("bad")).collect()] == [True, True]
    # Refresh branch: digits of PERIOD; month 0 and no digits -> no date, not bad.
    c = spark.createDataFrame(
        [(2024, "M04_T", "r"), (2024, "TOTAL", "r"), (2024, None, "r")], "YEAR long, PERIOD string, `Last Refresh` string"
    )
    out, bad = with_partition_date(c)
    got = [(x["Fiscal Period"], x["PartitionDate"], x["bad"]) for x in out.select("*", bad.alias("bad")).collect()]
    assert got == [(4, dt.datetime(2024, 4, 1), False), (0, None, False), (0, None, False)]
    # No period column at all: no date column.
    d = spark.createDataFrame([(1,)], "x long")
    out, _ = with_partition_date(d)
    assert "PartitionDate" not in out.columns
