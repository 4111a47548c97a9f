import os

from pyspark.sql import functions as F

from finlake.__main__ import parser, run
from finlake.plans import driver_tables as dt
from finlake.plans.dims import custom_wbs_elements, ordered_hierarchy
from finlake.plans.driver_files import lineitem_extract, write_dimensions
from finlake.plans.ingest import import_files
from finlake.plans.jobs import import_job, metadata_job
from finlake.plans.warehouse import Warehouse
from finlake.sources.csv import read_dim_csv
from finlake.schemas import DIMENSIONS
from finlake.session import conf_override

SF = "/root/testdata/sf0.001"


def test_cli_end_to_end(spark, tmp, capsys):
    write_dimensions(spark, SF, f"{tmp}/metadata")
    dt.write_csv(lineitem_extract(spark, SF), f"{tmp}/in/ledger")
    wh = f"{tmp}/wh"
    run(spark, parser().parse_args(["metadata", "--warehouse", wh, "--metadata-path", f"{tmp}/metadata"]))
    run(spark, parser().parse_args(["import", "--warehouse", wh, "--project-path", tmp, "--source-path", "in"]))
    run(
        spark,
        parser().parse_args(
            ["transform", "--warehouse", wh, "--output-path", f"{tmp}/gold",
             "--range-start", "1998/01/01", "--range-end", "1999/01/01"]
        ),
    )
    out = capsys.readouterr().out
    assert "updated dimension table meta_fs_hierachy" in out
    assert "ingested 4 files, rejected 0" in out
    assert "gold dataset:" in out
    gold = spark.table("gold_dataset")
    assert gold.count() == 836
    # Feeds never ingested still give their columns (stable gold schema).
    assert {"Code 1 Concatenated", "Spend Type", "WBS Profit Center Code"} <= set(gold.columns)
    assert set(r["Year"] for r in gold.select("Year").distinct().collect()) == {1998}
    # Parquet copies beside the inputs
    assert os.path.isdir(f"{tmp}/metadata/meta_wbs_elements.parquet")


def test_metadata_job_missing_folder_refreshes_nothing(spark, tmp):
    assert metadata_job(spark, Warehouse(f"{tmp}/wh"), f"{tmp}/nope") == {}


def test_parquet_extracts_keep_their_schema(spark, tmp):
    orders = dt.table(spark, SF, "orders")
    extract = orders.select(
        F.col("o_orderkey").cast("string").alias("Purchasing Document"),
        F.year("o_orderdate").cast("int").alias("Fiscal Year"),  # int in the file, long in the registry
        F.month("o_orderdate").alias("Period"),
        F.col("o_totalprice").alias("Amount in Company Code Currency"),
        F.col("o_orderdate").alias("Posting Date"),  # already a timestamp
    )
    extract.repartition(3).write.parquet(f"{tmp}/in/commit_wbs_2024")
    wh = Warehouse(f"{tmp}/wh")
    rep = import_files(spark, wh, [f"{tmp}/in"], input_format="parquet")
    assert rep.ingested_count == 3 and not rep.rejected
    bronze = wh.read_feed(spark, "actuals")  # part file names carry no feed token
    assert bronze.count() == orders.count()
    types = dict(bronze.dtypes)
    assert types["Fiscal Year"] == "bigint" and types["Period"] == "bigint"
    assert types["PartitionDate"] == "timestamp_ntz"


def test_custom_wbs_elements_and_ordered_dims(spark, tmp):
    write_dimensions(spark, SF, f"{tmp}/metadata")
    spec = DIMENSIONS["meta_wbs_elements"]
    wbs = read_dim_csv(spark, f"{tmp}/metadata/wbs_elements.csv", spec["types"], ordinal="Source Row")
    cod = read_dim_csv(spark, f"{tmp}/metadata/wbs_codification.csv", {})
    custom = custom_wbs_elements(wbs, cod)
    assert "WBS Type Local" in custom.columns and "WBS Parent Code" in custom.columns
    rows = {r["WBS Element Code"]: r for r in custom.collect()}
    part = {r["p_partkey"]: r for r in dt.table(spark, SF, "part").collect()}
    # The parent of each element is the latest level-1 element above it in file order.
    parent = None
    for k in sorted(part):
        p = part[k]
        code = None if k == 0 else p["p_type"][0] + str(k)
        if p["p_size"] % 5 == 1 and code is not None:
            parent = code
        if code is not None:
            assert rows[code]["WBS Parent Code"] == parent
            assert rows[code]["WBS Type Char"] == p["p_type"][0]


def test_ordered_hierarchy_sorts_by_id(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "ID long")
    assert [r["ID"] for r in ordered_hierarchy(df).collect()] == [1, 2, 3]


def test_forecast_input_forms_agree(spark):
    from finlake.plans.gold import assemble_gold

    dims = dt.gold_dims(spark, SF)
    events = dt.table(spark, SF, "events")
    cols = ["event_id", "Scenario", "Amount in Company Code Currency", "Compass Code", "G/L Account", "Month"]

    def rows_of(forecasts):
        g = assemble_gold(dims, forecasts=forecasts, start="2023/01/01", end="2025/01/01")
        return sorted(tuple(r[c] for c in cols) for r in g.select(*[f"`{c}`" for c in cols]).collect())

    four_tables = rows_of(dt.forecast_feeds(events))
    assert four_tables and four_tables == rows_of(dt.forecast_bronze(events))


def test_failed_refresh_keeps_the_old_dimension(spark, tmp):
    import pytest

    wh = Warehouse(f"{tmp}/wh")
    old = spark.range(5)
    assert wh.write_meta(spark, "meta_x", old)[1] == 5
    broken = spark.range(8).select(F.when(F.col("id") == 7, F.raise_error(F.lit("bad"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="bad"):
        wh.write_meta(spark, "meta_x", broken)
    assert wh.read_meta(spark, "meta_x").count() == 5
    for n in (6, 7, 8):
        wh.write_meta(spark, "meta_x", spark.range(n))
    assert wh.read_meta(spark, "meta_x").count() == 8
    assert wh.read_meta(spark, "meta_missing") is None


def test_gold_reread_knows_the_columns_of_all_runs(spark, tmp):
    import pytest
    from finlake.sources.gold_sink import read_gold, write_gold

    out, schema = f"{tmp}/gold", "Scenario string, Year long, Month long"
    write_gold(spark.createDataFrame([("Actuals", 2024, 1, "a")], f"{schema}, v string"), out)
    write_gold(spark.createDataFrame([("Actuals", 2024, 2, 1.5)], f"{schema}, w double"), out)
    gold = read_gold(spark, out)
    assert sorted((r["Month"], r["v"], r["w"]) for r in gold.collect()) == [(1, "a", None), (2, None, 1.5)]
    assert gold.columns == ["v", "w", "Scenario", "Year", "Month"]
    with pytest.raises(ValueError, match="earlier runs wrote"):
        write_gold(spark.createDataFrame([("Actuals", 2024, 3, 7)], f"{schema}, v long"), out)
    assert read_gold(spark, out).count() == 2


def test_extracts_are_cut_by_size(spark, tmp, monkeypatch):
    lines = spark.range(60_000).selectExpr("cast(id as string) a", "cast(hash(id) as string) b")
    with conf_override(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}):
        dt.write_csv(lines.coalesce(1), f"{tmp}/cut", files=None)
    monkeypatch.setattr(dt, "ROWS_PER_PART", 6_000)
    dt.write_csv(lines.coalesce(1), f"{tmp}/dealt")
    for folder in ("cut", "dealt"):
        written = spark.read.option("header", "true").csv(f"{tmp}/{folder}")
        assert len(written.inputFiles()) > 8
        assert written.count() == 60_000 and written.exceptAll(lines).isEmpty()


def test_part_files_of_a_folder_are_one_extract(spark, tmp):
    head = "Purchasing Document,Fiscal Year,Period,Amount in Company Code Currency,Note\n"

    def put(path, text):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)

    for i in range(3):
        put(f"{tmp}/in/ledger_1.csv/part-{i}.csv", head + "".join(f'd{i}{j},2024,{i + 1},1.5,"two\nlines"\n' for j in range(4)))
        bad = "x" if i == 1 else "2024"
        put(f"{tmp}/in/ledger_2.csv/part-{i}.csv", head + f"e{i},{bad},1,1.5,n\n")
        put(f"{tmp}/in/ledger_3.csv/part-{i}.csv", (head if i else head.replace("Note", "Other")) + f"f{i},2024,1,1.5,n\n")
    put(f"{tmp}/in/ledger_4.csv", head + "g,2024,1,1.5,n\n")
    wh = Warehouse(f"{tmp}/wh")
    report = import_job(spark, wh, [f"{tmp}/in"])
    assert dict(report.ingested) == {"actuals": ["ledger_1.csv", "ledger_4.csv"]}
    assert {r.path: r.reason[:18] for r in report.rejected} == {"ledger_2.csv": "column 'Fiscal Yea", "ledger_3.csv": "the part files dif"}
    got = wh.read_feed(spark, "actuals").groupBy("source_file").count().collect()
    assert {r["source_file"]: r["count"] for r in got} == {"ledger_1.csv": 12, "ledger_4.csv": 1}
    again = import_job(spark, wh, [f"{tmp}/in"])
    assert not again.ingested_count
