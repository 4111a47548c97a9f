import datetime as dt
import os
from urllib.parse import quote

import pytest
from finlake.plans.ingest import import_files
from finlake.plans.warehouse import Warehouse
from finlake.sources.gold_sink import read_gold, write_gold
from finlake.sources.ledger import read_ledger
from finlake.sources.store import literal
from pyspark.sql import functions as F

HEADER = "Fiscal Year,Period,G/L Account,Amount in Company Code Currency,WBS Element,Cost Center,Posting Date,Note\n"


def _write(path, text, encoding="ISO-8859-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


def test_csv_quirks_are_read_like_the_extract_tool(spark, tmp):
    src = f"{tmp}/src"
    _write(
        f"{src}/a/ledger_1.csv",
        HEADER
        + '2024,1,100,1.5,W1,C1,1/2/2024,"caf\xe9"\n'  # Latin-1 text
        + '2024,1.0,101,2,NA,,01/02/2024,"line one\nline two"\n'  # 1.0 as integer, NA, quoted newline
        + '2024,2,102,3,NULL,"",,"say ""hi"""\n'  # doubled quote, empty/quoted-empty
        + "2024,2,103,4,None,none,2/3/2024,trailing,\n",  # trailing delimiter
    )
    # Same columns in another order: matched by name, not position.
    _write(
        f"{src}/b/ledger_2.csv",
        "Period,Fiscal Year,Note,G/L Account,Amount in Company Code Currency,WBS Element,Cost Center,Posting Date\n"
        "3,2024,other order,104,5,W2,C2,3/4/2024\n",
    )
    wh = Warehouse(f"{tmp}/wh")
    rep = import_files(spark, wh, [src])
    assert not rep.rejected, rep.rejected
    got = {r["G/L Account"]: r for r in wh.read_feed(spark, "actuals").collect()}
    assert got[100]["Note"] == "caf\xe9"
    assert got[101]["Period"] == 1 and got[101]["WBS Element"] is None and got[101]["Cost Center"] is None
    assert got[101]["Note"] == "line one\nline two"
    assert got[102]["Note"] == 'say "hi"' and got[102]["Cost Center"] is None and got[102]["Posting Date"] is None
    assert got[103]["WBS Element"] is None and got[103]["Cost Center"] == "none"
    assert got[104]["Period"] == 3 and got[104]["Fiscal Year"] == 2024 and got[104]["Note"] == "other order"
    assert got[100]["PartitionDate"] == dt.datetime(2024, 1, 1)
    assert got[101]["Posting Date"] == dt.datetime(2024, 1, 2)
    assert got[100]["source_file"] == "ledger_1.csv"


def test_bad_file_is_quarantined_and_good_ones_load(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/good_1.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,a\n")
    _write(f"{src}/bad_int.csv", HEADER + "2024,1.5,100,1,W,C,1/1/2024,a\n")
    _write(f"{src}/bad_comma.csv", HEADER + '2024,1,"1,234",1,W,C,1/1/2024,a\n')
    _write(f"{src}/bad_month.csv", HEADER + "2024,13,100,1,W,C,1/1/2024,a\n")
    _write(f"{src}/bad_date.csv", HEADER + "2024,1,100,1,W,C,2024-01-01,a\n")
    _write(f"{src}/dup_header.csv", "Period,Period\n1,2\n")
    _write(f"{src}/good_2.csv", HEADER + "2024,2,100,1,W,C,1/1/2024,b\n")
    wh = Warehouse(f"{tmp}/wh")
    rep = import_files(spark, wh, [src])
    assert sorted(rep.ingested["actuals"]) == ["good_1.csv", "good_2.csv"]
    assert sorted(r.path for r in rep.rejected) == [
        "bad_comma.csv",
        "bad_date.csv",
        "bad_int.csv",
        "bad_month.csv",
        "dup_header.csv",
    ]
    assert wh.read_feed(spark, "actuals").count() == 2
    assert spark.read.parquet(wh.quarantine_path).count() == 5


def test_ingest_is_idempotent_and_once_per_name(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/x/same.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,x\n")
    _write(f"{src}/y/same.csv", HEADER + "2024,1,200,1,W,C,1/1/2024,y\n")  # same base name
    _write(f"{src}/commit_cc_1.csv", "Cost Center,G/L Account,Fiscal Year,Period\nC,1,2024,5\n")
    wh = Warehouse(f"{tmp}/wh")
    first = import_files(spark, wh, [src])
    assert first.ingested_count == 2 and len(first.duplicates) == 1
    assert wh.read_feed(spark, "actuals").collect()[0]["Note"] == "x"  # smallest path kept
    assert wh.read_feed(spark, "commit_cc").count() == 1
    second = import_files(spark, wh, [src])
    assert second.ingested_count == 0
    assert wh.read_feed(spark, "actuals").count() == 1
    # A later run seeing the same base name in a new folder skips it too.
    _write(f"{src}/z/same.csv", HEADER + "2024,1,300,1,W,C,1/1/2024,z\n")
    assert import_files(spark, wh, [src]).ingested_count == 0
    assert read_ledger(spark, wh.ledger_path).count() == 2


def test_crash_between_data_and_ledger_reloads_once(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/a.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,x\n2024,1,101,1,W,C,1/1/2024,y\n")
    import_files(spark, Warehouse(f"{tmp}/wh", ledger=f"{tmp}/ledger_before_crash"), [src])
    # The crash: the data is written, the ledger row is not (a ledger that
    # never saw the file, over the same bronze).
    wh = Warehouse(f"{tmp}/wh", ledger=f"{tmp}/ledger_after_crash")
    rep = import_files(spark, wh, [src])
    assert rep.ingested_count == 1
    assert wh.read_feed(spark, "actuals").count() == 2  # partition rewritten, not appended


def test_missing_source_root_is_skipped(spark, tmp):
    wh = Warehouse(f"{tmp}/wh")
    rep = import_files(spark, wh, [f"{tmp}/does-not-exist"])
    assert rep.ingested_count == 0


def test_gold_sink_dynamic_overwrite_and_reread(spark, tmp):
    out = f"{tmp}/gold"
    schema = "Year long, Month long, v string, PartitionDate timestamp_ntz"
    first = spark.createDataFrame(
        [(2024, 1, "a", dt.datetime(2024, 1, 1)), (2024, 2, "b", dt.datetime(2024, 2, 1)), (2024, 0, "z", None)],
        schema,
    )
    write_gold(first, out)
    # A narrower second run replaces only the partition it produces.
    write_gold(spark.createDataFrame([(2024, 2, "b2", dt.datetime(2024, 2, 1)), (2024, None, "n", None)], schema), out)
    g = read_gold(spark, out)
    assert sorted((r["Month"], r["v"]) for r in g.collect()) == [(1, "a"), (2, "b2")]
    assert dict(g.dtypes)["Year"] == "bigint" and dict(g.dtypes)["Month"] == "bigint"
    assert g.columns[-1] == "PartitionDate"


def test_other_column_set_is_quarantined(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/one/first.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,a\n")
    wh = Warehouse(f"{tmp}/wh")
    assert import_files(spark, wh, [f"{src}/one"]).ingested_count == 1
    _write(f"{src}/two/second.csv", "Fiscal Year,Period,Extra\n2024,1,x\n")
    rep = import_files(spark, wh, [f"{src}/two"])
    assert rep.ingested_count == 0 and "columns differ" in rep.rejected[0].reason


def test_headers_equal_but_for_case_are_rejected(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/a.csv", "Period,PERIOD,Fiscal Year\n1,M01,2024\n")
    rep = import_files(spark, Warehouse(f"{tmp}/wh"), [src])
    assert rep.ingested_count == 0 and "case" in rep.rejected[0].reason


def test_gold_sink_scenario_scope(spark, tmp):
    out = f"{tmp}/gold"
    schema = "Scenario string, Year long, Month long, v string"
    write_gold(spark.createDataFrame([("Actuals", 2024, 1, "a"), ("Committed", 2024, 1, "c")], schema), out,
               replace_scope="scenario")
    # A rerun producing only commitments keeps the actuals of the same month.
    write_gold(spark.createDataFrame([("Committed", 2024, 1, "c2")], schema), out, replace_scope="scenario")
    assert sorted((r["Scenario"], r["v"]) for r in read_gold(spark, out).collect()) == [
        ("Actuals", "a"), ("Committed", "c2")
    ]


def test_names_with_spaces_plus_and_percent(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/ledger a+b 100%.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,ok\n")
    _write(f"{src}/bad file.csv", HEADER + "2024,1.5,100,1,W,C,1/1/2024,bad\n")
    wh = Warehouse(f"{tmp}/wh")
    rep = import_files(spark, wh, [src])
    assert rep.ingested["actuals"] == ["ledger a+b 100%.csv"]
    assert [r.path for r in rep.rejected] == ["bad file.csv"]
    bronze = wh.read_feed(spark, "actuals")
    assert [r["source_file"] for r in bronze.collect()] == ["ledger a+b 100%.csv"]
    assert import_files(spark, wh, [src]).ingested_count == 0  # ledger name equals the listed name


def test_line_oriented_read_splits_large_files(spark, tmp):
    """multi_line=False lets Spark split one big file over several tasks;
    every row still lands once, with its header and file name."""
    src = f"{tmp}/src"
    body = "".join(f"2024,{1 + i % 12},{100 + i},{i}.5,W{i},C,1/1/2024,n{i}\n" for i in range(20000))
    _write(f"{src}/big_ledger.csv", HEADER + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        wh = Warehouse(f"{tmp}/wh")
        rep = import_files(spark, wh, [src], multi_line=False)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rep.ingested["actuals"] == ["big_ledger.csv"] and not rep.rejected
    bronze = wh.read_feed(spark, "actuals")
    assert bronze.count() == 20000
    assert bronze.select("G/L Account").distinct().count() == 20000  # header line not read as data
    assert {r["source_file"] for r in bronze.select("source_file").distinct().collect()} == {"big_ledger.csv"}


def test_quoted_carriage_return_loads_whole_rows(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/ledger_1.csv", HEADER + '2024,1,100,1,W,C,1/1/2024,"one\rtwo"\n2024,2,101,2,W,C,1/1/2024,b\n')
    _write(f"{src}/fc_LE_1.csv", 'PERIOD,YEAR,Last Refresh,Note\nM01,2024,x,"one\rtwo"\nM02,2024,x,b\n')
    wh = Warehouse(f"{tmp}/wh")
    assert not import_files(spark, wh, [src]).rejected
    for feed in ("actuals", "forecast_live_estimate"):
        got = wh.read_feed(spark, feed).select(F.month("PartitionDate"), "Note").collect()
        assert sorted(map(tuple, got)) == [(1, "one\rtwo"), (2, "b")], feed


def test_rows_of_another_shape_reject_their_file(spark, tmp):
    src, cols = f"{tmp}/src", "Fiscal Year,Period,Text,Status,Cost Center\n"
    _write(f"{src}/good.csv", cols + "2024,1,t,s,C1\n2024,1,t,s,C2,\n")
    _write(f"{src}/more.csv", cols + "2024,1,t,s,C1\n2024,1,Smith, John,B,11\n")
    _write(f"{src}/fewer.csv", cols + "2024,2,short\n2024,1,t,s,C1\n")
    _write(f"{src}/more_quoted.csv", cols + '2024,1,"a\nb",s,C1\n2024,1,Smith, John,B,12\n')
    wh = Warehouse(f"{tmp}/wh")
    report = import_files(spark, wh, [src])
    reasons = {r.path: r.reason for r in report.rejected}
    assert report.ingested["actuals"] == ["good.csv"]
    assert reasons == {
        "more.csv": "not the 5 fields of the header: 2024,1,Smith, John,B,11",
        "fewer.csv": "not the 5 fields of the header: 2024,2,short",
        "more_quoted.csv": "not the 5 fields of the header: 2024,1,Smith, John,B,12",
    }
    assert sorted(r["Cost Center"] for r in wh.read_feed(spark, "actuals").collect()) == ["C1", "C2"]


def test_any_line_end_and_headers_over_lines(spark, tmp):
    src = f"{tmp}/src"
    _write(f"{src}/ledger_1.csv", "Fiscal Year,Period,Note\r2024,1,a\r2024,2,b\r")
    _write(f"{src}/ledger_2.csv", "\r\nFiscal Year,Period,Note\r\n2024,3,c\r\n")
    _write(f"{src}/ledger_3.csv", 'Fiscal Year,Period,Note\r2024,4,"d\re"\r')
    _write(f"{src}/x_ccdet.csv", 'Fiscal Year,Period,"Item\nText",Cost Center\n2024,5,t,C\n')
    _write(f"{src}/bare.csv", 'Fiscal Year,Period,Note')
    wh = Warehouse(f"{tmp}/wh")
    assert not import_files(spark, wh, [src]).rejected
    notes = {r["Period"]: r["Note"] for r in wh.read_feed(spark, "actuals").collect()}
    assert notes == {1: "a", 2: "b", 3: "c", 4: "d\re"}
    [row] = wh.read_feed(spark, "cost_center_details").collect()
    assert (row["Item\nText"], row["Cost Center"]) == ("t", "C")


def test_large_file_with_one_quoted_break_is_split(spark, tmp):
    from finlake.sources.probe import raw_lines

    src = f"{tmp}/src"
    body = "".join(f'2024,{1 + i % 12},{100 + i},{i}.5,W{i},C,1/1/2024,{"n" if i != 9000 else chr(34) + "two" + chr(10) + "lines" + chr(34)}\n' for i in range(20000))
    _write(f"{src}/big_ledger.csv", HEADER + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        assert raw_lines(spark, [f"{src}/big_ledger.csv"], "\n").rdd.getNumPartitions() > 10
        wh = Warehouse(f"{tmp}/wh")
        assert not import_files(spark, wh, [src]).rejected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    bronze = wh.read_feed(spark, "actuals")
    assert bronze.count() == bronze.select("G/L Account").distinct().count() == 20000
    assert [r["G/L Account"] for r in bronze.filter(F.col("Note").contains("\n")).collect()] == [9100]


def test_names_with_pattern_characters(spark, tmp):
    src = f"{tmp}/src"
    for name in ("ledger [1].csv", "ledger {2,3}.csv", "ledger_star.csv"):
        _write(f"{src}/{name}", HEADER + "2024,1,100,1,W,C,1/1/2024,a\n")
    wh = Warehouse(f"{tmp}/wh")
    assert sorted(import_files(spark, wh, [src]).ingested["actuals"]) == ["ledger [1].csv", "ledger {2,3}.csv", "ledger_star.csv"]
    assert wh.read_feed(spark, "actuals").count() == 3


def test_store_that_only_spark_reads(spark, tmp):
    """A mount table: neither the local file system nor Arrow knows its paths."""
    src, conf = f"{tmp}/src", spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.books.link./in", f"file://{src}")
    _write(f"{src}/ledger_1.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,plain\n")
    _write(f"{src}/ledger_2.csv", HEADER + '2024,2,100,1,W,C,1/1/2024,"two\nlines"\n')
    _write(f"{src}/_LE_3.csv", "PERIOD,YEAR,Last Refresh,Note\nM01,2024,x,hidden\n")
    spark.range(3).selectExpr("2024L `Fiscal Year`", "1L Period", "'p' Note").write.parquet(f"{src}/p/ledger_4.parquet")
    _write(f"{src}/p/broken.parquet", "not a table")
    wh = Warehouse(f"{tmp}/wh")
    assert not import_files(spark, wh, ["viewfs://books/in"]).rejected
    assert sorted(r["Note"] for r in wh.read_feed(spark, "actuals").collect()) == ["plain", "two\nlines"]
    assert wh.read_feed(spark, "forecast_live_estimate").count() == 1
    other = Warehouse(f"{tmp}/parquet")
    report = import_files(spark, other, ["viewfs://books/in/p"], "parquet")
    assert [r.path for r in report.rejected] == ["broken.parquet"] and "unreadable" in report.rejected[0].reason
    assert other.read_feed(spark, "actuals").count() == 3


def test_file_changed_after_a_crash_leaves_no_old_row(spark, tmp, monkeypatch):
    from finlake.plans import ingest

    src, wh = f"{tmp}/src", Warehouse(f"{tmp}/wh")
    _write(f"{src}/a.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,old\n2024,3,100,1,W,C,1/1/2024,old\n")
    real = ingest.record
    monkeypatch.setattr(ingest, "record", lambda *a: (_ for _ in ()).throw(OSError("store is down")))
    with pytest.raises(OSError):
        import_files(spark, wh, [src])
    assert wh.read_feed(spark, "actuals").count() == 0  # written, but nobody sees it
    monkeypatch.setattr(ingest, "record", real)
    _write(f"{src}/a.csv", HEADER + "2024,2,100,1,W,C,1/1/2024,new\n")
    report = import_files(spark, wh, [src])
    assert report.rows == {"actuals": 1}
    assert [r["Note"] for r in wh.read_feed(spark, "actuals").collect()] == ["new"]
    # the attempt without a commit goes, the other one stays
    assert ingest.vacuum(spark, wh, ["actuals", "forecast_trend"], 24) == []
    assert len(ingest.vacuum(spark, wh, ["actuals", "forecast_trend"], 0)) == 1
    assert wh.read_feed(spark, "actuals").count() == 1


def test_two_importers_of_one_file_show_it_once(spark, tmp):
    from finlake.plans import ingest

    src, wh = f"{tmp}/src", Warehouse(f"{tmp}/wh")
    _write(f"{src}/a.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,x\n")
    [(df, group)], _ = ingest.frames_of(spark, [f"{src}/a.csv"], "csv", None, f"{tmp}/work")
    slow = ingest.publish_group(spark, wh, "actuals", df, group, f"{tmp}/work")  # not yet committed
    import_files(spark, wh, [src])
    ingest.record(spark, wh.ledger_path, spark.createDataFrame([("a.csv",)], "file_name string"), slow.attempt)
    assert wh.read_feed(spark, "actuals").count() == 1


def test_many_imports_leave_few_ledger_files(spark, tmp):
    from finlake.sources import ledger

    path = f"{tmp}/ledger"
    for i in range(12):
        names = spark.createDataFrame([(f"f{i}.csv",), (f"g{i}.csv",)], "file_name string")
        ledger.record(spark, path, names, f"{i:032x}")
        ledger.merge_commits(spark, path, max_commits=4)
    assert len(os.listdir(path)) <= 5
    assert sorted(r["filename"] for r in read_ledger(spark, path).collect()) == sorted(f"{c}{i}.csv" for c in "fg" for i in range(12))


def test_staging_is_removed(spark, tmp, monkeypatch):
    from finlake.plans import ingest

    folders, real = [], ingest.scratch_path
    monkeypatch.setattr(ingest, "scratch_path", lambda *a: folders.append(real(*a)) or folders[-1])
    _write(f"{tmp}/src/a.csv", HEADER + '2024,1,100,1,W,C,1/1/2024,"two\nlines"\n')
    import_files(spark, Warehouse(f"{tmp}/wh"), [f"{tmp}/src"])
    assert folders and not any(os.path.exists(f.replace("file:", "")) for f in folders)


def test_good_rows_are_written_once_and_by_compiled_code(spark, tmp, monkeypatch):
    from pyspark.sql import DataFrameWriter

    _write(f"{tmp}/src/ledger_1.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,a\n")
    _write(f"{tmp}/src/x_ccdet_1.csv", HEADER + "2024,1,100,1,W,C,1/1/2024,a\n")
    _write(f"{tmp}/src/x_ccdet_2.csv", HEADER + "2024,13,100,1,W,C,1/1/2024,a\n")
    plain, written = DataFrameWriter.parquet, []

    def parquet(self, path, *args, **kwargs):
        if "bronze" in path or "import" in path:
            written.append((path.split("/attempt=")[0], spark.conf.get("spark.sql.codegen.hugeMethodLimit")))
        plain(self, path, *args, **kwargs)

    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    wh = Warehouse(f"{tmp}/wh")
    report = import_files(spark, wh, [f"{tmp}/src"])
    assert [r.path for r in report.rejected] == ["x_ccdet_2.csv"] and report.rows == {"actuals": 1, "cost_center_details": 1}
    # a second time only where a file is rejected
    feeds = ["actuals", "cost_center_details", "cost_center_details"]
    assert sorted(written) == [(wh.feed_path(f), "8000") for f in feeds]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before
    assert wh.read_feed(spark, "actuals").columns[-2:] == ["source_file", "PartitionDate"]
    assert len(os.listdir(wh.feed_path("cost_center_details"))) == 1


def test_source_names_of_plain_and_encoded_paths(spark, tmp):
    from finlake.sources.csv import source_file_name

    names = {
        "a/ledger_1.csv": "ledger_1.csv",
        "a/b.csv/part-0.csv": "b.csv",
        "a/b c.csv/part-1.csv": "b c.csv",
        "a d/e.parquet/part-2.csv": "e.parquet",
        "a/_f.csv/part-3.csv": "part-3.csv",
        "a/.csv/part-4.csv": "part-4.csv",
        "a/g.txt/part-5.csv": "part-5.csv",
        "a/h.csv/other.csv": "other.csv",
        "a/i+j%.csv": "i+j%.csv",
        "a/visible~_k.csv": "_k.csv",
        "a/\xe9.csv/part-6.csv": "\xe9.csv",
    }
    for path in names:
        _write(f"{tmp}/src/{path}", f"{path}\n", "utf-8")
    found = spark.createDataFrame([(f"file:{tmp}/src/{quote(p, safe='/+~')}", p) for p in names], "u string, value string")
    got = found.select(F.struct(F.col("u").alias("file_path")).alias("_metadata"), "value").select("value", source_file_name().alias("n"))
    assert {r["value"]: r["n"] for r in got.collect()} == names
    seen = [p for p in names if "/_" not in p and "/." not in p]  # Spark hides the others
    rows = spark.read.text([literal(f"{tmp}/src/{p}") for p in seen]).select("value", source_file_name().alias("n"))
    assert {r["value"]: r["n"] for r in rows.collect()} == {p: names[p] for p in seen}
