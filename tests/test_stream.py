import os

from finlake.plans.warehouse import Warehouse
from finlake.sources.ledger import read_ledger
from finlake.streaming.ingest_stream import ingest_available, rejected_versions, start_ingest_stream

HEADER = "Fiscal Year,Period,G/L Account,Amount in Company Code Currency,Note\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="ISO-8859-1") as fh:
        fh.write(text)


def test_stream_ingests_only_new_files(spark, tmp):
    src, chk = f"{tmp}/src", f"{tmp}/chk"
    wh = Warehouse(f"{tmp}/wh")
    _write(f"{src}/a/ledger 2024=01.csv", HEADER + "2024,1,100,1.0,a\n2024,1,101,2.0,b\n")
    _write(f"{src}/b/ledger_2.csv", HEADER + "2024,2,100,3.0,c\n")
    first = ingest_available(spark, wh, src, chk)
    assert sum(r.ingested_count for r in first) == 2
    bronze = wh.read_feed(spark, "actuals")
    assert bronze.count() == 3
    assert {r["source_file"] for r in bronze.select("source_file").distinct().collect()} == {
        "ledger 2024=01.csv",
        "ledger_2.csv",
    }
    # New arrivals: a new file, and a copy of an old name in a new folder.
    _write(f"{src}/c/ledger_3.csv", HEADER + "2024,3,100,4.0,d\n")
    _write(f"{src}/c/ledger_2.csv", HEADER + "2024,9,999,9.0,dup\n")
    second = ingest_available(spark, wh, src, chk)
    assert sum(r.ingested_count for r in second) == 1
    assert wh.read_feed(spark, "actuals").count() == 4
    assert read_ledger(spark, wh.ledger_path).count() == 3
    # Nothing new: nothing loads.
    third = ingest_available(spark, wh, src, chk)
    assert sum(r.ingested_count for r in third) == 0


def test_fault_fails_the_batch_and_replays(spark, tmp, monkeypatch):
    import pytest
    from finlake.plans import ingest

    src, chk, wh = f"{tmp}/src", f"{tmp}/chk", Warehouse(f"{tmp}/wh")
    _write(f"{src}/ledger_1.csv", HEADER + "2024,1,100,1.0,a\n")
    real, calls = ingest.record, []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("transient store error")
        return real(*args)

    monkeypatch.setattr(ingest, "record", fails_once)
    with pytest.raises(Exception):
        ingest_available(spark, wh, src, chk)
    assert read_ledger(spark, wh.ledger_path).count() == 0
    assert sum(r.ingested_count for r in ingest_available(spark, wh, src, chk)) == 1
    assert wh.read_feed(spark, "actuals").count() == 1


def test_corrected_and_hidden_files_load(spark, tmp):
    src, chk, wh = f"{tmp}/src", f"{tmp}/chk", Warehouse(f"{tmp}/wh")
    _write(f"{src}/ledger_1.csv", HEADER + '2024,1,100,1.0,"open\n')
    _write(f"{src}/_LE_2.csv", HEADER + "2024,1,100,1.0,hidden\n")
    first = ingest_available(spark, wh, src, chk)
    assert [r.path for rep in first for r in rep.rejected] == ["ledger_1.csv"]
    assert wh.read_feed(spark, "forecast_live_estimate").collect()[0]["source_file"] == "_LE_2.csv"
    _write(f"{src}/ledger_1.csv", HEADER + '2024,1,100,1.0,"closed"\n')
    os.utime(f"{src}/ledger_1.csv", (4e9, 4e9))
    ingest_available(spark, wh, src, chk)
    assert wh.read_feed(spark, "actuals").collect()[0]["Note"] == "closed"


def test_any_batch_size_loads_what_a_batch_import_loads(spark, tmp):
    from finlake.plans.ingest import import_files

    src, good, bad = f"{tmp}/src", HEADER + "2024,1,100,1.0,{}\n", HEADER + "2024,13,100,1.0,{}\n"
    # the larger path is older, so the stream sees it first
    for age, folder in enumerate("ba"):
        for name, text in {"ledger_1": good, "ledger_2": bad, "ledger_3": bad if folder == "a" else good}.items():
            _write(f"{src}/{folder}/{name}.csv", text.format(folder))
            os.utime(f"{src}/{folder}/{name}.csv", (1e9 + age, 1e9 + age))

    def outcome(wh):
        rows = wh.read_feed(spark, "actuals").select("source_file", "Note").collect()
        quarantine = spark.read.parquet(wh.quarantine_path).select("file_name", "reason").collect()
        return sorted(map(tuple, rows)), sorted(map(tuple, quarantine))

    batch = Warehouse(f"{tmp}/batch")
    import_files(spark, batch, [src])
    assert outcome(batch)[0] == [("ledger_1.csv", "a"), ("ledger_3.csv", "b")]
    for size in (1, 4):
        wh = Warehouse(f"{tmp}/wh{size}")
        start_ingest_stream(spark, wh, src, f"{tmp}/chk{size}", max_files_per_trigger=size).awaitTermination()
        assert outcome(wh) == outcome(batch)


def test_hidden_file_alone_loads(spark, tmp):
    src, chk, wh = f"{tmp}/src", f"{tmp}/chk", Warehouse(f"{tmp}/wh")
    _write(f"{src}/ledger_1.csv", HEADER + "2024,1,100,1.0,a\n")
    ingest_available(spark, wh, src, chk)
    _write(f"{src}/_LE_2.csv", HEADER + "2024,1,100,1.0,hidden\n")
    _write(f"{src}/_sub/ledger_3.csv", HEADER + "2024,1,100,1.0,below\n")
    assert sum(r.ingested_count for r in ingest_available(spark, wh, src, chk)) == 2
    assert [r["Note"] for r in wh.read_feed(spark, "forecast_live_estimate").collect()] == ["hidden"]
    assert sorted(r["Note"] for r in wh.read_feed(spark, "actuals").collect()) == ["a", "below"]
    _write(f"{src}/ledger_4.csv", "")
    ingest_available(spark, wh, src, chk)
    assert [r["file_name"] for r in spark.read.parquet(wh.quarantine_path).collect()] == ["ledger_4.csv"]


def test_a_restart_does_not_try_rejected_versions_again(spark, tmp):
    src, chk, wh = f"{tmp}/src", f"{tmp}/chk", Warehouse(f"{tmp}/wh")
    _write(f"{src}/a/ledger_1.csv", HEADER + '2024,1,100,1.0,"open\n')
    ingest_available(spark, wh, src, chk)
    assert rejected_versions(spark, chk).count() == 1
    # a new path brings the name up again: only that path is tried
    _write(f"{src}/b/ledger_1.csv", HEADER + '2024,1,100,1.0,"open too\n')
    again = ingest_available(spark, wh, src, chk)
    assert [r.path for rep in again for r in rep.rejected] == ["ledger_1.csv"]
    assert rejected_versions(spark, chk).select("path").distinct().count() == 2
    assert spark.read.parquet(wh.quarantine_path).count() == 2
    # a corrected version is another one
    _write(f"{src}/a/ledger_1.csv", HEADER + "2024,1,100,1.0,closed\n")
    os.utime(f"{src}/a/ledger_1.csv", (4e9, 4e9))
    ingest_available(spark, wh, src, chk)
    assert [r["Note"] for r in wh.read_feed(spark, "actuals").collect()] == ["closed"]
