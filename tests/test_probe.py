import random

import pandas as pd
import pytest
from finlake.sources import probe
from finlake.sources.probe import csv_facts, cut_records, first_record, state_after
from finlake.sources.records import csv_records

CASES = [
    ('a,b\n1,"x"\n', False, False),
    ('a,b\n1,"x\ny"\n', True, False),
    ('a,b\n1,"x\n2,y\n', True, True),
    ('a,b\n1,5" pipe\n2,a"b\n', False, False),
    ('a,b\n1,"say ""hi"""\n', False, False),
    ('a,b\n1,"x"', False, False),
    ('a,b\n1,"x""', True, True),
    ('"a","b"\n1,2\n', False, False),
    ('a,b\n1,"x"y"z"\n', False, False),
    ('a,b\n1,"x\ry"\n', True, False),
    ('a,b\r\n1,"x"\r\n', False, False),
    ('a,b\n1,"x\r\ny"\n', True, False),
    ('a,b\r1,"x"\r2,y\r', False, False),
    ('"a\nb",c\n1,2\n', True, False),
]


def write(folder, name, data):
    path = f"{folder}/{name}"
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode("latin-1"))
    return path


def test_facts_of_small_files(spark, tmp):
    paths = [write(tmp, f"{i} a+b [x]%.csv", text) for i, (text, _, _) in enumerate(CASES)]
    paths += [write(tmp, "empty.csv", ""), write(tmp, "blank.csv", " \n\r\n \n")]
    facts = csv_facts(spark, paths, "ISO-8859-1")
    for path, (text, newline, unclosed) in zip(paths, CASES):
        assert (facts[path]["quoted_newline"], facts[path]["unclosed"]) == (newline, unclosed), text
        assert not facts[path]["empty"]
    assert [facts[p]["empty"] for p in paths[-2:]] == [True, True]
    assert facts[paths[12]]["line_end"] == "\r" and facts[paths[0]]["line_end"] == "\n"
    assert facts[paths[13]]["header"] == '"a\nb",c'


def test_states_agree_with_pandas_on_random_files(tmp):
    rng = random.Random(3)
    for i in range(200):
        body = "".join(rng.choice(['"', ",", "\n", "x", "y"]) for _ in range(30))
        path = write(tmp, f"{i}.csv", "a,b\n" + body)
        quoted = False
        for line in ("a,b\n" + body).encode().split(b"\n"):
            quoted = state_after(line, quoted)
        assert quoted == cut_records(("a,b\n" + body).encode(), False)[2], body
        try:
            pd.read_csv(path, names=[f"c{j}" for j in range(40)], header=None)
            failed = False
        except pd.errors.ParserError as error:
            failed = "EOF inside string" in str(error)
        assert quoted == failed, body


@pytest.mark.parametrize(
    "data, record",
    [
        (b"a,b\n1", b"a,b"),
        (b"a,b\r\n1", b"a,b"),
        (b"a,b\r1", b"a,b"),
        (b"\n \r\na,b\n1", b"a,b"),
        (b'"a\r\nb",c\n1', b'"a\r\nb",c'),
        (b"a,b", b"a,b"),
        (b'"a,b\n', None),
        (b"", None),
    ],
)
def test_first_record(data, record):
    assert first_record(data, True) == record
    if record and not data.endswith(record):
        assert first_record(data, False) == record


def test_head_longer_than_the_first_read(spark, tmp, monkeypatch):
    monkeypatch.setattr(probe, "HEAD_BYTES", 8)
    path = write(tmp, "long.csv", ",".join(f"column {i}" for i in range(50)) + "\n1\n")
    assert csv_facts(spark, [path], "UTF-8")[path]["header"].endswith("column 49")


@pytest.mark.parametrize("sep", ["\n", "\r\n", "\r"])
def test_records_whatever_the_pieces(spark, tmp, sep):
    """Records put together from pieces of a few bytes, cut anywhere, equal those of the whole text."""
    rng = random.Random(7)
    records = ["id,note"]
    for i in range(300):
        text = "".join(rng.choice(["x", "é", ",", '""', "\r", "\n", "\r\n", "word "]) for _ in range(rng.randrange(25)))
        records.append(f'{i},"{text}"' if rng.random() < 0.6 else f"{i},plain")
    data = sep.join(records) + sep
    path = write(tmp, "a b.csv", data.replace(sep, sep + sep, 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = csv_records(spark, [path], "\r" if sep == "\r" else "\n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(bytes(r["record"]).decode("latin-1") for r in found) == sorted(records[1:])
