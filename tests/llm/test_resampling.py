import random
import zlib

import numpy as np
import pyarrow as pa
from brute import resample
from finlake.llm import resampling as R

SF = "/root/testdata/sf0.001"


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_crc_of_spans_and_of_joined_spans():
    rng = random.Random(4)
    sizes = [rng.randrange(0, 12) for _ in range(200)] + [255, 256, 300, 5000, 70_000]
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in sizes]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    crc = R.Crc()
    single = crc.spans(data, starts, ends)
    assert single.tolist() == [zlib.crc32(p) for p in parts]
    both = crc.joined(single[:-1], single[1:], (ends - starts)[1:])
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_features_stay_in_their_document():
    batch = R.Batch(pa.array(["One, two", None, "", "three", "a\x00b\nc É"]), R.Crc(), 1000, 3)
    assert batch.n_words.tolist() == [2, 0, 0, 1, 4]
    assert batch.n_features.tolist() == [3, 0, 0, 1, 9]
    wanted = ["one", "two", "three", "a", "b", "c", "É", "one two", "a b", "b c", "c É", "a b c", "b c É"]
    assert sorted(batch.bucket.tolist()) == sorted(zlib.crc32(w.encode()) % 1000 for w in wanted)


def test_matches_brute_force_on_driver_tables(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert got(R.resample(docs, bench)) == sorted(want, key=str)
    ranks = sorted(w[4] for w in want if w[4])
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_nulls_long_texts_and_small_slices(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["Alpha", "beta", "x" * 400, "é", "1"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, "long " * 20_000), (None, "word " * 30)]
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, score int, bucket string").repartition(3)
    target = spark.createDataFrame([("beta beta 1",), (None,), ("alpha x",)], "text string")
    want = resample(docs, ["beta beta 1", None, "alpha x"])
    assert got(R.resample(df, target)) == sorted(want, key=str)
    kept = R.drawn_documents(df, target)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[4]}


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(i % 4, "w " * 25) for i in range(16)], "doc_id long, text string")
    bench = spark.createDataFrame([("w",)], "text string")
    rows = R.resample(docs, bench).collect()
    assert len(rows) == 16 and sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3, 4]
    assert len({r["doc_id"] for r in rows if r["rank"]}) == 1  # copies of the best id follow one another
    assert R.resample(docs.limit(0), bench).count() == 0
    assert R.resample(docs, bench.limit(0)).count() == 16
