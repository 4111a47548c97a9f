import os
import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from finlake.llm import packing, sharding


def test_group_matches_plain_best_fit():
    rng = random.Random(1)
    for trial in range(30):
        caps = (16, 32, 64)
        sizes = sorted((rng.randrange(1, 65) for _ in range(rng.randrange(80))), reverse=True)
        bins, offsets, final = packing.pack_group(sizes, caps, 4)
        want_final, want_fill = brute.best_fit(sizes, caps, 4)
        fill = Counter()
        for b, s in zip(bins, sizes):
            fill[b] += s
        assert sorted(zip(final, (fill[i] for i in range(len(final))))) == sorted(zip(want_final, want_fill))


def test_pieces_cover_documents_and_bins_do_not_overlap(spark):
    rng = random.Random(2)
    texts = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 300, 2048, 2049, 9000]))) for i in range(60)]
    texts += [(70, None), (71, "a\tb\n"), (71, "a\tb\n"), (None, "x y z")]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, piece int")
    out = packing.pack_documents(packing.word_counts(df), group_tokens=20_000).collect()
    want = Counter()
    for i, t in texts:
        want[i] += len((t or "").split())
    got = Counter()
    bins = defaultdict(list)
    for r in out:
        got[r.doc_id] += r.n_tokens
        assert (r.bin_id is None) == (r.n_tokens == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    assert +got == +want and len({r.doc_id for r in out}) == len(want)
    for rows in bins.values():
        cap = {r.capacity for r in rows}
        assert len(cap) == 1 and cap <= set(packing.CAPACITIES)
        at = 0
        for r in sorted(rows, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_tokens
        cap = cap.pop()
        assert at <= cap and not [c for c in packing.CAPACITIES if at <= c < cap]
    assert packing.pack_documents(packing.word_counts(df.limit(0))).count() == 0


def test_table_is_balanced_and_stable():
    shards = [f"s{i}" for i in range(10)]
    table = sharding.lookup_table(shards, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 10
    fewer = sharding.lookup_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.2 * 1009
    # plain version: walk each whole permutation
    perms = [[(o + j * s) % 1009 for j in range(1009)] for o, s in (sharding.preference(n, 1009) for n in shards)]
    plain, filled = [None] * 1009, 0
    while filled < 1009:
        for i, p in enumerate(perms):
            if filled == 1009:
                break
            slot = next(x for x in p if plain[x] is None)
            plain[slot], filled = i, filled + 1
    assert plain == table
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, 1000)


def test_rows_are_placed(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "c", 7)], "doc_id long, shard string, slot int")
    rows = sharding.shard_rows(df, "doc_id", ["x", "y", "z"], 101).collect()
    assert len(rows) == 3 and rows[0].shard in "xyz"
    table = sharding.lookup_table(["x", "y", "z"], 101)
    assert all("xyz"[table[r.slot]] == r.shard for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 1}) == 1
    assert sharding.shard_rows(df.limit(0), "doc_id", ["x"], 101).count() == 0


def test_written_shards_hold_all_rows(spark, tmp):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("shard", F.lit("mine"))
    docs = docs.unionByName(docs.filter("doc_id <= 1").withColumn("doc_id", F.lit(None).cast("long")))
    shards = [f"shard-{i:03d}" for i in range(8)]
    placed = sharding.shard_rows(docs, "doc_id", shards)
    sharding.write_shards(docs, "doc_id", shards, f"{tmp}/shards")
    back = spark.read.parquet(f"{tmp}/shards").select(*placed.columns)
    assert placed.exceptAll(back).count() == 0 and back.count() == docs.count()
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert set(counts) == set(shards)
    for shard in shards:
        files = spark.read.parquet(f"{tmp}/shards/shard={shard}")
        assert files.count() == counts[shard] and len(files.inputFiles()) == 1
    # without one shard, few of the other shards' rows move
    fewer = sharding.shard_rows(docs, "doc_id", shards[:-1]).select("doc_id", F.col("shard").alias("now"))
    both = placed.filter("doc_id is not null").join(fewer, "doc_id")
    stay = both.filter(F.col("shard") != shards[-1])
    assert stay.filter("shard <> now").count() < 0.2 * stay.count()
    assert both.filter(F.col("now") == shards[-1]).count() == 0
    sharding.write_shards(docs.limit(0), "doc_id", shards, f"{tmp}/none")
    assert not [f for f in os.listdir(f"{tmp}/none") if f.startswith("shard=")]
