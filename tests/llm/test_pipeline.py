from collections import Counter

import brute
import corpus_pipeline as P
from finlake.llm import toxicity
from finlake.llm.storage import materialize

SF = "/root/testdata/sf0.001"


def plain(rows):
    return [(r.doc_id, r.text) for r in rows]


def test_stages_against_plain_versions(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "substrings", "decontaminate", "pack"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    predicted = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    before, frame = docs.collect(), docs
    for name, stage in P.STAGES[:-1]:
        frame = materialize(stage(spark, frame, SF), f"test-{name}")
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes
        after = frame.collect()
        ids = [r.doc_id for r in after]
        if name == "toxicity":
            want = [r.doc_id for r in before if not predicted[r.doc_id]]
        elif name == "simhash":
            want = [c for d, _, c in brute.simhash(plain(before)) if c == d]
        elif name == "substrings":
            want = [r.doc_id for r in before]
            removed = {d: (n, m, s) for d, n, m, s in brute.substring_words(plain(before))}
            for r in after:
                n, m, sha = removed[r.doc_id]
                assert brute.sha(" ".join(brute.SPACED.findall(r.text or ""))) == sha
                assert r.n_chars == len(r.text)
        else:
            want = [d for d, *_, bad in brute.decontaminate(plain(before), items) if not bad]
        assert sorted(ids) == sorted(want)
        if name != "substrings":  # kept rows are untouched
            old = {r.doc_id: r for r in before}
            assert all(old[r.doc_id] == r for r in after)
        before = after
    words = Counter()
    for r in P.pack(spark, frame, SF).collect():
        words[r.doc_id] += r.n_tokens
    assert words == Counter({r.doc_id: len(brute.SPACED.findall(r.text or "")) for r in before})


def test_run(spark):
    out = P.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "bin_id", "capacity"} <= set(out.columns)


def test_odd_rows_pass_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", 0), (3, "x " * 60_000, "en", "s", 120_000)] * 2,
        docs.schema,
    )
    for frame in (odd, odd.limit(0)):
        for _, stage in P.STAGES:
            frame = materialize(stage(spark, frame, SF), "test-odd")
        frame.count()


def test_other_columns_pass_untouched(spark):
    """Columns that are named like the operators' own, or with a dot, through every filtering stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["__h", "__n", "__id", "__hash", "chunk", "a.b", "row", "rest", "no_id", "number", "root", "fp"]
    from pyspark.sql import functions as F

    wide = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    plain_frame, wide_frame = docs, materialize(wide.unionByName(wide), "test-wide")
    plain_frame = docs.unionByName(docs)
    for name, stage in P.STAGES[:-1]:
        plain_frame = materialize(stage(spark, plain_frame, SF), f"test-plain-{name}")
        wide_frame = materialize(stage(spark, wide_frame, SF), f"test-wide-{name}")
        assert wide_frame.columns == wide.columns and wide_frame.dtypes == wide.dtypes
        rows = wide_frame.collect()
        assert all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in names)
        assert sorted((r["doc_id"], r["text"] or "") for r in rows) == sorted((r["doc_id"], r["text"] or "") for r in plain_frame.collect())
