import random

import brute
import numpy as np
import pytest
from finlake.llm import anchors, chunks, suffix_dedup
from finlake.llm.suffixes import common_prefixes, suffix_array


def plain_order(data):
    return sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 2, 30, 400, 3000])
    data = bytes(rng.randrange(rng.choice([1, 2, 4, 256])) for _ in range(n))
    if seed % 3 == 0:
        data = data[: n // 3] * 3
    got = suffix_array(np.frombuffer(data, np.uint8))
    assert got.tolist() == plain_order(data)


@pytest.mark.parametrize("buckets", [1, 3, 10_000])
def test_either_way_below_the_first_level(buckets, monkeypatch):
    from finlake.llm import suffixes

    monkeypatch.setattr(suffixes, "BUCKETS", buckets)
    rng = random.Random(buckets)
    for symbols in (2, 5, 200):
        data = bytes(rng.randrange(symbols) for _ in range(1500)) * 3
        assert suffix_array(np.frombuffer(data, np.uint8)).tolist() == plain_order(data)


def test_deep_recursion_and_separators():
    rng = random.Random(9)
    unit = bytes(rng.randrange(3) for _ in range(700))
    data = np.frombuffer(unit * 9 + b"\0" + unit[:300], np.uint8)
    breaks = np.zeros(len(data), bool)
    breaks[len(unit) * 9] = True
    t = data.astype(int) + 1
    t[breaks] = 0
    want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    order = suffix_array(data, breaks)
    assert order.tolist() == want
    valid = np.zeros(len(data), bool)
    valid[: len(unit) * 9 - 50] = True
    got = common_prefixes(data, order, valid, 50)
    place = {p: i for i, p in enumerate(want)}
    for p in rng.sample(range(len(data)), 300):
        q = want[place[p] - 1] if place[p] else None
        shared = 0
        if q is not None and valid[p] and valid[q]:
            while shared < 50 and data[p + shared] == data[q + shared]:
                shared += 1
        assert got[p] == shared


def test_runs_are_content_chosen():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 4, 900).astype(np.uint8) for _ in range(2))
    data = np.r_[a, b[:200], a[100:800], b]
    offsets = np.array([0, 900, 900, 900 + 200 + 700, len(data)])
    first, n, anchor = anchors.runs(data, offsets, 100)
    owner = {}
    for f, c, h in zip(first, n, anchor):
        for w in range(f, f + c):
            assert w not in owner
            owner[w] = (h, w - f)
    windows = [w for x, y in zip(offsets, offsets[1:]) for w in range(x, y - 99)]
    assert sorted(owner) == windows
    seen = {}
    for w in windows:
        assert seen.setdefault(data[w : w + 100].tobytes(), owner[w][0]) == owner[w][0]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 5, "c") for i, t in docs], "doc_id long, text string, chunk int, places string")


def corpus(seed, n=50):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    passage = " ".join(word() for _ in range(120))
    docs = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randrange(60)))
        for _ in range(rng.randrange(3)):
            a, b = sorted(rng.randrange(len(passage)) for _ in range(2))
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage[a:b] + text[at:]
        docs.append((rng.randrange(10_000), text))
    docs += [(20_000 + i, docs[0][1] + "é" * 60) for i in range(12)]
    docs += [(30_000, "z" * 700), (30_001, "z" * 99), (30_002, None), (30_003, ""), (30_004, "ab " * 200)]
    return docs + [docs[3], docs[3], (None, docs[5][1]), (None, passage)]


def check(spark, docs):
    rows = suffix_dedup.dedup_digest(frame(spark, docs)).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)
    assert got == sorted(brute.substring_bytes(docs), key=str)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows)


def test_matches_brute_force(spark):
    check(spark, corpus(1))


def test_matches_brute_force_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(chunks, "BUCKET_BYTES", 4000)
    check(spark, corpus(2))


def test_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    check(spark, corpus(3))


def test_no_repeated_rows(spark):
    check(spark, list({d: None for d in corpus(4)}))


def test_rows_that_share_id_and_text_are_one(spark, monkeypatch):
    monkeypatch.setattr(chunks, "SPLIT_ROWS", 4)
    docs = corpus(5, 20)
    check(spark, docs + [(None, "q" + docs[0][1] * 3)] * 60 + [docs[1]] * 30)


def test_empty(spark):
    assert suffix_dedup.dedup_digest(frame(spark, [])).count() == 0
