import brute
from finlake.llm.licenses import NOTICES, license_scan

FIELDS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "s", 1, 2) for i, t in docs], "doc_id long, text string, label string, `row` int, h int")


DOCS = [
    (1, "Released under the MIT License. mit-license; GNU GENERAL public license"),
    (2, "the Licensed under CC BY-NC 4.0."),
    (3, None),
    (4, ""),
    (5, "MIT"),
    (6, "apache apache license license mit Kicense licenſe"),
    (7, "LİCENSE mit lİcense ccé by cc by by cc by"),
    (8, "x " * 5000 + "gnu general public license " * 3),
    (1, "Released under the MIT License. mit-license; GNU GENERAL public license"),
    (None, "apache license"),
]


def test_base_matches_brute_force(spark):
    rows = license_scan(frame(spark, DOCS)).collect()
    got = sorted((tuple(r[c] for c in FIELDS) for r in rows), key=str)
    assert got == sorted(brute.licenses(DOCS), key=str)
    assert all(0.0 <= r.score <= 1.0 for r in rows)


def test_edited_notice_adds_its_label(spark):
    words = NOTICES[3][0].split()
    edited = " ".join(words[:8] + ["all"] + words[8:14] + words[15:])
    [row] = license_scan(frame(spark, [(1, "start " + edited + " end")])).collect()
    assert (row.n_base, row.base_labels, row.labels) == (0, "", "bsd")
    assert 0.6 <= row.score < 1.0
    [span] = row.spans
    assert span.start == 1 and span.label == "bsd"
    [row] = license_scan(frame(spark, [(1, " ".join(words[:4]))])).collect()
    assert row.labels == "" and row.score == 0.0


def test_empty_table(spark):
    assert license_scan(frame(spark, [])).count() == 0
