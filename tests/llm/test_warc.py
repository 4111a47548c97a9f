import base64
import gzip
import hashlib
import os

from finlake.llm import warc


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


PAGES = [
    (1, "http://a/x y\n", "<p>é\r\n\r\nWARC/1.0\r\nContent-Length: 3</p>"),
    (2, "http://a/2", "same"),
    (9, "http://a/9", "same"),
    (5, None, "same"),
    (6, "http://a/6", None),
    (7, "http://a/7", ""),
    (8, "dns:a", "big " * 100_000),
    (11, "http://a/11", "filedesc://x 0 1 2\n1 0 Spark\n"),
    (12, "http://a/12", "twice"),
    (12, "http://a/12", "twice"),
    (None, "http://a/n", "same"),
]


def brute(pages):
    out = []
    for page, _, html in pages:
        html = html or ""
        top = max((p for p, _, h in pages if (h or "") == html and p is not None), default=None)
        first = page == top
        out.append((page, len(html.encode()), b32(html), "response" if first else "revisit", None if first else top))
    return out


FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def frame(spark, pages):
    return spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, problem int")


def test_round_trip(spark):
    rows = warc.archive(frame(spark, PAGES)).collect()
    assert sorted((tuple(r[f] for f in FIELDS) for r in rows), key=str) == sorted(brute(PAGES), key=str)
    assert all(r.problem is None and r.date == "2024-01-01T00:00:00Z" for r in rows)
    ids = {r.record_id: r.page_id for r in rows if r.record_type == "response"}
    for r in rows:
        if r.record_type == "revisit":
            assert ids[r.refers_to_id] == r.refers_to and r.payload is None
    payloads = {r.page_id: bytes(r.payload).decode() for r in rows if r.record_type == "response"}
    for page, _, html in PAGES:
        if page in payloads:
            assert payloads[page] == (html or "")
    assert warc.archive(frame(spark, [])).count() == 0


def test_small_payloads_stay_responses(spark):
    rows = warc.archive(frame(spark, PAGES), min_bytes=1).collect()
    assert {r.record_type for r in rows if r.page_id in (6, 7)} == {"response"}


def test_versions_and_damage(tmp):
    one = warc.arc_version_block(1, "a") + "\n" + warc.arc_record(1, "a", 0, "http://u v", 3, "x") + "\n"
    two = warc.arc_version_block(2, "b") + "\n" + warc.arc_record(2, "b", 9, "http://w", 4, "é") + "\n"
    [a] = map(warc.converted, warc.arc_records(one.encode()))
    [b] = map(warc.converted, warc.arc_records(gzip.compress(two.encode())))
    assert (a["page_id"], a["payload"], a["arc_version"], a["url"]) == (3, b"x", 1, "http://u%20v")
    assert (b["page_id"], b["payload"], b["arc_version"]) == (4, "é".encode(), 2)
    # a raw space in an old URL: fields are taken from the right
    spaced = warc.arc_version_block(1, "a") + "\nhttp://u v w 1.2.3.4 1996 text/plain 2\nhi\n"
    [c] = map(warc.converted, warc.arc_records(spaced.encode()))
    assert (c["url"], c["date"], c["warc_type"], c["payload"]) == ("http://u v w", "1996-01-01T00:00:00Z", "resource", b"hi")
    cut = list(warc.arc_records(one.encode()[:-4]))
    assert "declared" in cut[-1]["problem"]
    bad = list(warc.arc_records((one + "not a header\n").encode()))
    assert len(bad) == 2 and "header line" in bad[1]["problem"]
    torn = list(warc.arc_records(gzip.compress(one.encode())[:-20]))
    assert "problem" in torn[-1]
    assert list(warc.arc_records(b"")) == []


def test_bytes_of_any_encoding_and_damaged_files_are_converted(spark, tmp):
    latin = b"caf\xe9 \x00\xff"
    head = warc.http_head(len(latin), 4)
    record = f"http://l/1 1.2.3.4 1999 text/html {len(head) + len(latin)}\n".encode() + head + latin + b"\n"
    folder = f"{tmp}/arc"
    os.makedirs(folder)
    for name, data in {"a.arc": record, "b.arc.gz": record, "c.arc": record + record[:-5]}.items():
        data = warc.arc_version_block(1, name).encode() + b"\n" + data
        with open(f"{folder}/{name}", "wb") as f:
            f.write(gzip.compress(data) if name.endswith("gz") else data)
    assert {bytes(r.payload) for r in warc.read_arc(spark, folder).filter("problem is null").collect()} == {latin}
    out = warc.convert(spark, folder, f"{tmp}/warc", min_bytes=100)
    rows = warc.read_warc(spark, out).collect()
    assert [(r.page_id, bytes(r.payload), r.problem, r.date) for r in rows] == [(4, latin, None, "1999-01-01T00:00:00Z")] * 3


def test_small_files_each_begin_anew(spark, tmp):
    pages = frame(spark, [(i, f"http://a/{i}", f"page {i // 2}") for i in range(50)]).coalesce(2)
    arc = warc.write_arc(pages, f"{tmp}/arc", records=4)
    found = warc._files(spark, arc).collect()
    assert 13 <= len(found) <= 14  # two tasks, four records a file
    for f in found:
        text = gzip.decompress(bytes(f.content))
        assert text.startswith(b"filedesc://") and text.count(b"filedesc://") == 1
    assert {r.arc_version for r in warc.read_arc(spark, arc).collect()} == {1, 2}
    out = warc.convert(spark, arc, f"{tmp}/warc", records=4)
    for f in warc._files(spark, out).collect():
        assert gzip.decompress(bytes(f.content)).startswith(b"WARC/1.0\r\nWARC-Type: warcinfo")
    rows = warc.read_warc(spark, out).collect()
    assert {r.page_id: r.refers_to for r in rows} == {i: None if i % 2 else i + 1 for i in range(50)}
    assert all(r.payload is None for r in warc.read_warc(spark, out, payloads=False).collect())
