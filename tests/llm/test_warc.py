import base64
import hashlib

from closewright.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


PAGES = [
    (5, "http://a/é ?x=1\r\nX: y", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (9, None, "<p>one</p>"), (7, "http://c", ""), (8, "http://d", None),
    (3, "http://e", "WARC/1.1\r\n\r\nlooks like a record\r\n\r\n"), (None, "http://f", "alone"), (None, "http://g", "<p>one</p>"), (4, "http://h", "é" * 100_000), (2, "http://b", "<p>one</p>"),
]


def archive(spark, rows, least=0):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return warc.archived(spark, pages.selectExpr("*", "1 as payload", "2 as first_id"), least).collect()


def test_round_trip(spark):
    got = archive(spark, PAGES)
    assert len(got) == len(PAGES)
    kept = {(r.page_id, r.url): r for r in got}
    for page_id, url, html in PAGES:
        row, html = kept[page_id, url], html or ""
        assert row.payload_bytes == len(html.encode()) and row.payload_digest == digest(html)
        same = [p for p, _, h in PAGES if (h or "") == html and p is not None]
        first = min(same, default=None)
        if first is None or page_id == first:
            assert (row.record_type, row.refers_to, row.payload) == ("response", None, html)
        else:
            assert (row.record_type, row.refers_to, row.payload) == ("revisit", first, None)


def test_small_payloads_are_all_responses(spark):
    assert {r.record_type for r in archive(spark, PAGES[:5], least=1000)} == {"response"}


def test_empty_table(spark):
    assert archive(spark, []) == []


def test_selected_records_only(spark, monkeypatch):
    rows = [(n, f"http://x/{n}", f"<p>{n}</p>" * 50) for n in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = warc.new_path(spark, "warc-test")
    index = warc.write_archives(warc.with_record_type(pages), folder)
    assert index.count() == 200
    for row in index.collect():
        assert row.url == f"http://x/{row.page_id}" and row.payload_digest == digest(f"<p>{row.page_id}</p>" * 50)
    got = warc.read_records(index, folder, index.page_id % 7 == 0).collect()
    assert sorted(r.page_id for r in got) == list(range(0, 200, 7))
    assert all(r.payload == f"<p>{r.page_id}</p>" * 50 for r in got)
    monkeypatch.setattr(warc, "RANGE_BYTES", 300)
    monkeypatch.setattr(warc, "GAP_BYTES", 0)
    assert warc.read_records(index, folder).count() == 200
