import gzip
import hashlib
import io

import pytest

from gitloom.llm import warc
from gitloom.session import scratch_path

BIG = "<p>é</p>" * 300
ROWS = [
    (1, "http://a/1", BIG), (9, "http://a/2", BIG), (4, "http://a/3\r\nX: y", BIG),
    (2, "http://b", "small"), (3, "http://b", "small"), (5, None, None), (6, "u", ""),
    (7, "http://c", "WARC/1.1\r\n\r\n\r\n" + "x" * 2000), (8, "http://c", "tail\r\n\r\n" * 400),
    (None, "http://d", "n" * 1500), (None, "http://d", "n" * 1500), (11, "http://e", "m" * 1500),
    (11, "http://f", "m" * 1500), (10, "http://f", "m" * 1500),
]


def _stored(spark, rows):
    path = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    warc.write_archives(pages, path)
    return path


def test_round_trip_and_revisits(spark):
    path = _stored(spark, [(*r, "clash") for r in ROWS])
    found = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    assert len(found) == len(ROWS)
    largest = {}
    for page, _, html in ROWS:
        if page is not None:
            largest[html] = max(page, largest.get(html, page))
    expected = []
    for page, _, html in ROWS:
        body = (html or "").encode()
        revisit = len(body) >= 1000 and page is not None and page != largest[html]
        kind = ("revisit", largest[html]) if revisit else ("response", None)
        expected.append((page, len(body), hashlib.sha1(body).hexdigest(), *kind, body))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    assert sorted(map(repr, expected)) == sorted(
        repr(tuple(bytes(r[c]) if c == "payload" else r[c] for c in names)) for r in found
    )


def test_revisit_records_hold_no_payload_and_reads_are_checked(spark):
    path = _stored(spark, [(*r, "clash") for r in ROWS])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    parsed = [x for f in files for x in warc.parse(gzip.open(io.BytesIO(bytes(f["content"]))))]
    revisits = [(h, b) for h, b in parsed if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 3 and all(b == warc.HTTP_HEAD.encode() for _, b in revisits)
    assert all(h["WARC-Refers-To"].startswith("<urn:uuid:") for h, _ in revisits)
    assert len({h["WARC-Record-ID"] for h, _ in parsed}) == len(parsed) - 2  # pairs of equal page and payload
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort")))


def test_no_pages(spark):
    path = _stored(spark, [])
    assert warc.resolve_revisits(warc.read_archives(spark, path)).count() == 0


def test_pages_that_the_filters_let_through_are_joined_exactly(spark, monkeypatch):
    monkeypatch.setattr(warc, "blocks_for", lambda keys: 1)  # both filters are full
    bodies = {i: f"{i % 150}-" * 600 if i < 300 else f"{i}|" * 600 for i in range(900)}
    rows = [(i, f"http://h/{i}", body, "clash") for i, body in bodies.items()]
    path = _stored(spark, rows)
    found = warc.resolve_revisits(warc.read_archives(spark, path)).collect()
    assert sorted(r["page_id"] for r in found) == sorted(bodies)
    for r in found:
        again = r["page_id"] < 150
        assert (r["record_type"], r["refers_to"]) == (("revisit", r["page_id"] + 150) if again else ("response", None))
        assert bytes(r["payload"]).decode() == bodies[r["page_id"]]


def test_payloads_of_unique_pages_are_not_shuffled(spark):
    rows = [(i, "u", ("same" if i % 3 == 0 else f"{i}") * 900, "clash") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    kept, found, n, n_bytes = warc.deduplicated(pages)
    assert (n, n_bytes) == (300, sum(len(r[2]) for r in rows))
    assert (kept.count(), found.count()) == (201, 99)
    assert "payload" not in found.columns
