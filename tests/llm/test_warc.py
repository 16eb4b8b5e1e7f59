import gzip
import hashlib
import json

import pytest
from daycast.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "x" * 1000


def test_round_trip(frame):
    rows = [(1, "http://a/ü b\nc", BIG), (7, None, BIG), (3, "http://b", BIG), (4, "http://c", "<p>\r\n\r\nWARC/1.1"), (5, "http://c", None), (6, "http://d", ""), (8, "u", "x" * 999), (9, "u", "x" * 999), (10, "v", "é" * 700)]
    got = {r["page_id"]: r for r in warc.archive_round_trip(frame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for page, url, html in rows:
        raw = (html or "").encode()
        r = got[page]
        revisit = html == BIG and page != 7
        assert r["payload_digest"] == hashlib.sha1(raw).hexdigest() and r["payload_bytes"] == len(raw)
        assert r["record_type"] == ("revisit" if revisit else "response") and r["refers_to"] == (7 if revisit else None)
        assert r["payload"] is None if revisit else bytes(r["payload"]) == raw
        assert (r["url"] is None) == (url is None)
    assert "\n" not in got[1]["url"]


def test_null_ids_repeats_extra_columns_and_empty_table(frame):
    rows = [(None, "u", BIG, 1), (2, "u", BIG, 2), (2, "u", BIG, 3)]
    got = warc.archive_round_trip(frame(rows, SCHEMA + ", digest long")).collect()
    assert sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in got) == [(-1, "revisit", 2), (2, "response", None), (2, "response", None)]
    assert warc.archive_round_trip(frame([], SCHEMA)).count() == 0


def test_members_and_index(frame, tmp_dir):
    docs = frame([(i, "u", f"page {i} " * 50) for i in range(40)], SCHEMA).coalesce(1)
    whole = warc.write_archives(docs, f"{tmp_dir}/whole", file_bytes=5000)
    assert whole.count() > 2
    files = warc.normalise(whole, f"{tmp_dir}/members").collect()
    seen = 0
    for f in files:
        raw = open(f["path"], "rb").read()
        places = [json.loads(x) for x in open(f["path"] + ".idx")]
        assert sum(n for _, n in places) == len(raw)
        for at, n in places:
            seen += 1
            assert gzip.decompress(raw[at : at + n]).startswith(b"WARC/1.1")
    assert seen == 40


def test_records_of_many_members_and_cut_archives():
    import io

    records = [warc.record_bytes(i, "u", b"abc" * i, hashlib.sha1(b"abc" * i).hexdigest(), None) for i in range(5)]
    joined = b"".join(gzip.compress(r) for r in records)
    assert list(warc._records(io.BytesIO(joined))) == records
    assert list(warc._records(io.BytesIO(gzip.compress(b"".join(records))))) == records
    with pytest.raises(ValueError):
        list(warc._records(io.BytesIO(gzip.compress(records[1][:-2]))))


def test_changed_payload_is_noticed():
    record = warc.record_bytes(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"))
