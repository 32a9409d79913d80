import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from docloom.llm.warc import BadRecord, gzip_member, members, read_archives, read_record, record, round_trip, write_archives


def read_all(data, with_payload=True, chunk=7):
    return [read_record(p, with_payload) for p in members(io.BytesIO(data), chunk)]


def test_members_frame_and_digest():
    payload = b"x\r\n\r\n" * 9000
    data = gzip_member(record(1, "http://a/b?c=d e\r\nX: y", payload)) + gzip_member(record(2, None, payload, 1, True)) + gzip_member(record(None, "u", b""))
    assert gzip.decompress(data).count(b"WARC/1.1") == 3
    for chunk in (1, 7, 1 << 16):
        a, b, c = read_all(data, chunk=chunk)
        assert a["payload"] == payload and a["payload_digest"] == hashlib.sha1(payload).hexdigest() and "\n" not in a["url"]
        assert (b["record_type"], b["refers_to"], b["payload_bytes"], b["payload"]) == ("revisit", 1, len(payload), None)
        assert (c["page_id"], c["payload_bytes"]) == (None, 0)


def test_damage_is_noticed():
    good = record(1, "u", b"hello world")
    for bad in (good.replace(b"hello", b"jello"), good.replace(b"Content-Length: ", b"Content-Length: 1", 1), good[:-4], good + b"!"):
        with pytest.raises(BadRecord):
            read_all(gzip_member(bad))
    with pytest.raises(BadRecord):
        read_all(gzip_member(good)[:-12])


@pytest.fixture(scope="module")
def pages(spark):
    big, small = "é" * 500, "s" * 999
    rows = [(1, "u1", big), (7, "u7", big), (3, None, big), (4, "u", small), (5, "u", small), (6, "u", None), (8, "u", ""), (9, "u", "z" * 300_000), (10, "a", "q" * 1000), (10, "a", "q" * 1000), (2, "a", "q" * 1000)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)


def test_round_trip(spark, pages):
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in round_trip(pages).collect()}
    want = set()
    for r in pages.collect():
        data = (r.html or "").encode()
        target = {1: 7, 3: 7, 2: 10}.get(r.page_id)
        want.add((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if target else "response", target))
    assert got == want and round_trip(pages).count() == 11
    assert round_trip(pages.where(F.lit(False))).count() == 0


def test_archives_roll_over_and_give_payloads(spark, pages, tmp_path):
    manifest = write_archives(pages, str(tmp_path), archive_bytes=300)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == 11
    back = {r.page_id: r.payload for r in read_archives(manifest).collect() if r.record_type == "response"}
    assert back[9] == b"z" * 300_000 and back[6] == b""
