import base64
import gzip
import hashlib

import pytest
from journeyline.llm import scratch, warc

SCHEMA = "page_id long, url string, html string, payload string, segment int"


def pages(spark):
    big = "".join(f"<p>é{i}</p>" for i in range(9000))
    rows = [(1, "http://a/ b", "x" * 5000), (2, "http://a", big), (7, None, big), (3, "u", ""), (4, "u", None), (5, "u", "WARC/1.1\r\n\r\nx\r\n0\r\n\r\n"),
            (6, "u", "x" * 5000), (6, "u", "x" * 5000), (2, "http://a", big), (None, "u", "x" * 5000), (None, "u", "alone"), (9, "u", "y" * 2048)]
    return rows, spark.createDataFrame([(*r, "p", 3) for r in rows], SCHEMA).repartition(3)


def test_round_trip(spark, tmp_path):
    rows, df = pages(spark)
    path = f"file://{tmp_path}/warc"
    warc.write_warc(df, path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == len(rows) and all(r.complete for r in got)
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        mine = [r for r in got if r.page_id == page and r.payload_digest == digest]
        assert len(mine) == sum(r[0] == page and (r[2] or "") == (html or "") for r in rows)
        for r in mine:
            origin = first.get(html or "")
            assert r.payload_bytes == len(body)
            assert (r.record_type, r.refers_to) == (("response", None) if page == origin else ("revisit", origin))
            assert r.record_type == "revisit" or bytes(r.payload) == body


def test_no_pages(spark, tmp_path):
    path = f"file://{tmp_path}/warc"
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_warc(spark, path).count() == 0


def test_shorter_payloads_than_the_limit_are_all_responses(spark, tmp_path):
    warc.write_warc(pages(spark)[1], f"file://{tmp_path}/w", revisit_from=6000)
    kinds = {(r.page_id, r.record_type) for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect()}
    assert (6, "response") in kinds and (7, "revisit") in kinds and (4, "response") in kinds


def test_broken_records_are_not_complete(spark, tmp_path):
    whole = b"".join(r + b"\r\n" for r in warc.records(1, "u", b"z" * 40000, None, False))
    first, second, third = (r + b"\r\n" for r in warc.records(2, "u", b"y" * 40000, None, False))
    bad = b"".join(r + b"\r\n" for r in warc.records(3, "u", b"short", None, False)).replace(b"short", b"SHORT")
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(gzip.compress(whole) + gzip.compress(first + third))
    (folder / "b.warc").write_bytes(bad)
    got = {r.page_id: r.complete for r in warc.read_warc(scratch.prepare(spark), f"file://{folder}").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_chunked_framing():
    assert warc.unchunked(warc.chunked(b"")) == b""
    assert warc.unchunked(b"3;name=v\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n") == b"abc0123456789"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


def read(spark, tmp_path, files):
    folder = tmp_path / "damaged"
    folder.mkdir()
    for name, data in files.items():
        (folder / name).write_bytes(data)
    return warc.read_warc(scratch.prepare(spark), f"file://{folder}").collect()


def test_damage_never_fails_the_job(spark, tmp_path):
    def one(page, body=b"body of a page"):
        return b"".join(r + b"\r\n" for r in warc.records(page, "u", body, None, False))
    bare = one(12).replace(b"Content-Length: ", b"X-Length: ", 1)
    assert bare != one(12)
    first, second, third = (r + b"\r\n" for r in warc.records(30, "u", b"y" * 40000, None, False))
    member = gzip.compress(one(41, bytes(range(256)) * 50))
    got = read(spark, tmp_path, {
        "inside-a-header.warc": one(1) + one(2)[:60],
        "inside-a-block.warc": one(3) + one(4)[:-9],
        "no-head.warc": b"nothing of a record\r\n\r\nWARC" + b"\r\n" + one(5),
        "no-length.warc": one(11) + bare + one(13),
        "inside-a-member.warc.gz": gzip.compress(one(21)) + gzip.compress(one(22) + one(23))[:-30],
        "bad-member.warc.gz": gzip.compress(one(40)) + member[:40] + b"\xff" * 40 + member[80:] + gzip.compress(one(42)),
        "no-first-segment.warc": second + third + one(31),
        "empty.warc": b"", "blank.warc": b"\r\n\r\n", "not-utf8.warc": one(50).replace(b"WARC-Target-URI: u", b"WARC-Target-URI: \xff\xfe"),
    })
    state = {r.page_id: r.complete for r in got if r.page_id is not None}
    assert {p for p, c in state.items() if c} >= {1, 3, 5, 11, 13, 21, 40, 42, 31, 50}
    assert not any(state.get(p) for p in (2, 4, 12, 23, 41))
    assert {4, 12} <= set(state)
    assert all(not r.complete for r in got if r.record_type == "damaged") and sum(r.record_type == "damaged" for r in got) >= 3


def test_many_members_are_read_in_linear_time():
    import time
    raw = b"".join(gzip.compress(b"".join(r + b"\r\n" for r in warc.records(k, "u", bytes(str(k), "ascii") * 900, None, False)), 1) for k in range(8000))
    begin = time.process_time()
    assert sum(1 for r in warc.parse(raw) if r[1] == "response" and r[-1]) == 8000
    assert time.process_time() - begin < 5
