from __future__ import annotations

import base64
import hashlib

import pytest

from handbill.llm import warc


@pytest.fixture
def pages(spark):
    rows = [(i, f"https://a.example/{i}", f"<p>{i % 7} é</p>" * (i % 5)) for i in range(60)]
    rows += [(100, None, None), (101, "https://x y\nz", ""), (102, "u", "big" * 200000), (102, "u", "big" * 200000), (None, "n", "nobody"), (None, "n", "<p>1 é</p>")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), rows


def brute(rows, least=0):
    top = {}
    for i, _, h in rows:
        b = (h or "").encode()
        top[b] = max((x for x in (top.get(b), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        own = len(b) < least or top[b] is None or top[b] == i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if own else "revisit", None if own else top[b]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(pages, least):
    df, rows = pages
    path, index = warc.write(df, least=least)
    got = warc.read(path, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, least)


def test_single_records_by_the_seek_table(pages, monkeypatch):
    df, rows = pages
    path, index = warc.write(df)
    html = {i: h or "" for i, _, h in rows}
    for r in index.where("page_id % 9 = 0 or page_id >= 100").collect():
        head, payload = warc.record(f"{path}/{r.bundle}", r.record_id)
        assert head["WARC-Type"] == r.record_type and head["WARC-Identified-Page"] == str(r.page_id)
        assert payload.decode() == (html[r.page_id] if r.record_type == "response" else "")


def test_frames_stand_alone_and_the_same_rows_give_the_same_file():
    import zstandard

    def make():
        b = warc.Bundle()
        for i in range(50):
            b.add(*warc.encode(i, "u", b"x" * 9000, warc.digest(b"x" * 9000), None, False))
        return b.close()

    data = make()
    assert data == make()
    sizes = warc.seek_table(data)
    assert len(sizes) > 3 and sum(c for c, _ in sizes) + 8 + 9 + 8 * len(sizes) == len(data)
    at = sizes[0][0]
    assert zstandard.ZstdDecompressor().decompress(data[at : at + sizes[1][0]]).startswith(b"WARC/1.1")
    assert b"".join(x for x in zstandard.ZstdDecompressor().read_to_iter(data, read_size=1 << 20)).startswith(b"WARC/1.1")


def test_a_broken_payload_is_an_error():
    _, data = warc.encode(1, "u", b"abc", warc.digest(b"abc"), None, False)
    with pytest.raises(ValueError, match="digest"):
        warc.decode(data.replace(b"abc", b"abd"))


def test_empty(pages):
    path, index = warc.write(pages[0].limit(0))
    assert warc.read(path, index).count() == 0


def test_bundles_are_read_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(i, f"https://a.example/{i}", f"page {i} " * 50) for i in range(200)]
    path, index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(16))
    n = index.select("bundle").distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert n > 2 and warc.read(path, index).rdd.getNumPartitions() >= n


def test_addresses_stay_apart():
    lines = [warc.encode(1, url, b"", "X", None, False)[1].split(b"WARC-Target-URI: ")[1].split(b"\r\n")[0] for url in (None, "", "a b", "a\nb", "a%20b?x=1&y=#z", "\u00fc")]
    assert len(set(lines)) == len(lines) and lines[2:] == [b"a%20b", b"a%0Ab", b"a%20b?x=1&y=#z", b"%C3%BC"]
