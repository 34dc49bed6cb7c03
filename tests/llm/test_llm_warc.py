import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from llm_fixtures import prose

from ballotlens.llm import common as C
from ballotlens.llm import warc


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, f"http://x/{i}", f"<p>\r\n\r\n{prose(rng, rng.randint(0, 200))} é</p>") for i in range(80)]
    out += [(100 + i, "http://a b\r\nc", "<hot>") for i in range(50)]
    out += [(200, None, None), (201, "u", ""), (202, "u", None), (3, "again", out[3][2]), (3, "http://x/3", out[3][2]),
            (None, "n", "<none>"), (None, "n", "<hot>"), (203, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (204, "u", "x" * 3_000_000)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, sha string, first string")


def expected(rows, least):
    first, out = {}, []
    for i, _, h in rows:
        if i is not None:
            p = (h or "").encode()
            first[p] = min(i, first.get(p, i))
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = len(p) >= least and p in first and i != first[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                    first[p] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, rows, least):
    path, index = warc.archive_pages(table(spark, rows), least)
    got = index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, least)
    pages = {}
    for r in warc.read_records(spark, path, index).collect():
        pages.setdefault((r.page_id, r.payload_digest), []).append(r.html)
        assert (r.html is None) == (r.record_type == "revisit")
    for i, _, h in rows:
        key = (i, base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode())
        assert set(pages[key]) <= {h or "", None}
    # the files are plain gzip, hold a member per record and one empty end marker (all are small), every indexed member opens alone
    by_file = {}
    for r in index.collect():
        by_file.setdefault(r.archive.removeprefix("file:").replace("///", "/"), []).append(r)
    for name, found in by_file.items():
        data = open(name, "rb").read()
        whole = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
        assert whole.count(b"WARC-Record-ID: ") == len(found)
        members = b"".join(zlib.decompress(data[r.offset:r.offset + r.length], 31)
                           for r in sorted(found, key=lambda r: r.offset))
        every, stream = 0, data
        while stream:
            one = zlib.decompressobj(31)
            one.decompress(stream)
            every, stream = every + 1, one.unused_data
        assert every == len(found) + 1
        assert members == whole and all(data[r.offset:r.offset + 2] == b"\x1f\x8b" for r in found)


def test_normaliser_takes_any_members(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    data = gzip.compress(record * 3 + record[:20]) + gzip.compress(b"") + gzip.compress(record[20:])
    assert list(warc.inflate_records(data)) == [record] * 4
    with pytest.raises(ValueError):
        list(warc.inflate_records(gzip.compress(record[:-9])))
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "part-0.warc.gz").write_bytes(data)
    warc.normalise(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out")
    out = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert [r for _, _, r in warc.walk_members(out)] == [record] * 4


def test_empty_table(spark):
    path, index = warc.archive_pages(table(spark, []))
    assert index.count() == 0 and warc.read_records(spark, path, index).count() == 0


def test_base32_and_paths(spark):
    df = spark.createDataFrame([("a",), ("",), ("é" * 50,)], "t string")
    from pyspark.sql import functions as F
    for t, b in df.select("t", warc.base32_of_hex(F.sha1("t"))).collect():
        assert b == base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert C.fresh_path(spark, "x") != C.fresh_path(spark, "x")
