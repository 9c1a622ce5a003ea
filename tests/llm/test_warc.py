import base64
import glob
import gzip
import hashlib
import os
import uuid
import zlib

import pytest

from cleanlane.llm import warc
from cleanlane.llm.common import shared_folder


@pytest.fixture
def folder(spark):
    return f"{shared_folder(spark)}/test-{uuid.uuid4().hex}"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_round_trip(frame, spark, folder):
    rows = [(1, "http://a/é?x=1 2", "one"), (2, None, "one"), (3, "u", ""), (4, "u", None), (5, "u\r\nv", "x" * 100000), (6, "u", "one"), (6, "u", "one"), (None, "u", "alone"), (None, "u", "é\x00\r\n\r\n")]
    pages = frame([(*r, "x") for r in rows], "page_id long, url string, html string, Digest string")
    got = sorted(map(tuple, warc.round_trip(pages).collect()), key=str)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        top = max((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        want.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if page == top else "revisit", None if page == top else top))
    assert got == sorted(want, key=str)
    warc.write_archive(pages, folder)
    raw = b"".join(gzip.open(f).read() for f in glob.glob(folder.removeprefix("file:") + "/part-*"))
    assert raw.count(b"WARC/1.1\r\n") == len(rows)
    back = warc.read_archive(spark, folder)
    assert {(r["page"], r["url"]) for r in back.collect()} == {(None if p is None else str(p), u) for p, u, _ in rows}
    assert sorted(bytes(r["payload"]) for r in back.filter("payload is not null").collect()) == sorted([b"one", b"one", b"", b"x" * 100000, b"alone", "é\x00\r\n\r\n".encode()])
    assert warc.round_trip(pages, least=4).filter("record_type = 'revisit'").count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_records_over_many_ranges(spark, folder, small_splits):
    pages = spark.range(300).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(sha2(cast(id as string), 256), cast(id % 40 as int)) as html").coalesce(3)
    warc.write_archive(pages, folder)
    back = warc.read_archive(spark, folder)
    assert back.count() == 300 and back.select("page").distinct().count() == 300


def stored(data):
    """A member whose compressed data holds ``data`` as it is."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def test_chance_magic_goes_back_to_its_record(spark, folder, small_splits):
    os.makedirs(path := folder.removeprefix("file:"))
    body = b"".join(b"a" * n + warc.MAGIC + b"\x00" * 8 + os.urandom(9) for n in range(150))
    whole = [stored(warc.record(str(i), "u", body[i * 50 :], None, False)) for i in range(20)]
    with open(f"{path}/part-0.txt", "wb") as f:
        f.write(b"".join(whole[:10]) + warc.member(b"") + b"".join(whole[10:]))
    back = {int(r["page"]): bytes(r["payload"]) for r in warc.read_archive(spark, folder).collect()}
    assert back == {i: body[i * 50 :] for i in range(20)}


def test_damage_is_not_passed_over(spark, folder):
    os.makedirs(path := folder.removeprefix("file:"))
    with open(f"{path}/part-0.txt", "wb") as f:
        f.write(warc.member(warc.record("1", "u", b"x" * 1000, None, False))[:-20])
    with pytest.raises(Exception, match="record|damaged"):
        warc.read_archive(spark, folder).count()


def test_long_members_end_in_zero():
    for n in (0, 10, (16 << 20) - 1, 16 << 20, (16 << 20) + 5):
        got = warc.member(b"\0" * n)
        assert got[-1] == 0 and len(gzip.decompress(got)) == n
