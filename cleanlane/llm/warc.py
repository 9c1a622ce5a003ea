"""WARC archives: a writer of one gzip member a record, and a splittable reader.

Writer.  Records with equal payloads of at least ``least`` bytes are one
response (the largest page id) and revisits that refer to it.  Tasks compress
each record to a gzip member.  Members are written through Spark's own text
writer, hence to any store that Spark writes to and with its commit protocol:
a member's last byte is 0, the high byte of its length (longer records get an
empty member behind them), and 0 is the writer's line separator.  The files
are plain concatenated gzip members; their names end in .txt.

Reader.  Spark's text reader splits files into byte ranges; with the gzip
magic as line separator, the task of a range scans it for candidates and owns
those that start inside, wherever they end.  A candidate counts as a member if
its header and the beginning of its contents decode to a WARC record.  What
does not is a chance magic within compressed data and is given back to the
member before it, across ranges in a second step over such fragments only.
Archives must not have names that end in .gz: Hadoop would unpack them as a
whole.

Defined results.  A null payload is an empty one; a null URL is left out; a
null page id is smaller than any other and reads back as null.  If several
rows have the largest id of their payload, each of them is a response.  An
empty table makes an archive without records.  Other columns are ignored.
A truncated or damaged record raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, shared_folder, ship

ship(__name__)

MAGIC = b"\x1f\x8b\x08"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """A whole WARC record."""
    block = HTTP if revisit else HTTP + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{page or ''}>"),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~"))] if url is not None else []),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        *([("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to or ''}>")] if revisit else []),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member, with an empty one behind it where needed to end in a 0 byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += packer.compress(b"") + packer.flush()
    return out


def _members(batches):
    import pyarrow as pa

    for batch in batches:
        got = [member(record(*row))[:-1] for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], names=["member"])


def with_types(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """page, url, payload, refers_to and revisit of every row."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page).alias("page"), F.col(url).alias("url"), payload.alias("payload")).withColumn("sha1", F.when(F.octet_length("payload") >= least, F.sha1("payload")))
    shared = checkpointed(rows.filter("sha1 is not null").groupBy("sha1").agg(F.max("page").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    rows = rows.join(shared, "sha1", "left")
    revisit = F.col("top").isNotNull() & ~F.col("page").eqNullSafe(F.col("top"))
    return rows.select(F.col("page").cast("string"), "url", "payload", F.when(revisit, F.col("top")).cast("string").alias("refers_to"), revisit.alias("revisit"))


def write_archive(pages: DataFrame, path: str, **how) -> None:
    """Write a record for every row to files in ``path``."""
    rows = with_types(pages, **how)
    rows.mapInArrow(_members, "member binary").select(F.col("member").cast("string")).write.option("lineSep", "\0").text(path)


def begins_record(raw: bytes) -> bool | None:
    """Does a gzip member at the beginning of ``raw`` hold a WARC record? None: it is a whole empty member."""
    if len(raw) < 18 or raw[3] & 0xE0:
        return False
    try:
        d = zlib.decompressobj(31)
        start = d.decompress(raw, len(VERSION))
        return None if d.eof and not start else start.startswith(b"WARC/")
    except zlib.error:
        return False


def parse(raw: bytes, payload: bool) -> tuple | None:
    """A member's record as (page, url, type, payload bytes, digest, refers to, payload); None while it is not whole."""
    d = zlib.decompressobj(31)
    try:
        data = d.decompress(raw)
    except zlib.error as e:
        raise ValueError(f"damaged record: {e}") from e
    if not d.eof:
        return None
    head, _, rest = data.partition(b"\r\n\r\n")
    names = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(names["Content-Length"])]
    body = block.partition(b"\r\n\r\n")[2] if names["WARC-Type"] == "response" else None
    digest = names["WARC-Payload-Digest"].removeprefix("sha1:")
    if body is not None and (len(body) != int(names["X-Payload-Length"]) or base64.b32encode(hashlib.sha1(body).digest()).decode() != digest):
        raise ValueError(f"{names['WARC-Record-ID']}: the payload doesn't match its digest")
    number = lambda x: x.removeprefix("<urn:page:").removesuffix(">") or None
    url = names.get("WARC-Target-URI")
    return number(names["WARC-Record-ID"]), None if url is None else unquote(url), names["WARC-Type"], int(names["X-Payload-Length"]), digest, number(names["WARC-Refers-To"]) if "WARC-Refers-To" in names else None, body if payload else None


#: A record's columns, and those of a fragment for the second step.
RECORD = "page string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
FRAGMENT = "file string, start long, nr long, fragment binary"


def _batch(records: list[tuple], fragments: list[tuple]):
    import pyarrow as pa

    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    rows = [(*r, *[None] * 4) for r in records] + [(*[None] * 7, *f) for f in fragments]
    names = [x.split()[0] for x in f"{RECORD}, {FRAGMENT}".split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _ranges(payload: bool):
    """Records of byte ranges; fragments: what stands before a range's first member, and a last member that is not whole."""

    def run(batches):
        at, opened, nr = None, None, 0

        def close(records, fragments):
            nonlocal opened
            if opened is not None:
                got = parse(opened, payload)
                records.append(got) if got else fragments.append((*at, -1, opened))
                opened = None

        for batch in batches:
            records, fragments = [], []
            for raw, file, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if at != (file, start):
                    close(records, fragments)
                    at, nr = (file, start), 0
                    if start == 0:  # what stands before the file's first magic
                        if raw:
                            raise ValueError(f"{file} doesn't begin with a gzip member")
                        continue
                candidate = MAGIC + raw
                found = begins_record(candidate)
                if found is False:
                    if opened is not None:
                        opened += candidate
                    else:
                        fragments.append((*at, nr, candidate))
                        nr += 1
                    continue
                if opened is not None:
                    got = parse(opened, payload)
                    if got is None:
                        raise ValueError(f"{file}: a record is cut off")
                    records.append(got)
                opened = candidate if found else None
            yield _batch(records, fragments)
        records, fragments = [], []
        close(records, fragments)
        yield _batch(records, fragments)

    return run


def _repair(payload: bool):
    """Records of a file's fragments: a range's last member goes on with what stands first in the ranges behind."""

    def run(pdf):
        import pandas as pd

        out, opened = [], None
        pdf["nr"] = pdf["nr"].where(pdf["nr"] >= 0, 1 << 60)
        for raw, nr in pdf.sort_values(["start", "nr"])[["fragment", "nr"]].itertuples(index=False):
            if nr == 1 << 60:
                if opened is not None:
                    raise ValueError("a record is cut off")
                opened = bytes(raw)
            elif opened is None:
                raise ValueError("bytes outside of any record")
            else:
                opened += bytes(raw)
            got = parse(opened, payload)
            if got:
                out.append(got)
                opened = None
        if opened is not None:
            raise ValueError("a record is cut off")
        return pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])

    return run


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records below ``path``, with their payload or null."""
    lines = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    pieces = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = checkpointed(pieces.mapInArrow(_ranges(payload), f"{RECORD}, {FRAGMENT}"))
    names = [x.split()[0] for x in RECORD.split(", ")]
    whole = found.filter("fragment is null").select(*names)
    split = found.filter("fragment is not null").select("file", "start", "nr", "fragment")
    return whole.unionByName(split.groupBy("file").applyInPandas(_repair(payload), RECORD))


def round_trip(pages: DataFrame, page: str = "page_id", least: int = 0, **how) -> DataFrame:
    """page, payload_bytes, payload_digest, record_type and refers_to of every page, read back from archives."""
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, page=page, least=least, **how)
    kind = pages.schema[page].dataType
    back = read_archive(spark, path, payload=False)
    return back.select(F.col("page").cast(kind).alias(page), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
