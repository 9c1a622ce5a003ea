"""Helpers that several operators of this subpackage share.

``ship`` makes executors independent of an installed package: the module's
functions travel inside the pickled closure.  ``text_slices`` and ``words``
turn Arrow text columns into NumPy views in slices of bounded size, so a
task's memory does not follow the record-batch size.
"""

from __future__ import annotations

import secrets
import sys
import uuid
from contextlib import contextmanager, nullcontext

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanlane.session import checkpoint_dir

#: Odd base of the byte polynomial, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
#: Texts of a record batch are handled in slices of about so many bytes.
SLICE_BYTES = 1 << 20


def ship(name: str) -> None:
    """Pickle module ``name`` by value, so workers need no installed copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a written table that one task writes, where their number is known before.
TASK_ROWS = 50_000
#: Bytes of the record batches that Spark hands to Python tasks, about (its own bound counts rows, whatever their size).
BATCH_BYTES = "2m"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """The session setting for what runs inside; then the session's own again."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_batches(spark: SparkSession):
    """Record batches of ``BATCH_BYTES`` for what runs inside, in Spark and in its Python workers."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def no_shuffle_left(spark: SparkSession):
    """Shuffle files of what runs inside are deleted as soon as it ends, not when the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def checkpointed(df: DataFrame, rows: int | None = None, small: bool = False) -> DataFrame:
    """``df`` written as a table to the shared folder and read again: its lineage is cut and its size is known.

    Unlike a checkpoint, which keeps the size that its plan was estimated to
    have; in loops over joins these estimates multiply without bound.
    ``rows``: a bound on the rows, where known; the last stage then has no more
    tasks than they need.  ``small``: Python tasks get record batches of bounded size.
    The shuffles behind the table are deleted once it is written.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // TASK_ROWS)))
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    with no_shuffle_left(df.sparkSession), small_batches(df.sparkSession) if small else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the tables of ``checkpointed`` that the frames read, once all that depends on them is written itself."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 2)[-2] == "tables":
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    return checkpoint_dir(spark)


def lower_ascii(c):
    """A column with A-Z lower-cased and every other character kept."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on unsigned 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; runs of up to a slice are kept."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.empty(max(n, 1), np.uint64)
        got[0] = 1
        done = 1
        while done < n:
            m = min(done, n - done)
            got[done : done + m] = got[:m] * np.uint64(pow(base, done, 1 << 64))
            done += m
        if n <= 2 * SLICE_BYTES + 1:
            _POWERS[base] = got
    return got[:n]


#: Modules under which workers keep tokenizers and memos from task to task begin so.
HELD = "_cleanlane_"


def trim(keep: str = "") -> None:
    """Drop what other operators' tasks have left in this worker (all but module ``keep``), and give freed memory back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    for name in [n for n in sys.modules if n.startswith(HELD) and n != keep]:
        sys.modules.pop(name).__dict__.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trimmer = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trimmer is not None:
        trimmer(0)


def text_slices(column, limit: int = SLICE_BYTES):
    """Slices of an Arrow string or binary array as (first row, bytes, offsets).

    ``offsets`` has one more entry than rows and starts at 0; a null has no
    bytes.  A slice holds at least one row and else at most ``limit`` bytes.
    """
    import pyarrow as pa

    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if n and buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Words of the texts in ``data`` as (start, end, first word of each text, 64-bit hash).

    ``table`` maps a byte to its folded form, 0 where it is no part of a word.
    The result's third part has one more entry than there are texts.
    """
    n = len(data)
    folded = table[data]
    inside = np.zeros(n + 1, bool)
    np.not_equal(folded, 0, out=inside[:n])
    begins = inside[:n].copy()
    begins[1:] &= ~inside[: n - 1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]  # a text's first byte starts a word of its own
    start = np.flatnonzero(begins)
    stops = ~inside[1:]
    stops &= inside[:n]
    stops[edges - 1] = inside[edges - 1]
    end = np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    return start, end, first, span_hashes(folded, start, end)


#: Primes of the hash of a word, and their bases, which the driver draws once and which travel with the functions.
PRIMES = (2**31 - 1, 2**31 - 19)
DRAWN = tuple(secrets.randbelow(p - 3000) + 2000 for p in PRIMES)


def prime_powers(base: int, prime: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo a prime below 2**31; runs of up to a slice are kept."""
    got = _POWERS.get((base, prime))
    if got is None or len(got) < n:
        got = np.ones(max(n, 1), np.uint64)
        done = 1
        while done < n:
            m = min(done, n - done)
            got[done : done + m] = got[:m] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done += m
        if n <= 2 * SLICE_BYTES + 1:
            _POWERS[base, prime] = got
    return got[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, from prefix sums modulo two primes.

    Modulo 2**64 such sums have known collisions whatever the base (words in
    Thue-Morse order); modulo a prime two words of n bytes collide for at most n
    of the bases.
    """
    n = len(data)
    out = (end - start).astype(np.uint64)
    byte = data.astype(np.uint64) + np.uint64(1)
    for base, prime in zip(DRAWN, PRIMES, strict=True):
        p = np.uint64(prime)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte * prime_powers(base, prime, n) % p, out=sums[1:])
        back = prime_powers(pow(base, -1, prime), prime, n + 1)
        out = mix(out) + (sums[end] - sums[start]) % p * back[start] % p
    return mix(out)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive entries (the caller drops those that cross texts)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= np.uint64(BASE)
        out += hashes[i : i + n]
    return mix(out)


def fold_table(separators) -> np.ndarray:
    """Byte table for ``words``: A-Z fold to a-z, the given byte values separate."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[0] = 255  # no UTF-8 byte; 0 stands for separators
    out[np.asarray(sorted(separators), int)] = 0
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``checkpointed`` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        own = f"{shared_folder(spark).rstrip('/')}/tables/"
        jvm = spark.sparkContext._jvm
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            root = jvm.org.apache.hadoop.fs.Path(own)
            if path.getParent().toUri().getPath().rstrip("/") == root.toUri().getPath().rstrip("/"):
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def arrow_table(rows, schema: str):
    """An Arrow table of tuples; ``schema`` names each column and one of the types below."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(",")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])
