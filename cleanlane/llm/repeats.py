"""Removal of repeated byte strings with suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else, in the same document or in another one.

1. Minimisers.  Each start's string has an anchor: the place with the smallest
   hash of ``GRAM`` bytes among the string's first ``SPAN`` places.  Starts with
   the same anchor form a run, some SPAN / 2 starts.  Equal strings have equal
   anchors at equal distances, and share the bytes that any string with this
   anchor must hold, its core.  So runs meet by a hash of the core.
2. Runs whose core is nowhere else have no repeats.  Where all runs of a core
   are equal strings (by a second, keyed hash), all their starts are repeats.
3. Else the different strings of a core are sorted from the anchor on: their
   bytes become symbols of ``PACK`` bytes, one suffix array (``suffixes``) sorts
   those of many cores at once, and the lengths of common prefixes of neighbours
   say how far they agree to the right.  Going left byte by byte refines
   classes of equal left sides; strings of one class and one stretch of agreeing
   neighbours are equal, and their numbers are added up.
4. A core with more than ``MOST`` different strings (a passage that ever new
   texts surround) doesn't go into one task: its runs are cut into runs of
   fewer starts, whose cores are longer, down to single starts, whose core is
   the whole string.

Texts are told apart by the first half of their SHA-256.  Only the starts that
are repeats travel back to the texts.  Memory: a text is scanned in windows of
``WINDOW`` bytes, and a task sorts about ``BLOCK`` bytes of strings.

Defined results.  Null and empty texts have no bytes; texts under LENGTH bytes
lose none.  Repeated rows are other documents: their strings start there too.
Strings overlap freely, also with themselves.  All are judged on the input.
An empty table gives no rows.  Other columns are ignored in ``removal_digests`` and
kept in ``without_repeats``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BASE_INV, checkpointed, discard, mix, powers, ship, text_slices
from .suffixes import suffix_array

ship(__name__)

#: Bytes of a repeated string; places that may be its anchor; bytes of which the anchor has the smallest hash.
LENGTH, SPAN, GRAM = 400, 256, 24
#: Starts of a run in the rounds after the first, for cores with more than MOST different strings; strings of one start are one string.
ROUNDS, MOST = (SPAN, 16, 1), 2000
#: Bytes of a symbol; bytes of strings that a task sorts; bytes of a text scanned at once.
PACK, BLOCK, WINDOW = 32, 12 << 20, 2 << 20
#: Values of the hash by which texts are left out before later rounds: a bound on the rows that are broadcast for it.
BUCKETS = 1 << 20
_RUNS = "text binary, m int, low int, high int, core long, whole long"


def run_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run of the texts in ``data``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * powers(BASE_INV, n - GRAM + 1))
    low = np.uint64((1 << 24) - 1)  # places of a window fit into 24 bits
    places = -(-len(grams) // SPAN) * SPAN
    keyed = np.full(places, 2**64 - 1, np.uint64)
    keyed[: len(grams)] = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    table = keyed.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - LENGTH + 1
    least = np.minimum(behind[:starts], ahead[SPAN - 1 : SPAN - 1 + starts])
    anchor = (least & low).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:starts]  # of each start's text
    inside = np.arange(starts) + LENGTH <= ends
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new)
    last = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True))
    return anchor[first], first, last


def _digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _described(raw: bytes, anchors: list[int], lows: list[int], highs: list[int], span: int) -> tuple[list[int], list[int]]:
    """Hashes of the core and of the whole string of each run, whose starts lie ``low`` to ``high`` bytes before its anchor."""
    keep = LENGTH - span + 1
    cores = [_digest(raw[m : m + keep]) for m in anchors]
    return cores, [_digest(b"%d " % h + raw[m - h : m - w + LENGTH]) for m, w, h in zip(anchors, lows, highs, strict=True)]


def _scan(batches):
    """Rows _RUNS of all texts (columns: the text's hash, its bytes)."""
    import pyarrow as pa

    for batch in batches:
        for at, data, offsets in text_slices(batch.column(1), WINDOW):
            # a longer text stands alone; its windows overlap, so that each start is in one of them
            edges = range(0, max(1, len(data) - LENGTH + 1), WINDOW) if len(offsets) == 2 else [0]
            for edge in edges:
                part = data[edge : edge + WINDOW + LENGTH - 1] if len(offsets) == 2 else data
                bounds = np.array([0, len(part)]) if len(offsets) == 2 else offsets
                anchor, first, last = run_starts(part, bounds)
                if not len(anchor):
                    continue
                text = np.searchsorted(bounds, first, side="right") - 1
                low, high = anchor - last, anchor - first
                cores, wholes = _described(part.tobytes(), anchor.tolist(), low.tolist(), high.tolist(), SPAN)
                own = batch.column(0).take(pa.array(at + text))
                m = anchor - bounds[text] + edge
                yield pa.RecordBatch.from_arrays([own, *[pa.array(x, pa.int32()) for x in (m, low, high)], pa.array(cores, pa.int64()), pa.array(wholes, pa.int64())], names=["text", "m", "low", "high", "core", "whole"])


def _narrowed(span: int):
    """Rows _RUNS of texts with a list of runs, cut into runs of at most ``span`` starts (columns: the text's hash, its bytes, runs)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                text, raw, runs = (batch.column(k)[i] for k in range(3))
                raw, out = raw.as_buffer().to_pybytes(), []
                for r in runs.as_py():
                    for base in range(r["low"] // span * span, r["high"] + 1, span):
                        out.append((r["m"] - base, max(r["low"] - base, 0), min(r["high"] - base, span - 1)))
                m, low, high = map(list, zip(*out, strict=True))
                cores, wholes = _described(raw, m, low, high, span)
                yield pa.RecordBatch.from_arrays([pa.array([text.as_py()] * len(m), pa.binary()), *[pa.array(x, pa.int32()) for x in (m, low, high)], pa.array(cores, pa.int64()), pa.array(wholes, pa.int64())], names=["text", "m", "low", "high", "core", "whole"])

    return run


def _strings(batches):
    """The strings of runs (columns: the text's bytes, runs)."""
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            raw, runs = batch.column(0)[i].as_buffer().to_pybytes(), batch.column(1)[i].as_py()
            columns = [[r[k] for r in runs] for k in ("core", "whole", "n", "low", "high")]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array([raw[r["m"] - r["high"] : r["m"] - r["low"] + LENGTH] for r in runs], pa.binary())], names=["core", "whole", "n", "low", "high", "string"])


def _ranks(table: np.ndarray) -> np.ndarray:
    """The rank of each row of unsigned numbers among the different rows, from 0."""
    out = np.unique(table[:, 0], return_inverse=True)[1]
    for k in range(1, table.shape[1]):
        own = np.unique(table[:, k], return_inverse=True)[1]
        out = np.unique(out * (own.max(initial=0) + 1) + own, return_inverse=True)[1]
    return out


def right_order(right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows of bytes, by a suffix array over their symbols, and the common prefix of each with the one before."""
    n, width = right.shape
    symbols = _ranks(right.reshape(n * width // PACK, PACK).view(">u8").astype(np.uint64)).reshape(n, width // PACK) + 2
    text = np.concatenate([symbols, np.ones((n, 1), symbols.dtype)], axis=1).ravel().tolist()
    places = np.array(suffix_array([*text, 0]))
    step = width // PACK + 1
    order = places[(places % step == 0) & (places < n * step)] // step
    common = np.zeros(n, np.int64)
    for a in range(1, n, 4096):  # bounded stretches of the comparison
        own = right[order[a - 1 : a + 4096]]
        differ = own[1:] != own[:-1]
        common[a : a + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def repeated_starts(core: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """For each string and each distance from its anchor, whether the string that starts there is a repeat.

    ``n`` says how often a whole string stands in the texts.
    """
    rows = len(strings)
    width = -(-LENGTH // PACK) * PACK
    sizes = np.array([len(s) for s in strings])
    at = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(strings) + bytes(width), np.uint8)
    right = raw[(at + high)[:, None] + np.arange(width)[None, :]].copy()
    right[np.arange(width)[None, :] >= (sizes - high)[:, None]] = 0
    order, common = right_order(right)
    out = np.zeros((rows, int(high.max(initial=0)) + 1), bool)
    left = np.unique(core, return_inverse=True)[1]
    active = np.arange(rows)
    stretch = np.empty(rows, np.int64)
    for u in range(out.shape[1]):
        if u:
            active = active[high[active] >= u]
            left[active] = np.unique(left[active] * 256 + raw[(at + high)[active] - u], return_inverse=True)[1]
        # a left side that no other has, once, has no repeat here or farther on
        number = np.bincount(left[active], weights=n[active])
        active = active[number[left[active]] > 1]
        if not len(active):
            break
        stretch[order] = np.cumsum(common < LENGTH - u)
        own = active[low[active] <= u]
        if len(own):
            _, of = np.unique(left[own] * (rows + 1) + stretch[own], return_inverse=True)
            out[own, u] = np.bincount(of, weights=n[own])[of] > 1
    return out


def _spans(row: np.ndarray) -> bytes:
    """The runs of true entries as pairs (first, last) of little-endian 16-bit numbers."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], row, [False]]).astype(np.int8)))
    edges[1::2] -= 1
    return edges.astype("<i2").tobytes()


def _judge(table):
    """Rows (core, whole, spans) of the strings of one block of cores."""
    import pyarrow as pa

    core, whole, n, low, high = (table.column(k).to_numpy() for k in ("core", "whole", "n", "low", "high"))
    marks = repeated_starts(core, n, low, high, table.column("string").to_pylist())
    some = np.flatnonzero(marks.any(axis=1))
    return pa.table([pa.array(core[some]), pa.array(whole[some]), pa.array([_spans(marks[i]) for i in some.tolist()], pa.binary())], names=["core", "whole", "spans"])


def _repeats(texts: DataFrame, runs: DataFrame, last: bool) -> tuple[DataFrame, DataFrame]:
    """(text, m, spans) of the starts that are repeats, and the runs of cores with too many different strings."""
    cores = runs.groupBy("core").agg(F.count("*").alias("times"), F.min("whole").alias("least"), F.max("whole").alias("most")).filter("times > 1")
    # both sides of the joins on cores are written tables, so that Spark can split a hot core's rows
    cores = checkpointed(cores.select("core", (F.col("least") == F.col("most")).alias("alike")))
    again = checkpointed(runs.join(cores, "core"))
    alike = again.filter("alike").select("text", "m", F.struct("low", "high").alias("all"), F.lit(None).cast("binary").alias("spans"))
    counted = checkpointed(again.filter("NOT alike").groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct("text", "m", "low", "high")).alias("at")))
    wide = checkpointed(counted.groupBy("core").agg(F.count("*").alias("strings")).filter(F.col("strings") > (2**62 if last else MOST)).select("core"))
    listed = counted.join(wide, "core", "left_anti").groupBy("at.text").agg(F.collect_list(F.struct("core", "whole", "n", "at.m", "at.low", "at.high")).alias("runs"))
    strings = texts.join(listed, "text").select("bytes", "runs").mapInArrow(_strings, "core long, whole long, n long, low long, high long, string binary").dropDuplicates(["core", "whole"])
    blocks = max(32, -(-counted.count() * (LENGTH + SPAN) // BLOCK))
    judged = strings.withColumn("block", F.pmod(F.xxhash64("core"), F.lit(blocks))).groupBy("block").applyInArrow(_judge, "core long, whole long, spans binary")
    judged = checkpointed(judged)
    parted = again.filter("NOT alike").join(judged, ["core", "whole"]).select("text", "m", F.lit(None).cast("struct<low:int,high:int>").alias("all"), "spans")
    found = checkpointed(alike.unionByName(parted).distinct())
    left = checkpointed(again.filter("NOT alike").join(wide, "core").select("text", "m", "low", "high"))
    discard(runs, cores, again, counted, wide, judged)
    return found, left


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """text (the first half of its SHA-256), starts: for each text with repeats, the pairs (first, last) of starts of repeated strings."""
    texts = _texts(docs, text)
    runs = checkpointed(texts.mapInArrow(_scan, _RUNS))
    found = None
    for k, span in enumerate(ROUNDS):
        own, left = _repeats(texts, runs, span == 1)
        found = own if found is None else found.unionByName(own)
        if span == 1 or left.isEmpty():
            break
        listed = left.groupBy("text").agg(F.collect_set(F.struct("m", "low", "high")).alias("runs"))
        # texts that can't be listed are left out before the shuffle, by a hash of BUCKETS values
        bucket = F.pmod(F.xxhash64("text"), F.lit(BUCKETS)).alias("bucket")
        near = texts.select("*", bucket).join(F.broadcast(listed.select(bucket).distinct()), "bucket", "left_semi")
        runs = checkpointed(near.join(listed, "text").select("text", "bytes", "runs").mapInArrow(_narrowed(ROUNDS[k + 1]), _RUNS))
    return found.groupBy("text").agg(F.collect_set(F.struct("m", "all", "spans")).alias("marks"))


def _texts(docs: DataFrame, text: str, *more) -> DataFrame:
    """text (its hash), bytes, and ``more`` columns."""
    column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.substring(F.unhex(F.sha2(column, 256)), 1, 16).alias("text"), column.cast("binary").alias("bytes"), *more)


def removed(size: int, marks) -> list[tuple[int, int]]:
    """The maximal stretches (start, end) of removed bytes of a text."""
    if not marks:
        return []
    starts = []
    for r in marks:
        if r["all"] is not None:
            starts.append((r["m"] - r["all"]["high"], r["m"] - r["all"]["low"] + LENGTH))
        else:
            pairs = np.frombuffer(r["spans"], "<i2").tolist()
            starts += [(r["m"] - far, r["m"] - near + LENGTH) for near, far in zip(pairs[::2], pairs[1::2], strict=True)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _remover(kept: int):
    """Rows of the documents (columns: kept ones, the text's bytes, marks) with what is left and the removed stretches."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left, gone, stretches = [], [], []
                for raw, marks in zip(part.column(kept), part.column(kept + 1).to_pylist(), strict=True):
                    raw = raw.as_buffer().to_pybytes()
                    cut = removed(len(raw), marks)
                    ends = [0, *[x for c in cut for x in c], len(raw)]
                    left.append(b"".join([raw[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2)]) if cut else raw)
                    gone.append(sum(b - a for a, b in cut))
                    stretches.append([x for c in cut for x in c])
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(kept)], pa.array(left, pa.binary()), pa.array(gone, pa.int64()), pa.array(stretches, pa.list_(pa.int64()))], names=[*[f"c{k}" for k in range(kept)], "kept", "n_removed", "removed"])

    return run


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as c0, c1, ... with kept (the remaining bytes), n_removed, and removed (starts and ends of the stretches)."""
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    rows = _texts(docs, text, *own).join(repeats(docs, text), "text", "left")
    return rows.select(*[f"c{i}" for i in range(len(own))], "bytes", "marks").mapInArrow(_remover(len(own)), f"{kinds}, kept binary, n_removed long, removed array<bigint>")


def removal_digests(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = _texts(docs, text, F.col(f"`{doc}`").alias("c0")).join(repeats(docs, text), "text", "left")
    kind = docs.select(doc).schema[0].dataType.simpleString()
    made = rows.select("c0", "bytes", "marks").mapInArrow(_remover(1), f"c0 {kind}, kept binary, n_removed long, removed array<bigint>")
    return made.select(F.col("c0").alias(doc), (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"), "n_removed", F.floor(F.size("removed") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
