"""Benchmark decontamination: prefix-filtered set join over item-sized windows.

An item's windows are sets of word shingles with their places.  All shingles
of the benchmark are ordered by how often they occur in the documents.  A
document window that holds at least the share ``threshold`` of a window's
shingles must hold one of its rarest few (the prefix: one of them, if all are
asked for), so only these are looked up.  A hit fixes where the window would
begin; windows that don't fit into the document there (length and positional
bounds) go, and the rest is verified word by word over the item-sized window.

The benchmark is a query set: its windows are dealt into blocks of bounded
size, each broadcast in turn, and each block's join goes over all documents in
place.  Texts are never shuffled; what the corpus statistics shuffle is a
count for each benchmark shingle and task.

Defined results.  A null or empty text has no words and no hits.  A null item
text has no windows; a null item id counts as the id ''.  Items are told apart
by their id.  Repeated documents are each judged, repeated items add nothing.
An empty benchmark contaminates nothing; no documents give no rows.  Other
columns stay, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, fold_table, ship, shingle_hashes, small_batches, text_slices, trim, words

ship(__name__)

#: (window, item) pairs in a broadcast block, about 150 bytes each.
BLOCK_PAIRS = 200_000
#: Word shingles that windows are joined by; shorter windows use all their words.
SHINGLE = 5
#: Bits of the table that sorts out most shingles before the search.
SIEVE_BITS = 22
#: What is no part of a word: every ASCII character but digits and letters.
FOLD = fold_table([b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)])


def _windows(size: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found, owner = [], []
            ids = batch.column(0).to_pylist()
            for at, data, offsets in text_slices(batch.column(1)):
                start, end, first, _ = words(data, offsets, FOLD)
                folded = FOLD[data].tobytes()
                for i in range(len(offsets) - 1):
                    own = [folded[start[j] : end[j]] for j in range(first[i], first[i + 1])]
                    for a in range(max(1, len(own) - size + 1) if own else 0):
                        found.append(b" ".join(own[a : a + size]))
                        owner.append(ids[at + i])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(owner, pa.string())], names=["win", "item"])

    return run


class Block:
    """A block's windows with the hashes of their words, grouped by length."""

    def __init__(self, texts: list[bytes], items: list[list[str]]):
        self.texts, self.items = texts, items
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        _, _, first, hashes = words(data, offsets, FOLD)
        self.first, self.hashes = first, hashes
        self.length = np.diff(first)
        #: Of each shingle size: (hash, window, place in the window), a row for each shingle.
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(self.length):
            size, win = min(SHINGLE, int(n)), np.flatnonzero(self.length == n)
            grid = first[win][:, None] + np.arange(n - size + 1)
            h = shingle_hashes(hashes, size)[grid]
            got = (h.ravel(), np.repeat(win, h.shape[1]), np.tile(np.arange(h.shape[1]), len(win)))
            old = self.shingles.get(size)
            self.shingles[size] = tuple(np.concatenate(x) for x in zip(old, got, strict=True)) if old else got

    def distinct(self) -> dict[int, np.ndarray]:
        return {size: np.unique(h) for size, (h, _, _) in self.shingles.items()}

    def prefixes(self, counts: dict[int, np.ndarray], threshold: float) -> dict[int, tuple[np.ndarray, ...]]:
        """Of each shingle size the necessary rows, sorted by hash: the rarest of each window, as many as ``threshold`` leaves no way around."""
        out = {}
        for size, (h, win, place) in self.shingles.items():
            rare = counts[size][np.searchsorted(np.unique(h), h)]
            order = np.lexsort((h, rare, win))
            slots = self.length[win[order]] - size + 1
            begins = np.flatnonzero(np.r_[True, win[order][1:] != win[order][:-1]])
            rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
            need = slots - np.ceil(threshold * slots - 1e-9).astype(int) + 1
            chosen = order[rank < need]
            chosen = chosen[np.argsort(h[chosen], kind="stable")]
            out[size] = (h[chosen], win[chosen], place[chosen])
        return out


def _sieve(h: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << SIEVE_BITS, bool)
    out[(h >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
    return out


def _looked_up(hashes: np.ndarray, first: np.ndarray, size: int, known: np.ndarray, sieve: np.ndarray):
    """(word, row of ``known`` at the left) of each shingle within one text that is in ``known`` (sorted)."""
    sh = shingle_hashes(hashes, size)
    at = np.flatnonzero(sieve[(sh >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
    low = np.searchsorted(known, sh[at])
    ok = known[np.minimum(low, len(known) - 1)] == sh[at]
    at, low = at[ok], low[ok]
    inside = at + size <= first[np.searchsorted(first, at, side="right")]
    return at[inside], low[inside], sh


def _counter(shared):
    """Task part of the rarity count: (size, index, occurrences) rows, added up over the task."""

    def run(batches):
        import pyarrow as pa

        trim()
        distinct = shared.value
        sieves = {size: _sieve(h) for size, h in distinct.items()}
        totals = {size: np.zeros(len(h), np.int64) for size, h in distinct.items()}
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                _, _, first, hashes = words(data, offsets, FOLD)
                for size, known in distinct.items():
                    if len(known):
                        _, low, _ = _looked_up(hashes, first, size, known, sieves[size])
                        totals[size] += np.bincount(low, minlength=len(known))
        for size, n in totals.items():
            got = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), size, np.int32)), pa.array(got.astype(np.int64)), pa.array(n[got])], names=["size", "at", "n"])

    return run


def _occurrences(block: Block, prefix, sieves, threshold, data, start, end, first, hashes):
    """(first word, window, matched words) of every verified window in a slice of texts."""
    folded = None
    for size, (known, win, place) in prefix.items():
        if not len(known):
            continue
        at, low, _ = _looked_up(hashes, first, size, known, sieves[size])
        times = np.searchsorted(known, known[low], side="right") - low
        for lot in np.array_split(np.arange(len(at)), max(1, math.ceil(times.sum() / 200_000))):
            row = np.repeat(low[lot], times[lot]) + np.arange(times[lot].sum()) - np.repeat(np.cumsum(times[lot]) - times[lot], times[lot])
            w, a = win[row], np.repeat(at[lot], times[lot]) - place[row]
            text = np.searchsorted(first, np.repeat(at[lot], times[lot]), side="right")
            fits = (a >= first[text - 1]) & (a + block.length[w] <= first[text])
            pairs = np.unique(np.stack([a[fits], w[fits]]), axis=1)
            for n in np.unique(block.length[pairs[1]]):
                a, w = pairs[:, block.length[pairs[1]] == n]
                same = hashes[a[:, None] + np.arange(n)] == block.hashes[block.first[w][:, None] + np.arange(n)]
                slots = n - size + 1
                whole = np.ones((len(a), slots), bool)
                for i in range(size):
                    whole &= same[:, i : i + slots]
                for i in np.flatnonzero(whole.sum(1) >= math.ceil(threshold * slots - 1e-9)):
                    covered = np.zeros(n, bool)
                    for j in range(size):
                        covered[j : j + slots] |= whole[i]
                    if folded is None:
                        folded = FOLD[data].tobytes()
                    own = block.texts[w[i]].split(b" ")
                    said = [folded[start[a[i] + j] : end[a[i] + j]] for j in range(n)]
                    if all(said[j] == own[j] for j in range(n) if covered[j]):
                        yield int(a[i]), int(w[i]), covered


def _marker(shared, threshold: float, text_at: int, kept: int):
    """Task part of the join: the rows with what earlier blocks have found, and this block's."""

    def run(batches):
        import pyarrow as pa

        trim()
        texts, named_items, prefix = shared.value
        block = Block(texts, named_items)
        sieves = {size: _sieve(h) for size, (h, _, _) in prefix.items()}
        for batch in batches:
            n_words, n_hit, covers, items = [], [], batch.column(kept).to_pylist(), batch.column(kept + 1).to_pylist()
            for at, data, offsets in text_slices(batch.column(text_at)):
                start, end, first, hashes = words(data, offsets, FOLD)
                hit: dict[int, np.ndarray] = {}
                named: dict[int, set] = {}
                for a, w, covered in _occurrences(block, prefix, sieves, threshold, data, start, end, first, hashes):
                    i = int(np.searchsorted(first, a, side="right")) - 1
                    if i not in hit:
                        hit[i] = np.zeros(first[i + 1] - first[i], bool)
                    hit[i][a - first[i] : a - first[i] + len(covered)] |= covered
                    named.setdefault(i, set()).update(block.items[w])
                for i, n in enumerate(np.diff(first).tolist()):
                    own = hit.get(i)
                    if covers[at + i] is not None:
                        old = np.unpackbits(np.frombuffer(covers[at + i], np.uint8), count=n).astype(bool)
                        own = old if own is None else own | old
                    if own is not None:
                        covers[at + i] = np.packbits(own).tobytes()
                        items[at + i] = sorted({*(items[at + i] or ()), *named.get(i, ())})
                    n_words.append(n)
                    n_hit.append(0 if own is None else int(own.sum()))
            made = [pa.array(covers, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
            columns = [batch.column(i) for i in range(kept)] + made
            yield pa.RecordBatch.from_arrays(columns, names=[*[f"c{i}" for i in range(kept)], "covers", "items", "n_words", "n_hit"])

    return run


def annotate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, threshold: float = 1.0, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """All columns of ``docs`` as c0, c1, ... with n_words, n_hit and items (found ids, sorted as strings).

    A window is ``window`` consecutive item words, or all words of a shorter
    item.  A document word is hit inside a window of which at least the share
    ``threshold`` of shingles is found in place (1: the very words).
    """
    spark = docs.sparkSession
    wins = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text")).mapInArrow(_windows(window), "win binary, item string").distinct()
    wins = checkpointed(wins, small=True)
    blocks = max(1, math.ceil(wins.count() / block_pairs))
    kept = len(docs.columns)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.lit(None).cast("binary").alias("covers"), F.lit(None).cast("array<string>").alias("items"))
    text_at = docs.columns.index(text)
    types = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    for k in range(blocks):
        own = wins.filter(F.pmod(F.xxhash64("win", "item"), F.lit(blocks)) == k).groupBy("win").agg(F.collect_list("item").alias("items")).collect()
        block = Block([bytes(r[0]) for r in own], [r[1] for r in own])
        distinct = block.distinct()
        counts = {size: np.zeros(len(h), np.int64) for size, h in distinct.items()}
        if own:
            known = spark.sparkContext.broadcast(distinct)
            seen = docs.select(text).mapInArrow(_counter(known), "size int, at long, n long").groupBy("size", "at").agg(F.sum("n"))
            with small_batches(spark):
                got = seen.collect()
            for size, at, n in got:
                counts[size][at] = n
        shared = spark.sparkContext.broadcast((block.texts, block.items, block.prefixes(counts, threshold)))
        rows = rows.select(*[f"c{i}" for i in range(kept)], "covers", "items").mapInArrow(_marker(shared, threshold, text_at, kept), f"{types}, covers binary, items array<string>, n_words long, n_hit long")
        if k + 1 < blocks:
            rows = checkpointed(rows, small=True)
    return rows.drop("covers")


def contamination(docs: DataFrame, items: DataFrame, doc: str = "doc_id", **how) -> DataFrame:
    """doc, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    narrow = docs.select(doc, how.get("text", "text"))
    found = annotate(narrow, items, **how)
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(F.col("c0").alias(doc), "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The documents without any hit, with their own columns."""
    found = annotate(docs, items, **how).filter("n_hit = 0")
    return checkpointed(found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]), small=True)
