"""Alignment of two tokenizers' tokens through token-byte incidence matrices.

A byte-level BPE (A) and a sentencepiece BPE with byte fallback (B) cut the
same bytes.  A's matrix has a row for each token and a column for each byte, in
CSR form built here; so has B's.  The row products A * Bt (Gustavson: each row
of A adds up the rows of Bt that its columns name) give the overlap links, with
the number of shared bytes as value.  Bytes where tokens of both end cut the
tokens into groups; the products of the token-group matrices give the links
between tokens of one group.

Both tokenizers always cut before a single space between two characters that
are not white space: A's words begin there, and no piece of B holds a space
behind another character (``check_pieces`` refuses models with such pieces).
So a text is a sequence of segments, which recur, and a matrix for the segments
of a shard of texts is block diagonal.  Each distinct segment of a shard is
encoded once, many in one call, and its links are counted as often as it occurs.

The corpus-wide counts of linked id pairs go through counting quotient filters
(``quotient``): equal blocks of all shards are merged in one task, which answers
each shard with the counts of its pairs.  Only the highest count of each id of B
is collected and broadcast: at most a row for each entry of B's vocabulary.

Defined results.  Texts that are null, empty, or whose joined token bytes differ
from space + text (a literal U+2581 in B, for one) have no tokens: zeros, and
their links count nowhere.  Special tokens' strings are plain text.  Ties for the
highest count all count.  Repeated rows count each.  An empty table gives no
rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quotient
from .common import arrow_table, checkpointed, discard, ship, text_slices, trim

ship(__name__)

#: Bytes of text and distinct segments in a shard; bytes of segments encoded in one call; bytes of input for a block.
SHARD_BYTES, SHARD_SEGMENTS, CALL, BLOCK = 4 << 20, 60_000, 1 << 17, 64 << 20
#: Segments whose matrices are multiplied at once.
SEGMENTS = 8_192
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|\s ")
_ROWS = "shard string, block int, data binary"
_SHARDS = _ROWS + ", state binary"
_HELD = "_cleanlane_aligned"


# ---- sparse matrices in CSR form: (row pointer, columns); all stored values are 1 ----


def incidence(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token x byte: row i has the ``lengths[i]`` columns behind those of the rows before."""
    pointer = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    return pointer, np.arange(pointer[-1])


def transpose(pointer: np.ndarray, columns: np.ndarray, n_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The transposed matrix, by counting its rows."""
    rows = np.repeat(np.arange(len(pointer) - 1), np.diff(pointer))
    out = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(columns, minlength=n_columns))])
    return out, rows[np.argsort(columns, kind="stable")]


def product(a: tuple, b: tuple, n_columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of the product's entries, in row order (Gustavson's row products, for all rows at once)."""
    counts = np.diff(b[0])[a[1]]  # entries of b's row for each entry of a
    rows = np.repeat(np.repeat(np.arange(len(a[0]) - 1), np.diff(a[0])), counts)
    first = np.cumsum(counts) - counts
    columns = b[1][np.repeat(b[0][a[1]] - first, counts) + np.arange(len(rows))]
    key = rows * max(1, n_columns) + columns
    if len(key) > 1 and (key[1:] < key[:-1]).any():
        key = np.sort(key)
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    values = np.diff(np.append(new, len(key)))
    return key[new] // max(1, n_columns), key[new] % max(1, n_columns), values


def overlap_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A's and B's token places and their shared bytes, from the tokens' byte lengths (of equal sums)."""
    own, other = incidence(a), incidence(b)
    return product(own, transpose(*other, int(a.sum())), len(b))


def groups_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of each token of A, of each of B, and the number of groups."""
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    if not len(a):
        return ends_a, ends_b, 0
    both = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a]
    return np.searchsorted(both, ends_a), np.searchsorted(both, ends_b), len(both)


def group_links(of_a: np.ndarray, of_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A's and B's token places that share a group."""
    own = (np.arange(len(of_a) + 1), of_a)
    return product(own, transpose(np.arange(len(of_b) + 1), of_b, n), len(of_b))[:2]


# ---- tokenizers ----


def segments(text: str) -> list[str]:
    """space + ``text``, cut before each single space between characters that are not white space."""
    text = " " + text
    if _ODD.search(text) is None and text[-1] != " ":
        return [" " + s for s in text[1:].split(" ")]
    first, *rest = _CUT.split(text)
    return [first, *[" " + s for s in rest]]


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def check_pieces(pieces: list[bytes]) -> None:
    """Raise ValueError if a piece has a space behind another character."""
    for p in pieces:
        if b" " in p.lstrip(b" "):
            raise ValueError(f"the piece {p!r} crosses a space")


class Tokenizers:
    """Both tokenizers, and the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n = self.b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(n))]
        check_pieces(self.bytes_b)
        #: Each id with a comma, and with what ends its part of a group.
        self.names = [b"%d%b" % (i, end) for n, last in ((len(self.bytes_a), b"|"), (len(self.bytes_b), b";")) for i in range(n) for end in (b",", last)]
        self.len_a, self.len_b = np.array([len(x) for x in self.bytes_a]), np.array([len(x) for x in self.bytes_b])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B of ``text``, which starts with a space; None where their bytes differ from it."""
        raw = text.encode()
        a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.b.encode(text[1:])
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def encode_all(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all segments one after another, each segment's numbers of ids, and where ``encode`` has none.

        Regular segments are encoded many in one call.
        """
        ids_a, ids_b, n_a, n_b, bad = [], [], [], [], []

        def put(a, b, own_a, own_b, failed) -> None:
            for out, x in ((ids_a, a), (ids_b, b), (n_a, own_a), (n_b, own_b), (bad, failed)):
                out.append(x)

        def together(own: list[str]) -> None:
            got = self.encode("".join(own))
            if got is None and len(own) > 1:  # one of them is at fault
                together(own[: len(own) // 2])
                together(own[len(own) // 2 :])
            elif got is None:
                put(*[np.zeros(0, np.int64)] * 2, *[np.zeros(1, np.int64)] * 2, np.ones(1, bool))
            else:
                ends = np.cumsum([len(p.encode()) for p in own])
                counts = []
                for ids, size in zip(got, (self.len_a, self.len_b), strict=True):
                    at = np.cumsum(size[ids])
                    cut = np.searchsorted(at, ends)
                    if (at[cut] != ends).any():
                        raise ValueError("a token crosses the space between two segments")
                    counts.append(np.diff(cut, prepend=-1))
                put(*got, *counts, np.zeros(len(own), bool))

        held, size = [], 0
        for p in parts:
            odd = len(p) < 2 or p[1].isspace() or p[-1] == " "
            if held and (odd or size + len(p) > CALL):
                together(held)
                held, size = [], 0
            if odd:
                together([p])
            else:
                held.append(p)
                size += len(p)
        if held:
            together(held)
        empty = np.zeros(0, np.int64)
        return *[np.concatenate([empty, *x]) for x in (ids_a, ids_b, n_a, n_b)], np.concatenate([np.zeros(0, bool), *bad])


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """The worker's tokenizers: one pair for all tasks that the worker runs."""
    held = sys.modules.setdefault(_HELD, types.ModuleType(_HELD)).__dict__
    if (path_a, path_b) not in held:
        held[path_a, path_b] = Tokenizers(path_a, path_b)
    return held[path_a, path_b]


# ---- one document: its whole alignment ----


def _aligner(path_a: str, path_b: str, kept: int):
    def run(batches):
        import pyarrow as pa

        both = tokenizers(path_a, path_b)
        for batch in batches:
            for at, data, offsets in text_slices(batch.column(kept)):
                out = []
                raw, bounds = data.tobytes(), offsets.tolist()
                for i in range(len(bounds) - 1):
                    a, b, _, _, bad = both.encode_all(segments(raw[bounds[i] : bounds[i + 1]].decode()) if bounds[i] < bounds[i + 1] else [])
                    if bad.any() or not len(a):
                        out.append(([], [], [], [], [], [], []))
                        continue
                    link_a, link_b, shared = overlap_links(both.len_a[a], both.len_b[b])
                    of_a, of_b, _ = groups_of(both.len_a[a], both.len_b[b])
                    out.append((a, b, link_a, link_b, shared, of_a, of_b))
                columns = [batch.column(k).slice(at, len(out)) for k in range(kept)]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array([o[k] for o in out], pa.list_(pa.int64())) for k in range(7)]], names=[*[f"c{k}" for k in range(kept)], "a", "b", "link_a", "link_b", "shared", "group_a", "group_b"])

    return run


def alignments(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as c0, c1, ... with the ids a and b, the links (places in a and in b, and shared bytes) and each token's group."""
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return rows.mapInArrow(_aligner(path_a, path_b, len(docs.columns)), kinds + "".join(f", {x} array<bigint>" for x in ("a", "b", "link_a", "link_b", "shared", "group_a", "group_b")))


# ---- all documents: counts of linked pairs ----


class _Shard:
    def __init__(self):
        self.ids: dict[str, int] = {}
        self.docs, self.codes, self.size = [], [], 0

    def add(self, doc, raw: bytes) -> None:
        ids = self.ids
        codes = [ids.setdefault(s, len(ids)) for s in segments(raw.decode())] if raw else []
        self.docs.append(doc)
        self.codes.append(np.array(codes, np.int32))
        self.size += len(raw)

    def full(self) -> bool:
        return self.size > SHARD_BYTES or len(self.ids) > SHARD_SEGMENTS

    def rows(self, both: Tokenizers, bits: int) -> list[tuple]:
        parts = list(self.ids)
        n, kept = len(parts), [[] for _ in range(8)]
        for at in range(0, n, SEGMENTS):  # the segments' matrices are the blocks of one; those of some segments at a time
            for out, x in zip(kept, _described(both, parts[at : at + SEGMENTS]), strict=True):
                out.append(x)
        bad, n_a, n_b, n_groups, links, shared, keys = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in kept[:7])
        said = [s for x in kept[7] for s in x]
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(c) for c in self.codes], dtype=np.int64)])
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        failing = np.array([bad[c].any() or not len(c) for c in self.codes], bool)
        # pairs, as often as their segments occur in documents with tokens
        times = np.bincount(np.concatenate([np.zeros(0, np.int32), *[c for c, f in zip(self.codes, failing, strict=True) if not f]]), minlength=n)
        permuted, place = np.unique(quotient.permute(keys), return_inverse=True)
        counts = np.bincount(place, weights=np.repeat(times, links), minlength=len(permuted)).astype(np.uint64)
        per_doc = []
        for i, c in enumerate(self.codes):
            if failing[i]:
                per_doc.append((0, 0, 0, 0, 0, ""))
            else:
                per_doc.append((*(int(x[c].sum()) for x in (n_a, n_b, n_groups, links, shared)), hashlib.sha256(b"".join([said[k] for k in c.tolist()])[:-1]).hexdigest()))
        own = uuid.uuid4().hex
        state = {"docs": self.docs, "per_doc": per_doc, "codes": codes, "bounds": bounds, "failing": failing, "links": links, "place": place.astype(np.int32), "pairs": permuted}
        out = [(own, -1, None, pickle.dumps(state, protocol=5))]
        blocks, ends = quotient.block_bounds(permuted, bits)
        for k, x, y in zip(blocks.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out.append((own, k, quotient.to_bytes(permuted[x:y], counts[x:y], bits), None))
        return out


def _described(both: Tokenizers, parts: list[str]) -> tuple:
    """Of each segment: no encoding, tokens of A and of B, groups, links, links by groups; the id pairs of all links; the groups as text."""
    n = len(parts)
    a, b, n_a, n_b, bad = both.encode_all(parts)
    link_a, link_b, _ = overlap_links(both.len_a[a], both.len_b[b])
    of_a, of_b, _ = groups_of(both.len_a[a], both.len_b[b])
    shared_a, _ = group_links(of_a, of_b, len(of_a))
    segment = np.repeat(np.arange(n), n_a)  # of each token of A
    new = np.concatenate([np.ones(min(1, len(of_a)), bool), of_a[1:] != of_a[:-1]])
    keys = a[link_a].astype(np.uint64) << np.uint64(32) | b[link_b].astype(np.uint64)
    links, shared, n_groups = (np.bincount(segment[x], minlength=n) for x in (link_a, shared_a, new))
    return bad, n_a, n_b, n_groups, links, shared, keys, _spelled(both, a, b, of_a, of_b, n_a + n_b)


def _spelled(both: Tokenizers, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, tokens: np.ndarray) -> list[bytes]:
    """The groups of each segment as `a1,a2|b1;a3|b2,b3;`, from its number of tokens of both kinds."""
    # every token's text with what stands behind it: A's end in a comma or a bar, B's in a comma or a semicolon
    last_a, last_b = (np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool) for of in (of_a, of_b))
    said = np.empty(len(a) + len(b), np.int64)
    said[np.arange(len(a)) + np.searchsorted(of_b, of_a)] = 2 * a + last_a
    said[np.arange(len(b)) + np.searchsorted(of_a, of_b, side="right")] = 2 * (len(both.bytes_a) + b) + last_b
    said = [both.names[i] for i in said.tolist()]
    ends = np.cumsum(tokens).tolist()
    return [b"".join(said[x:y]) for x, y in zip([0, *ends[:-1]], ends, strict=True)]


def _shards(path_a: str, path_b: str, bits: int):
    def run(batches):
        trim(_HELD)
        both, shard = tokenizers(path_a, path_b), _Shard()
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for at, data, offsets in text_slices(batch.column(1)):
                raw, bounds = data.tobytes(), offsets.tolist()
                for i in range(len(bounds) - 1):
                    shard.add(docs[at + i], raw[bounds[i] : bounds[i + 1]])
                if shard.full():
                    yield from arrow_table(shard.rows(both, bits), _SHARDS).to_batches()
                    shard = _Shard()
                    trim(_HELD)
        if shard.docs:
            yield from arrow_table(shard.rows(both, bits), _SHARDS).to_batches()

    return run


def _merge(bits: int):
    """Answers of one block to all shards, and its highest count of each id of B (as one row without a shard)."""

    def run(table):
        trim()
        rows = table.to_pylist()
        block = rows[0]["block"]
        own = [quotient.from_bytes(r["data"], block, bits) for r in rows]
        keys, counts = quotient.merge(own)
        out = [(r["shard"], block, counts[np.searchsorted(keys, k)].astype("<u8").tobytes()) for r, (k, _) in zip(rows, own, strict=True)]
        ids = quotient.restore(keys) & np.uint64(2**32 - 1)
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(ids)), bool), np.diff(ids[order]) != 0]))
        best = np.maximum.reduceat(counts[order], first)
        out.append((None, block, np.stack([ids[order][first], best]).astype("<u8").tobytes()))
        return arrow_table(out, _ROWS)

    return run


def _best(batches):
    for batch in batches:
        rows = []
        for data in batch.column(0).to_pylist():
            rows += zip(*np.frombuffer(data, "<u8").reshape(2, -1).tolist(), strict=True)
        yield from arrow_table(rows, "id long, best long").to_batches()


def _finish(shared):
    """The rows of a shard's documents from its state and the answers to it."""

    def run(table):
        trim()
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        state = pickle.loads(rows[0]["data"])
        counts = np.concatenate([np.zeros(0, "<u8"), *[np.frombuffer(r["data"], "<u8") for r in rows[1:]]])
        top = shared.value
        best = counts == top[(quotient.restore(state["pairs"]) & np.uint64(2**32 - 1)).astype(np.int64)]
        # sums over the links of each segment, then over the segments of each document
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(state["links"])])
        out = []
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x[state["place"]].astype(np.uint64))]) for x in (best, counts)]
        n_best, total = (s[ends[1:]] - s[ends[:-1]] for s in sums)
        for i, doc in enumerate(state["docs"]):
            c = state["codes"][state["bounds"][i] : state["bounds"][i + 1]]
            found = (0, 0) if state["failing"][i] else (int(n_best[c].sum()), int(total[c].sum()))
            out.append((doc, *state["per_doc"][i][:4], *found, state["per_doc"][i][5], state["per_doc"][i][4]))
        return arrow_table(out, "doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long")

    return run


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc (a long), n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_shared (token pairs of one group) of every document."""
    rows = docs.select(F.col(f"`{doc}`").cast("long").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = quotient.block_bits(size, BLOCK)
    shards = checkpointed(rows.mapInArrow(_shards(path_a, path_b, bits), _SHARDS), small=True)
    merged = checkpointed(shards.filter("block >= 0").select("shard", "block", "data").groupBy("block").applyInArrow(_merge(bits), _ROWS), small=True)
    highest = merged.filter("shard IS NULL").select("data").mapInArrow(_best, "id long, best long").groupBy("id").agg(F.max("best").alias("best")).collect()
    top = np.zeros(1 + max([r["id"] for r in highest], default=0), np.uint64)  # a row for each entry of B's vocabulary at most
    for r in highest:
        top[r["id"]] = r["best"]
    shared = docs.sparkSession.sparkContext.broadcast(top)
    both = shards.filter("block < 0").select("shard", "block", F.col("state").alias("data")).unionByName(merged.filter("shard IS NOT NULL"))
    out = checkpointed(both.groupBy("shard").applyInArrow(_finish(shared), "doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_shared long"), small=True)
    discard(shards, merged)
    return out.withColumnRenamed("doc", doc)
