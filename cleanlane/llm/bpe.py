"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last ``WINDOW`` bytes cuts texts into chunks, so equal
passages give equal chunks wherever they stand.  A count over all documents
finds the chunks that recur; those that save most, up to a stated number of
bytes, are encoded once and broadcast as a dictionary (a hash only finds an
entry; its bytes must be equal).  Chunks that recur within a task are encoded
once for the task as well, in a memo of bounded size.

A chunk ends anywhere, also within a word.  Its encoding keeps apart what
stands before its first and behind its last white space.  A join re-encodes
the text around it, from the last white space before to the first behind, and
goes on over further chunks while there is none, until both ends are places
where the tokenizer always begins anew.  There the re-encoded ids and the
chunks' own agree by construction, so the result is exactly that of the whole
text.

ASCII white space is such a place if the tokenizer drops white space and
merges only within words, as the word-level BPE files do; ``check_tokenizer``
refuses others.

Defined results.  A null or empty text has no ids, and decodes to ''.  Special
tokens' strings in a text become special tokens, as the tokenizers library has
it by default.  Repeated rows are encoded each.  An empty table gives no rows.
Other columns stay, whatever their names.
"""

from __future__ import annotations

import sys
import types
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BASE_INV, checkpointed, powers, ship, small_batches, text_slices, trim

ship(__name__)

#: Bytes that decide about a cut; bytes of a chunk on average; bytes of a chunk at most.
WINDOW, MEAN, MOST = 32, 512, 1 << 16
#: Bytes of chunk text in the broadcast dictionary, and in a worker's memo of chunks; entries in each of the two halves of
#: its memo of words (the older half goes when the newer one is full).  What an entry of the dictionary costs besides its text.
DICTIONARY, MEMO, WORDS, ENTRY = 8 << 20, 2 << 20, 250_000, 100
SPACE = b" \t\n\r\x0b\x0c"
_HELD = "_cleanlane_encoders"
#: Bytes of the texts that are handled together: new words of all of them go to the tokenizer in one call.
SLICE = 1 << 20


def check_tokenizer(path: str) -> None:
    """Raise ValueError unless white space always separates what the tokenizer merges."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and r"\s" in first["pattern"].get("Regex", "")
    spaced = [t["content"] for t in spec.get("added_tokens", []) if t.get("lstrip") or t.get("rstrip") or any(c.isspace() for c in t["content"])]
    if not drops or spaced or spec.get("decoder"):
        raise ValueError(f"{path}: white space doesn't separate its words, or it has a decoder")


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of the texts in ``data``: the texts' ends and the cuts between."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    found = np.zeros(0, np.int64)
    if n > WINDOW:
        rolled = (sums[WINDOW:-1] - sums[: n - WINDOW]) * powers(BASE_INV, n - WINDOW)  # of the bytes before each place from WINDOW on
        found = np.flatnonzero(rolled < np.uint64(2**64 // MEAN)) + WINDOW
        found = found[data[found] & 0xC0 != 0x80]  # not within a character
        text = np.searchsorted(offsets, found, side="right") - 1
        found = found[found - offsets[text] >= WINDOW]
    ends = np.unique(np.concatenate([found, offsets[1:], offsets[:1]]))
    if len(ends) > 1 and np.diff(ends).max() > MOST:  # rare: texts without any cut for long
        more = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            while b - a > MOST:
                a += MOST
                while a < b and data[a] & 0xC0 == 0x80:
                    a += 1
                more.append(a)
        ends = np.unique(np.concatenate([ends, np.array(more, np.int64)]))
    return ends


def chunks_of(data: np.ndarray, offsets: np.ndarray):
    """The chunks of each text, as lists of bytes."""
    ends, raw = cuts(data, offsets), data.tobytes()
    at = np.searchsorted(ends, offsets)
    bounds = ends.tolist()
    for i in range(len(offsets) - 1):
        yield [raw[bounds[j] : bounds[j + 1]] for j in range(at[i], at[i + 1])]


def ids_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    own = array("I", ids)
    if own.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, "<u4").tobytes()
    return own.tobytes()


class Encoder:
    """Encodes texts chunk by chunk, with memos of bounded size that outlive a task."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        check_tokenizer(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spelled = {i: t.encode() + b" " for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        #: Bytes of each id's decoded token; ids that end a word.
        self.sizes = np.zeros(max(self.spelled) + 1, np.int64)
        self.sizes[list(self.spelled)] = [len(t) for t in self.spelled.values()]
        self.ends = np.zeros(max(self.spelled) + 1, bool)
        self.ends[[i for i, t in self.spelled.items() if t.endswith(b"</w> ")]] = True
        #: Of words and chunks: (ids as little-endian unsigned 32-bit numbers, decoded tokens with a space behind each).
        self.words: dict[bytes, tuple[bytes, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, bytes]] = {}
        self.memo: dict[bytes, tuple] = {}
        self.memo_bytes = 0
        self.encoded = self.reused = 0

    def _one_by_one(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        said = self.spelled.__getitem__
        made = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return [(ids_bytes(ids), b"".join(map(said, ids))) for ids in made]

    def _together(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Encodings of words of letters only, from one text: each ends at the next id that ends a word."""
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        own = np.array(ids, "<u4")
        cuts = np.flatnonzero(self.ends[own]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(own):  # lower case or composition has made something else of a letter
            return self._one_by_one(words)
        at = [0, *np.cumsum(self.sizes[own])[cuts - 1].tolist()]
        raw, text, cuts = own.tobytes(), b"".join(map(self.spelled.__getitem__, ids)), [0, *(4 * cuts).tolist()]
        return [(raw[cuts[i] : cuts[i + 1]], text[at[i] : at[i + 1]]) for i in range(len(words))]

    def learn(self, words: set[bytes]) -> None:
        """Put the encodings of words (between white space) into the memo, whose older half goes if the newer one is full."""
        if len(self.words) > WORDS and len(words) > WORDS // 50 or len(self.words) > 2 * WORDS:  # not for single words, while a slice's words are in use
            self.words, self.older = {}, self.words
        older, letters, others = self.older, [], []
        for w in words.difference(self.words):
            if w in older:
                self.words[w] = older[w]
            else:
                (letters if (t := w.decode("utf-8", "replace")).isalpha() else others).append((w, t))
        for group, encode in ((letters, self._together), (others, self._one_by_one)):
            if group:
                self.words.update(zip([w for w, _ in group], encode([t for _, t in group]), strict=True))

    def spans(self, words: list[bytes]) -> tuple[bytes, bytes]:
        """Encoding of words with white space between."""
        try:
            got = list(map(self.words.__getitem__, words))
        except KeyError:
            self.learn(set(words))
            got = list(map(self.words.__getitem__, words))
        ids, said = zip(*got, strict=True) if got else ((), ())
        return b"".join(ids), b"".join(said)

    def chunk(self, chunk: bytes) -> tuple:
        """(text before the first white space, encoding of what is between, text behind the last one); a chunk without: (itself, None, b'')."""
        got = self.memo.get(chunk)
        if got is not None:
            self.reused += 1
            return got
        parts = chunk.split()
        head = b"" if chunk[:1] in SPACE and chunk else (parts[0] if parts else b"")
        if not parts or (len(parts) == 1 and parts[0] == chunk):
            got = (chunk, None, b"") if parts else (b"", (b"", b""), b"")
        else:
            tail = b"" if chunk[-1:] in SPACE else parts[-1]
            inner = parts[bool(head) : len(parts) - bool(tail)]
            got = (head, self.spans(inner), tail)
        self.encoded += 1
        if self.memo_bytes + len(chunk) > MEMO:
            self.memo.clear()
            self.memo_bytes = 0
        self.memo[chunk] = got
        self.memo_bytes += len(chunk)
        return got

    def text(self, chunks: list[bytes], dictionary: dict[bytes, tuple]) -> tuple[bytes, bytes]:
        """(ids, decoded text) of a text from its chunks."""
        ids, said, open_text = [], [], b""
        for c in chunks:
            known = dictionary.get(c)
            if known is None:
                known = self.chunk(c)
            else:
                self.reused += 1
            head, body, tail = known
            if body is None:  # no white space: the join is still open
                open_text += head
                continue
            join = open_text + head
            if join:
                got = self.spans([join])
                ids.append(got[0])
                said.append(got[1])
            ids.append(body[0])
            said.append(body[1])
            open_text = tail
        if open_text:
            got = self.spans([open_text])
            ids.append(got[0])
            said.append(got[1])
        return b"".join(ids), b"".join(said)[:-1]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file: one for all tasks that the worker runs."""
    held = sys.modules.setdefault(_HELD, types.ModuleType(_HELD)).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _hash(chunk: bytes) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(chunk, digest_size=8).digest(), "little", signed=True)


def _counter():
    """Rows (hash, bytes, times) of the chunks, added up within record batches."""

    def run(batches):
        import pyarrow as pa

        trim()
        for batch in batches:
            times: dict[int, list[int]] = {}
            for _, data, offsets in text_slices(batch.column(0), SLICE):
                for own in chunks_of(data, offsets):
                    for c in own:
                        seen = times.get(h := _hash(c))
                        if seen is None:
                            times[h] = [len(c), 1]
                        else:
                            seen[1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(times), pa.int64()), pa.array([n for n, _ in times.values()], pa.int64()), pa.array([n for _, n in times.values()], pa.int64())], names=["hash", "bytes", "times"])

    return run


def _finder(shared):
    """Rows (chunk) of the chunks whose hash is asked for."""

    def run(batches):
        import pyarrow as pa

        trim()
        asked = set(shared.value)
        for batch in batches:
            got = set()
            for _, data, offsets in text_slices(batch.column(0), SLICE):
                for own in chunks_of(data, offsets):
                    for c in own:
                        if c not in got and (h := _hash(c)) in asked:
                            got.add(c)
                            asked.discard(h)
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.binary())], names=["chunk"])

    return run


def _entries(path: str):
    """Rows (chunk, head, ids, said, tail) of the dictionary's chunks."""

    def run(batches):
        import pyarrow as pa

        own = encoder(path)
        for batch in batches:
            got = [(c, *own.chunk(c)) for c in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in ([g[0] for g in got], [g[1] for g in got], [g[2] and g[2][0] for g in got], [g[2] and g[2][1] for g in got], [g[3] for g in got])], names=["chunk", "head", "ids", "said", "tail"])

    return run


def shared_chunks(docs: DataFrame, path: str, text: str = "text", limit: int = DICTIONARY) -> dict[bytes, tuple]:
    """The dictionary: the recurring chunks that save most, at most ``limit`` bytes of them, each encoded once."""
    texts = docs.select(text)
    counts = texts.mapInArrow(_counter(), "hash long, bytes long, times long").groupBy("hash").agg(F.max("bytes").alias("bytes"), F.sum("times").alias("times"))
    recurring = checkpointed(counts.filter("times > 1").withColumn("saved", F.col("bytes") * (F.col("times") - 1)), small=True)
    # the least saving that still fits, from sums over powers of two
    steps = recurring.groupBy(F.floor(F.log2("saved")).cast("int").alias("step")).agg(F.sum(F.col("bytes") + ENTRY).alias("bytes")).orderBy(F.desc("step")).collect()
    room, least = limit, None
    for step, size in steps:
        if size > room:
            break
        room, least = room - size, step
    if least is None:
        return {}
    asked = [r[0] for r in recurring.filter(F.floor(F.log2("saved")) >= least).select("hash").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(asked)
    found = texts.mapInArrow(_finder(shared), "chunk binary").distinct()
    with small_batches(docs.sparkSession):
        got = found.mapInArrow(_entries(path), "chunk binary, head binary, ids binary, said binary, tail binary").collect()
    return {bytes(c): (bytes(h), None if i is None else (bytes(i), bytes(s)), bytes(t)) for c, h, i, s, t in got}


def _coder(path: str, shared, text_at: int, kept: int):
    def run(batches):
        import pyarrow as pa

        trim(_HELD)
        own, dictionary = encoder(path), shared.value
        for batch in batches:
            for at, data, offsets in text_slices(batch.column(text_at), SLICE):
                ids, said, chunks, reused = [], [], [], []
                own.learn(set(data.tobytes().split()))  # one call of the tokenizer for the slice's new words
                for parts in chunks_of(data, offsets):
                    before = own.reused
                    i, s = own.text(parts, dictionary)
                    ids.append(i)
                    said.append(s)
                    chunks.append(len(parts))
                    reused.append(own.reused - before)
                columns = [batch.column(k).slice(at, len(ids)) for k in range(kept)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary()), pa.array(said, pa.binary()), pa.array(chunks, pa.int64()), pa.array(reused, pa.int64())], names=[*[f"c{k}" for k in range(kept)], "ids", "decoded", "n_chunks", "n_reused"])

    return run


def encode(docs: DataFrame, path: str, text: str = "text", limit: int = DICTIONARY) -> DataFrame:
    """All columns of ``docs`` as c0, c1, ... with ids (little-endian unsigned 32-bit numbers), decoded, n_chunks and n_reused."""
    check_tokenizer(path)
    shared = docs.sparkSession.sparkContext.broadcast(shared_chunks(docs, path, text, limit))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    types_ = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return rows.mapInArrow(_coder(path, shared, docs.columns.index(text), len(docs.columns)), f"{types_}, ids binary, decoded binary, n_chunks long, n_reused long").withColumn("decoded", F.col("decoded").cast("string"))


def digests(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n_tokens, ids_sha256, decoded_sha256, n_chunks of every document."""
    made = encode(docs.select(doc, text), path, text)
    made = made.select(F.col("c0").alias(doc), F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "n_chunks")
    return checkpointed(made, small=True)
