"""Phrase collocation mining with counting quotient filters.

Texts become shards of word codes, by language.  Counting goes level by level:
a phrase of k words can only be frequent if its first and its last k-1 words
are, so its key is the packed pair of their numbers, and pairs with a rare
part are never counted.

* A shard counts its keys in a counting quotient filter (``quotient``) and
  keeps, in place of the text, the sequence of places in that filter.
* Equal blocks of all shards' filters are merged in one task, which numbers the
  frequent keys and answers each shard: the numbers of its keys, in its order.
* A shard turns the answers into the sequence of the next level.

Words themselves are counted the same way, in blocks by a hash of the word, as
strings.  No dictionary is broadcast and none reaches the driver.  A block
stands for at most ``BLOCK`` bytes of input on average, and gets a word or
phrase once from each shard.

Defined results.  A null or empty text has no words; a null language is `und`.
Repeated rows count each.  Separators within a word's letters end pieces, so no
phrase crosses them or a document's end.  Ties go as ``collocations`` says.  An
empty table gives no rows.  Other columns are ignored, whatever their names.
More than 2**32 frequent words or phrases of one length in one language are an
error (OverflowError), as two of their numbers fill a key.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient
from .common import arrow_table, checkpointed, discard, ship, text_slices, trim

ship(__name__)

#: Words of a shard and entries of its dictionary, about; bytes of a text handled at once; bytes of input for a block.
SHARD_WORDS, SHARD_ENTRIES, WINDOW, BLOCK = 1_000_000, 200_000, 1 << 20, 64 << 20
#: Ends a piece; stands for all separators (no byte of UTF-8).
BREAK = b"\xff"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + 10 * BREAK)
_SHARDS = "lang string, shard string, block int, data binary, counts binary, words long"
_MERGED = "lang string, shard string, block int, data binary, id long, head long, tail long, word string, f long"


class _Codes(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def pieces(text: bytes):
    """The words of a text, with BREAK between pieces, as lists of bounded size; ``text`` may hold BREAK itself."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = at + WINDOW
        if end < len(folded):
            end = folded.rfind(b" ", at, end) + 1 or folded.find(b" ", end) + 1 or len(folded)
        yield folded[at:end].replace(BREAK, b" \xff ").split()
        at = end


def without_repeats(codes: np.ndarray) -> np.ndarray:
    """``codes`` with one -1 in place of several."""
    gap = codes < 0
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    return codes[keep]


class _Shard:
    def __init__(self):
        self.ids, self.codes, self.size = _Codes({BREAK: 0}), [], 0

    def add(self, texts: list[bytes]) -> None:
        for words in pieces(BREAK.join(texts) + BREAK):
            self.codes.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
            self.size += len(words)

    def full(self) -> bool:
        return self.size > SHARD_WORDS or len(self.ids) > SHARD_ENTRIES

    def rows(self, lang: str, bits: int):
        codes = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int32)
        words = list(self.ids)[1:]
        counts = np.bincount(codes, minlength=len(self.ids))[1:]
        hashes = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) << np.uint64(32)
        permuted = quotient.permute(hashes)
        order = np.argsort(permuted >> np.uint64(64 - bits), kind="stable")
        rank = np.full(len(self.ids), -1, np.int32)
        rank[1 + order] = np.arange(len(words), dtype=np.int32)
        own = uuid.uuid4().hex
        out = [(lang, own, -1, without_repeats(rank[codes]).tobytes(), b"", int(counts.sum()))]
        blocks, ends = quotient.block_bounds(permuted[order], bits)
        for b, a, e in zip(blocks.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out.append((lang, own, b, b"\n".join([words[i] for i in order[a:e].tolist()]), counts[order[a:e]].astype("<u4").tobytes(), 0))
        return out


def _shards(bits: int):
    def run(batches):
        trim()
        held: dict[str, _Shard] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, data, offsets in text_slices(batch.column(1)):
                raw, bounds = data.tobytes(), offsets.tolist()
                texts: dict[str, list[bytes]] = {}
                for i in range(len(bounds) - 1):
                    texts.setdefault(langs[at + i], []).append(raw[bounds[i] : bounds[i + 1]])
                for lang, own in texts.items():
                    shard = held.setdefault(lang, _Shard())
                    shard.add(own)
                    if shard.full():
                        yield from arrow_table(held.pop(lang).rows(lang, bits), _SHARDS).to_batches()
        for lang, shard in held.items():
            yield from arrow_table(shard.rows(lang, bits), _SHARDS).to_batches()

    return run


def _numbers(n: int, block: int, bits: int) -> np.ndarray:
    """Numbers from 1 of a block's n frequent keys, that no other block gives."""
    ids = (np.arange(n, dtype=np.uint64) << np.uint64(bits)) + np.uint64(block + 1)
    if n and int(ids[-1]) >= 1 << 32:
        raise OverflowError("too many frequent phrases for numbers of 32 bits")
    return ids


def _merge_words(least: int, bits: int):
    """Answers and frequent words of one block."""

    def run(table):
        trim()
        rows = table.to_pylist()
        lang, block = rows[0]["lang"], rows[0]["block"]
        total: dict[bytes, int] = {}
        for r in rows:
            for w, c in zip(r["data"].split(b"\n"), np.frombuffer(r["counts"], "<u4").tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        often = sorted(w for w, c in total.items() if c >= least)
        ids = dict(zip(often, _numbers(len(often), block, bits).tolist(), strict=True))
        out = []
        for r in rows:
            words = r["data"].split(b"\n")
            out.append((lang, r["shard"], block, np.fromiter((ids.get(w, 0) for w in words), "<u4", len(words)).tobytes(), None, None, None, None, None))
        out += [(lang, None, block, None, i, None, None, w.decode(), total[w]) for w, i in ids.items()]
        return arrow_table(out, _MERGED)

    return run


def _merge_filters(least: int, bits: int):
    """Answers and frequent pairs of one block."""

    def run(table):
        trim()
        rows = table.to_pylist()
        lang, block = rows[0]["lang"], rows[0]["block"]
        own = [quotient.from_bytes(r["data"], block, bits) for r in rows]
        keys, counts = quotient.merge(own)
        often = counts >= least
        keys, counts = keys[often], counts[often]
        ids = _numbers(len(keys), block, bits)
        out = []
        for r, (k, _) in zip(rows, own, strict=True):
            answer = np.zeros(len(k), "<u4")
            if len(keys):
                at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
                same = keys[at] == k
                answer[same] = ids[at[same]]
            out.append((lang, r["shard"], block, answer.tobytes(), None, None, None, None, None))
        pairs = quotient.restore(keys)
        out += [(lang, None, block, None, i, h, t, None, c) for i, h, t, c in zip(ids.tolist(), (pairs >> np.uint64(32)).tolist(), (pairs & np.uint64(2**32 - 1)).tolist(), counts.tolist(), strict=True)]
        return arrow_table(out, _MERGED)

    return run


def _grow(bits: int):
    """A shard's next level from its codes and the answers to it."""

    def run(table):
        trim()
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        lang, own = rows[0]["lang"], rows[0]["shard"]
        codes = np.frombuffer(rows[0]["data"], "<i4")
        answers = np.concatenate([np.zeros(1, "<u4"), *[np.frombuffer(r["data"], "<u4") for r in rows[1:]]])
        parts = answers[codes + 1].astype(np.uint64)
        if len(parts) < 2:
            return arrow_table([], _SHARDS)
        both = (parts[:-1] > 0) & (parts[1:] > 0)
        permuted, places, counts = np.unique(quotient.permute(parts[:-1][both] << np.uint64(32) | parts[1:][both]), return_inverse=True, return_counts=True)
        if not len(permuted):
            return arrow_table([], _SHARDS)
        codes = np.full(len(both), -1, np.int32)
        codes[both] = places
        out = [(lang, own, -1, without_repeats(codes).tobytes(), b"", 0)]
        blocks, ends = quotient.block_bounds(permuted, bits)
        for b, a, e in zip(blocks.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out.append((lang, own, b, quotient.to_bytes(permuted[a:e], counts[a:e], bits), b"", 0))
        return arrow_table(out, _SHARDS)

    return run


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, lang: str = "lang", text: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all words counted, and for k = 1 .. longest the phrases of k words that occur ``least`` times.

    Phrases of one word have lang, id, word, f; longer ones lang, id, head, tail, f,
    where head and tail are the ids of the first and the last k-1 words.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = quotient.block_bits(size, BLOCK)
    shards = checkpointed(rows.mapInArrow(_shards(bits), _SHARDS), small=True)
    totals = checkpointed(shards.filter("block < 0").groupBy("lang").agg(F.sum("words").alias("n")))
    levels = []
    for k in range(1, longest + 1):
        merge = _merge_words(least, bits) if k == 1 else _merge_filters(least, bits)
        merged = checkpointed(shards.filter("block >= 0").select("lang", "shard", "block", "data", "counts").groupBy("lang", "block").applyInArrow(merge, _MERGED), small=True)
        phrases = merged.filter("shard IS NULL")
        levels.append(checkpointed(phrases.select("lang", "id", "word", "f") if k == 1 else phrases.select("lang", "id", "head", "tail", "f")))
        if k < longest:
            both = shards.filter("block < 0").select("lang", "shard", "block", "data").unionByName(merged.filter("shard IS NOT NULL").select("lang", "shard", "block", "data"))
            longer = checkpointed(both.groupBy("shard").applyInArrow(_grow(bits), _SHARDS), small=True)
        discard(shards, merged)
        if k < longest:
            shards = longer
    return totals, levels


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    A phrase occurs a >= ``least`` times.  Cut after k words, its parts occur l and
    r times, and the score is floor(1000 * a * n / (l * r)), exact in decimals of 38
    digits; the cut of the lowest score counts, then that of the smallest k.  A
    phrase inside a longer one that occurs at least ``share`` per cent as often is
    dropped; the phrases one word longer decide that, as still longer ones occur
    no more often.  Ties: a descending, then the phrase in byte order.
    """
    totals, levels = frequent_phrases(docs, least, longest, lang, text)
    none = F.array().cast("array<bigint>")
    known = levels[0].select("lang", "id", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("heads"), none.alias("tails"), "f")
    found = []
    for k in range(2, longest + 1):
        head = known.select("lang", F.col("id").alias("head"), F.col("phrase").alias("begin"), F.array_append("heads", F.col("f")).alias("heads"))
        tail = known.select("lang", F.col("id").alias("tail"), F.col("last"), F.array_append("tails", F.col("f")).alias("tails"))
        longer = levels[k - 1].join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
        longer = checkpointed(longer.select("lang", "id", "head", "tail", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "heads", "tails", "f"))
        if k > 2:
            inside = longer.select("lang", F.explode(F.array("head", "tail")).alias("id"), F.col("f").alias("more")).groupBy("lang", "id").agg(F.max("more").alias("more"))
            found.append(known.join(inside, ["lang", "id"], "left").filter(F.expr(f"more IS NULL OR 100 * more < {int(share)} * f")).select("lang", "phrase", "heads", "tails", "f"))
        known = longer
    found.append(known.select("lang", "phrase", "heads", "tails", "f"))
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    cut = "named_struct('score', (CAST(1000 AS DECIMAL(4,0)) * CAST(f AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(heads[k - 1] AS DECIMAL(19,0)) * CAST(tails[size(heads) - k] AS DECIMAL(19,0))), 'k', k, 'l', heads[k - 1], 'r', tails[size(heads) - k])"
    scored = phrases.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", F.expr(f"array_min(transform(sequence(1, size(heads)), k -> {cut}))").alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
