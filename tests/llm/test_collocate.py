import random
import re
from collections import Counter

import numpy as np
import pytest

from cleanlane.llm import collocate, quotient


def test_filters_are_lossless_and_merge_like_counters():
    rng = np.random.default_rng(1)
    assert (quotient.restore(quotient.permute(x := rng.integers(0, 2**64, 1000, np.uint64))) == x).all()
    for bits in (0, 3, 7):
        shards = [Counter(rng.integers(0, 300, n).tolist()) for n in (0, 1, 50, 4000, 90000)]
        blocks: dict[int, list] = {}
        for own in shards:
            keys = quotient.permute(np.array(list(own), np.uint64))
            order = np.argsort(keys)
            counts = np.array(list(own.values()), np.int64)[order]
            found, ends = quotient.block_bounds(keys[order], bits)
            for b, x, y in zip(found.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                data = quotient.to_bytes(keys[order][x:y], counts[x:y], bits)
                blocks.setdefault(b, []).append(quotient.from_bytes(data, b, bits))
                assert (blocks[b][-1][0] == keys[order][x:y]).all() and (blocks[b][-1][1] == counts[x:y]).all()
        total = Counter()
        for own in blocks.values():
            keys, counts = quotient.merge(own)
            total.update(dict(zip(quotient.restore(keys).tolist(), counts.tolist(), strict=True)))
        assert total == sum(shards, Counter())


def brute_force(rows, least, longest, top, share):
    words, counts = Counter(), {}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            own = [w for w in re.split(r"[ \t]+", piece) if w]
            words[lang] += len(own)
            for k in range(1, longest + 1):
                for i in range(len(own) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(own[i : i + k])] += 1
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in often.items():
            if any(100 * b >= share * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            yield lang, rank, p.decode(), -a, left, right, words[lang], -s


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("share", [100, 60])
def test_phrases_like_brute_force(frame, monkeypatch, small, share):
    if small:  # many shards, blocks and windows
        monkeypatch.setattr(collocate, "SHARD_WORDS", 50)
        monkeypatch.setattr(collocate, "WINDOW", 64)
        monkeypatch.setattr(collocate, "BLOCK", 100)
    rng = random.Random(2)
    some = ["a", "A", "bé", "CÉ", "d-e", "the", "of", "x\x00", "\xa0", "long" * 30, "the of a", "a a a a", "of the bé d-e a"]
    rows = [("".join(rng.choice(some) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randint(0, 80))), rng.choice(["en", "en", "en", "de", None, "und", ""])) for _ in range(120)]
    rows += [(None, "en"), ("", "fr"), (rows[0][0],) + rows[0][1:], ("a " * 3000, "en"), (" ", None)]
    docs = frame([(t, x, "clash") for t, x in rows], "text string, lang string, WORDS string")
    got = collocate.collocations(docs, 5, 5, 40, share)
    assert sorted(map(tuple, got.collect())) == sorted(brute_force(rows, 5, 5, 40, share))


def test_empty_tables_and_rare_phrases(frame):
    docs = frame([("a b c", "en")], "text string, lang string")
    assert collocate.collocations(docs).count() == 0 == collocate.collocations(docs.limit(0)).count()
