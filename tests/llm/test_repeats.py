import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cleanlane.llm import repeats
from cleanlane.llm.common import table
from cleanlane.llm.suffixes import suffix_array


def brute_force(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    counts = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    for (doc, _), raw in zip(rows, raws, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        left = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        yield doc, len(raw), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(left).hexdigest()


def test_suffix_array_like_sorting():
    rng = random.Random(1)
    for _ in range(3000):
        s = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 30))] + [0]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    for s in ([1] * 3000, [1, 2] * 1500, list(range(1, 3000)), list(range(3000, 0, -1))):
        assert suffix_array([*s, 0])[0] == len(s) and sorted(suffix_array([*s, 0])) == list(range(len(s) + 1))


def texts(rng, letters="abcdefghij "):
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [word(n) for n in (399, 400, 401, 450, 700, 1500)] + ["é" * 300]
    out = [None, "", word(399), word(1000), "x" * 900, "ab" * 350, "x" * 400]
    for _ in range(40):
        out.append("".join(rng.choice([*passages, word(rng.randint(0, 300))]) for _ in range(rng.randint(1, 4))))
    edited = [list(passages[5]) for _ in range(12)]
    for e in edited:
        for _ in range(rng.randint(1, 4)):
            e[rng.randrange(len(e))] = rng.choice("XY\x00é")
    return [*out, *map("".join, edited), out[20], out[20], passages[4][3:], word(50) + passages[5][100:620] + word(50)]


@pytest.mark.parametrize("most,window", [(repeats.MOST, repeats.WINDOW), (1, 700)])
def test_documents_like_brute_force(frame, monkeypatch, most, window):
    monkeypatch.setattr(repeats, "MOST", most)
    monkeypatch.setattr(repeats, "WINDOW", window)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts(random.Random(most)))]
    docs = frame([(*r, "clash") for r in rows], "doc_id long, text string, BYTES string")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, repeats.removal_digests(docs).collect()), key=key) == sorted(brute_force(rows, 400), key=key)
    made = repeats.without_repeats(docs.select("doc_id", "text", "BYTES")).collect()
    assert sorted((str(r["c0"]), hashlib.sha256(r["kept"]).hexdigest()) for r in made) == sorted((str(w[0]), w[4]) for w in brute_force(rows, 400))
    assert repeats.removal_digests(docs.limit(0)).count() == 0


def test_given_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, repeats.removal_digests(docs).collect())) == sorted(brute_force(rows, 400))
