import hashlib
import random
import re

import pytest

from cleanlane.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    wins = {}
    for item, text in items:
        w = words(text)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[a : a + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for win, ids in wins.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(["a", "b", "Ça", "d1", "é"]) for _ in range(n)]
    items = [(i if i % 7 else None, rng.choice([" ", ".\n"]).join(some(rng.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, items[2][1]), (99, items[2][1]), (5, None), (100, "the the the the the the the the the the the")]
    docs = []
    for i in range(40):
        w = some(rng.randint(0, 60))
        if i % 3 == 0:
            w[5:5] = words(items[i % len(items)][1])
        docs.append((i, rng.choice([" ", "-", "\u00a0 "]).join(w)))
    return [*docs, (None, None), (7, ""), (8, "the " * 400), (8, "the " * 400), (9, "\x00 \x7f !?")], items


@pytest.mark.parametrize("blocks", [200_000, 20])
def test_like_brute_force(frame, blocks):
    docs, items = corpus(1)
    out = decontam.contamination(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), window=10, block_pairs=blocks)
    assert sorted(map(tuple, out.collect()), key=str) == brute(docs, items, 10)


def test_no_items_no_documents_other_columns(frame):
    docs = frame([(1, "a b c", 5, "x")], "doc_id long, text string, n_hit long, C0 string")
    none = frame([], "item_id long, text string")
    assert decontam.clean_documents(docs, none).columns == ["doc_id", "text", "n_hit", "C0"]
    assert decontam.contamination(docs, none).collect()[0]["n_words"] == 3
    assert decontam.contamination(docs.limit(0), frame([(1, "a b")], "item_id long, text string")).count() == 0
    assert decontam.clean_documents(docs, frame([(1, "b C")], "item_id long, text string")).count() == 0


def test_threshold_needs_that_share_of_shingles(frame):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, item.replace("one", "uno")), (3, item.replace("five", "cinco")), (4, item.replace("ten", "x"))]
    out = decontam.contamination(frame(docs, "doc_id long, text string"), frame([(1, item)], "item_id long, text string"), threshold=0.8)
    assert {r["doc_id"]: r["n_hit"] for r in out.collect()} == {1: 10, 2: 9, 3: 0, 4: 9}
