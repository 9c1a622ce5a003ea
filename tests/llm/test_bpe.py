import hashlib
import random

import numpy as np
import pytest

from cleanlane.llm import bpe
from cleanlane.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()

    def run(text):
        ids = t.encode(text or "", add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes(), t.decode(ids, skip_special_tokens=False).encode()

    return run


def test_any_cuts_give_the_library_result(library):
    rng = random.Random(1)
    some = ["a", "B", "é", "e\u0301", " ", "\n", "\u00a0", "\x1c", "<|endoftext|>", "<|startof", "text|>", "'s", "'S", "1", "23", "!", "—", "漢", "\x85", "x" * 50, "\x00", "ﬁ", "İ", "\u200d", "👍🏽"]
    own = bpe.Encoder(PATH)
    for _ in range(1500):
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))
        raw = text.encode()
        at = sorted({i for i in rng.sample(range(len(raw) + 1), min(len(raw), rng.randint(0, 6))) if i < len(raw) and raw[i] & 0xC0 != 0x80} | {0, len(raw)})
        chunks = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True) if b > a]
        assert own.text(chunks, {}) == library(text)


def test_chunks_follow_the_content():
    rng = np.random.default_rng(1)
    passage = bytes(rng.integers(97, 123, 20000).astype(np.uint8))
    texts = [b"", passage, b"x" * 777 + passage, "é".encode() * 40000, b"y"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    got = list(bpe.chunks_of(data, offsets))
    assert [b"".join(c) for c in got] == texts
    assert len(set(got[1]) & set(got[2])) >= len(got[1]) - 3 and len(got[1]) > 10
    assert max(map(len, got[3])) <= bpe.MOST + 4 and all(c.decode() for c in got[3])


@pytest.mark.parametrize("limit", [bpe.DICTIONARY, 0])
def test_documents_like_the_library(frame, library, limit):
    rng = random.Random(2)
    passage = " ".join(rng.choice(["the", "Größe", "words", "unusualword", "x1"]) for _ in range(900))
    rows = [(1, "a " + passage), (2, passage + " zz"), (2, passage + " zz"), (3, None), (None, ""), (4, "w" * 200000), (5, passage[7:5000] + passage)]
    docs = frame([(*r, "clash") for r in rows], "doc_id long, text string, IDS string")
    made = bpe.encode(docs.select("doc_id", "text"), PATH, limit=limit).collect()
    assert sorted((str(r["c0"]), bytes(r["ids"]), r["decoded"]) for r in made) == sorted((str(i), library(t)[0], library(t)[1].decode()) for i, t in rows)
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def test_shared_chunks_are_in_the_dictionary(frame):
    passage = " ".join(f"w{i * i}" for i in range(1500))
    docs = frame([(i, f"{i} {passage} {i}") for i in range(6)], "doc_id long, text string")
    shared = bpe.shared_chunks(docs, PATH)
    assert sum(map(len, shared)) > 0.7 * len(passage)
    assert sum(map(len, bpe.shared_chunks(docs, PATH, limit=4000))) <= 4000
    once = bpe.digests(docs, PATH).collect()
    assert len({r["ids_sha256"] for r in once}) == 6 and all(len(r["decoded_sha256"]) == len(hashlib.sha256().hexdigest()) for r in once)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.check_tokenizer(f"{TOKENIZERS}/byte_bpe_50k.json")
