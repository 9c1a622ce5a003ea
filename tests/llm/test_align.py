import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cleanlane.llm import align
from cleanlane.llm.common import table
from cleanlane.llm.queries import TOKENIZERS

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
SOME = ["a", "word", "B", "é", " ", "  ", "\n", "\t", " ", "▁", "　", "<|endoftext|>", "<s>", "<0x41>", "'s", "1", "23", "!", "—", "漢字", "\x85", "x" * 40, "\x00", "👍🏽", " the", " of", ".\nThe"]


def brute_force(texts):
    """Rows of the contract, from whole texts and plain loops."""
    from tokenizers import Tokenizer
    import sentencepiece

    a_of = Tokenizer.from_file(A)
    a_of.encode_special_tokens = True
    b_of = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = align.byte_letters()
    names = {i: bytes(letters[c] for c in t) for t, i in a_of.get_vocab().items() if all(c in letters for c in t)}
    docs, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = [(i, names[i]) for i in a_of.encode(" " + (text or ""), add_special_tokens=False).ids] if text else []
        b = [(i, bytes([int(b_of.id_to_piece(i)[3:-1], 16)]) if b_of.is_byte(i) else b_of.id_to_piece(i).replace("▁", " ").encode()) for i in b_of.encode(text)] if text else []
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            docs.append(None)
            continue
        spans = []
        for tokens in (a, b):
            at, own = 0, []
            for i, x in tokens:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        both = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, start = [], 0
        for end in both:
            groups.append(tuple([i for i, _, e in own if start < e <= end] for own in spans))
            start = end
        counts.update(links)
        docs.append((len(a), len(b), links, groups))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    for d in docs:
        if d is None:
            yield (0, 0, 0, 0, 0, 0, "", 0)
        else:
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in d[3])
            yield (d[0], d[1], len(d[3]), len(d[2]), sum(counts[p] == best[p[1]] for p in d[2]), sum(counts[p] for p in d[2]), hashlib.sha256(said.encode()).hexdigest(), sum(len(x) * len(y) for x, y in d[3]))


def test_products_like_dense_matrices():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n, k, m = rng.integers(1, 9, 3)
        x, y = rng.random((n, k)) < 0.4, rng.random((k, m)) < 0.4
        csr = [(np.concatenate([[0], np.cumsum(z.sum(1))]), np.nonzero(z)[1]) for z in (x, y)]
        rows, columns, values = align.product(*csr, m)
        made = np.zeros((n, m), int)
        made[rows, columns] = values
        assert (made == x.astype(int) @ y.astype(int)).all()
        back = align.transpose(*csr[0], k)
        assert (back[0] == np.concatenate([[0], np.cumsum(x.sum(0))])).all() and (back[1] == np.nonzero(x.T)[1]).all()


def test_segments_encode_like_whole_texts():
    both, rng = align.Tokenizers(A, B), random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(SOME) for _ in range(rng.randint(1, 14)))
        whole, parts = both.encode(" " + text), both.encode_all(align.segments(text))
        assert "".join(align.segments(text)) == " " + text
        if whole is None:
            assert parts[4].any()
        else:
            assert [p.tolist() for p in parts[:2]] == [w.tolist() for w in whole], text
            assert [p.sum() for p in parts[2:4]] == [len(w) for w in whole] and not parts[4].any()


def test_documents_like_brute_force(frame, monkeypatch):
    rng = random.Random(4)
    texts = [None, "", " ", "▁", "the word the word", "the word the word", "x" * 3000, *["".join(rng.choice(SOME) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30))) for _ in range(60)]]
    docs = frame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, SHARD string")
    want = sorted((i, *r) for i, r in enumerate(brute_force(texts)))
    monkeypatch.setattr(align, "SHARD_BYTES", 500)
    assert sorted(map(tuple, align.alignment_digests(docs, A, B).collect())) == want
    made = {r["c0"]: r for r in align.alignments(docs.select("doc_id", "text"), A, B).collect()}
    assert all(len(made[i]["link_a"]) == w[4] and len(made[i]["a"]) == w[1] and len(set(made[i]["group_b"])) == w[3] for i, *w in [(w[0], *w) for w in want])
    assert align.alignment_digests(docs.limit(0), A, B).count() == 0


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_given_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").limit(40)
    rows = docs.collect()
    want = sorted((r["doc_id"], *b) for r, b in zip(rows, brute_force([r["text"][:3000] for r in rows]), strict=True))
    cut = spark.createDataFrame([(r["doc_id"], r["text"][:3000]) for r in rows], "doc_id long, text string")
    assert sorted(map(tuple, align.alignment_digests(cut, A, B).collect())) == want


def test_pieces_across_spaces_are_refused():
    with pytest.raises(ValueError):
        align.check_pieces([b" a", b"a b"])


def test_tasks_get_record_batches_of_bounded_size(spark):
    import pyarrow as pa

    from cleanlane.llm.common import checkpointed

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = spark.range(0, 3000, numPartitions=1).selectExpr("repeat('word ', 1000) AS text")
    got = [r["n"] for r in checkpointed(docs.mapInArrow(sizes, "n long"), small=True).collect()]
    assert sum(got) >= 15_000_000 and max(got) < 4_000_000
    assert spark.conf.get(key) == before
