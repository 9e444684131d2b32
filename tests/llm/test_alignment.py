"""Token alignment against a plain walk over the bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from greenwave.llm import alignment
from greenwave.llm.tokens import BYTE_LETTERS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def brute(docs):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    back = {c: k for k, c in enumerate(BYTE_LETTERS)}
    bytes_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    found = []
    for _, text in docs:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        want = (" " + (text or "")).encode()
        if not text or b"".join(map(bytes_a, ids_a)) != want or b"".join(map(bytes_b, ids_b)) != want:
            found.append([])
            continue
        groups, i, j, x, y = [], 0, 0, 0, 0
        while i < len(ids_a):
            left, right = [], []
            while not left or x != y:
                if x <= y:
                    left.append(ids_a[i])
                    x, i = x + len(bytes_a(ids_a[i])), i + 1
                else:
                    right.append(ids_b[j])
                    y, j = y + len(bytes_b(ids_b[j])), j + 1
            groups.append((left, right))
        found.append(groups)
    linked = [Counter((p, q) for left, right in groups for p in left for q in right) for groups in found]
    n = Counter(pair for c in linked for pair in c)
    top = defaultdict(int)
    for (p, _), k in n.items():
        top[p] = max(top[p], k)
    out = []
    for (d, _), groups, c in zip(docs, found, linked, strict=True):
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((d, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(c.values()),
                    sum(k for pair, k in c.items() if n[pair] == top[pair[0]]), sum(k * n[pair] for pair, k in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def texts(seed, n=40):
    rng = random.Random(seed)
    words = ["the", "Unbelievable", "straße", "漢字かな", "naïve", "12345", "a_b", "don't", "\t", "\n\n", "  ", "😀👍", "x" * 40, "<|endoftext|>", "</s>", "<0x41>", "▁", "é́", ".", "--", "\x00"]
    return [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for k in range(n)] + [(n, None), (n + 1, ""), (n + 2, " "), (n + 3, "!" * 3000)]


@pytest.mark.parametrize("seed,common", [(1, alignment.COMMON), (2, 4), (3, 0)])
def test_alignment_equals_a_walk_over_the_bytes(frame, seed, common):
    docs = texts(seed)
    got = sorted(map(tuple, alignment.alignment(frame(docs, SCHEMA).repartition(3), A, B, common).collect()), key=str)
    want = brute(docs)
    assert got == want and any(r[3] == 0 for r in want) and any(r[1] > r[3] > 0 for r in want)


def test_pointers_end_at_the_last_token_of_a_group():
    end_a, end_b = np.array([1, 3, 5, 7, 8, 9]), np.array([2, 4, 6, 8, 9])
    last_a, last_b = alignment.terminals(end_a, end_b)
    assert last_a.tolist() == [4, 4, 4, 4, 4, 5] and last_b.tolist() == [4, 4, 4, 4, 5]
    n = 5000  # one chain of ten thousand tokens
    last_a, last_b = alignment.terminals(np.append(np.arange(1, 2 * n, 2), 2 * n), np.append(np.arange(2, 2 * n, 2), 2 * n))
    assert set(last_a.tolist()) == set(last_b.tolist()) == {n}


def test_large_groups_are_summed_by_id(frame):
    docs = [(1, "漢字" * 300), (2, "aaaa" * 500), (3, "é" * 200), (4, "one two"), (5, "漢字" * 9)]
    assert sorted(map(tuple, alignment.alignment(frame(docs, SCHEMA).coalesce(1), A, B).collect()), key=str) == brute(docs)
    table = alignment.align_packed(frame(docs, SCHEMA).coalesce(1), A, B).toArrow().combine_chunks()
    tokens = alignment.Tokens.of(table.to_batches()[0])
    found = [[x.tolist() for x in alignment.links(tokens, large)] for large in (10**9, 64, 3, 0)]
    arrays = alignment.align(frame(docs, SCHEMA), A, B).where("doc_id = 4").first()
    assert sum(arrays.a_sizes) == len(arrays.a_ids) and sum(arrays.b_sizes) == len(arrays.b_ids) and len(arrays.a_sizes) == 2
    assert found[0] == found[1] == found[2] == found[3]


def test_task_sums_may_be_handed_on_early(monkeypatch, frame):
    monkeypatch.setattr(alignment, "HELD", 16)
    docs = texts(5)
    assert sorted(map(tuple, alignment.alignment(frame(docs, SCHEMA).coalesce(1), A, B, 8).collect()), key=str) == brute(docs)


def test_odd_rows(odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted(map(tuple, alignment.alignment(odd, A, B).collect()), key=str)
    assert got == brute(docs) and alignment.alignment(none, A, B).count() == 0
