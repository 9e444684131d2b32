"""Frequent lines: brute force, both ways of marking, insertion and deletion, the filters alone."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from greenwave.llm import lines

SCHEMA = "doc_id long, text string"


def corpus(seed, n=120):
    rng = random.Random(seed)
    common = [f"Shared line {k}" for k in range(6)] + ["", "  ", "é ß", "漢字"]
    out = []
    for k in range(n):
        body = [rng.choice(common) if rng.random() < 0.4 else f"own {rng.randint(0, 400)}" for _ in range(rng.randint(0, 12))]
        out.append((k, "\n".join(rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", "\r", "  "]) for x in body)))
    return [*out, (500, None), (501, "")]


def brute(docs, known=None, min_docs=10, min_chars=1):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda line: low(line.strip(" \t\n\x0b\x0c\r"))
    split = lambda text: (text or "").split("\n")
    n = Counter(k for _, t in (docs if known is None else known) for k in {key(x) for x in split(t)})
    out = []
    for d, t in docs:
        keep = [x for x in split(t) if not (len(key(x)) >= min_chars and n[key(x)] >= min_docs)]
        out.append((d, len(split(t)), len(split(t)) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,sent,min_chars", [(1, lines.SENT, 1), (2, 0, 1), (3, 0, 4), (3, lines.SENT, 4)])
def test_removal_equals_brute_force(frame, seed, sent, min_chars):
    docs = corpus(seed)
    got = lines.removal(frame(docs, SCHEMA), 10, min_chars, sent)
    want = brute(docs, min_chars=min_chars)
    assert collected(got) == want and sum(r[2] for r in want) > 50


@pytest.mark.parametrize("keys", [lines.SHARD_KEYS, 40])
def test_insertions_and_deletions_undo_each_other(frame, monkeypatch, keys):
    monkeypatch.setattr(lines, "SHARD_KEYS", keys)
    first, second = corpus(4), [(d + 1000, t) for d, t in corpus(5, 200)]
    a, b = frame(first, SCHEMA), frame(second, SCHEMA)
    whole = lines.insert(lines.build(a), b)
    digests = lambda docs, index, sent: [(r.doc_id, r["__n_dropped"], r["__kept"]) for r in lines.mark(docs, index, sent).collect()]
    for index, known in ((whole, first + second), (lines.delete(whole, a), second), (lines.delete(whole, b), first)):
        assert (index.bits > 0) == (keys == 40)
        for sent in (lines.SENT, 0):
            got = sorted((d, n, hashlib.sha256(k.encode()).hexdigest()) for d, n, k in digests(b, index, sent))
            assert got == sorted((d, n, h) for d, _, n, h in brute(second, known))
    fresh = lines.build(b)
    undone = lines.delete(whole, a)
    assert collected(undone.counts) == collected(fresh.counts)
    assert lines.delete(undone, b).counts.isEmpty()
    with pytest.raises(Exception, match="never inserted"):
        lines.delete(fresh, a).counts.collect()


def test_filters_hold_what_was_put_in():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, (30_000, 2))
    made = lines.grown(keys[:20_000])
    one = lambda k: np.zeros(len(k), np.int64)
    assert made.holds(keys[:20_000], one(keys[:20_000])).all()
    assert made.holds(keys[20_000:], one(keys[20_000:])).mean() < 0.001
    assert 20_000 / made.slots.size > 0.4
    made.delete(keys[:15_000])
    assert np.count_nonzero(made.slots) == 5_000 and made.holds(keys[15_000:20_000], one(keys[:5_000])).all()
    assert made.insert(keys[:15_000]) and made.holds(keys[:20_000], one(keys[:20_000])).all()
    assert not lines.Cuckoo.of_size(3).insert(keys[:50])


def test_lines_taken_for_others_stay(frame):
    common = "\n".join(f"common {k}" for k in range(40))
    docs = [(d, common + "".join(f"\nown {d} {k}" for k in range(10_000))) for d in range(12)]
    index = lines.build(frame(docs, SCHEMA))
    row = index.filters.first()
    assert len(row.not_hi) == len(row.not_lo) > 0
    for sent in (lines.SENT, 0):
        assert {r["__n_dropped"] for r in lines.mark(frame(docs, SCHEMA), index, sent).collect()} == {40}


def test_odd_rows(odd, none, frame):
    for sent in (lines.SENT, 0):
        rows = lines.removal(odd, 2, sent=sent).collect()
        assert len(rows) == odd.count() and lines.removal(none, sent=sent).count() == 0
        dropped = {r.doc_id: r.n_dropped for r in rows}
        assert dropped[4] == dropped[5] == dropped[8] == 1 and dropped[0] == dropped[1] == dropped[2] == dropped[3] == 0
    out = lines.without_lines(odd, lines.build(odd, 2))
    assert out.columns == odd.columns and out.count() == odd.count()
    assert {(r.text, r.n_chars) for r in out.where("doc_id = 5").collect()} == {("", 0)}
    with pytest.raises(ValueError, match="reserved"):
        lines.mark(frame([(1, "a", 2)], "doc_id long, text string, __kept long"), lines.build(odd))
