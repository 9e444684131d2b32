"""Source divergence against exact sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from greenwave.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(docs, top=200, min_docs=3):
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    words = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(text or ""))) for _, text, lang, source in docs]
    in_docs, n, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, w in words:
        in_docs[lang].update(set(w))
        n[lang, source].update(w)
        whole[lang].update(w)
    out = []
    for lang, source in n:
        kept = [t for t, k in in_docs[lang].items() if k >= min_docs]
        share = lambda c, t, kept=kept: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept))
        excess = lambda p, q: (p - q) ** 2 // q
        mine = {t: share(n[lang, source], t) for t in kept}
        pairs = [(sum(excess(mine[t], share(n[lang, s], t)) for t in kept), s) for g, s in n if g == lang and s != source]
        of_lang = {t: share(whole[lang], t) for t in kept}
        terms = [(excess(mine[t], of_lang[t]), t) for t in kept if n[lang, source][t] and mine[t] > of_lang[t]]
        for part, found, most in (("pair", pairs, 10**9), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def corpus(seed, n=150, sources=9):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "été", "ÉTÉ", "漢字", "b2b", "x_y"] + ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    weight = {s: [rng.random() ** 4 for _ in vocabulary] for s in range(sources)}
    docs = [(k, " ".join(rng.choices(vocabulary, weight[s], k=rng.randint(0, 40))), rng.choice(["en", "fr", None]), None if s == 0 else f"s{s}")
            for k in range(n) for s in [rng.randrange(sources)]]
    return docs + [(n, None, "en", "mute"), (n + 1, "### 12", "en", "mute2"), (n + 2, "once", "xx", "a"), (n + 3, "", "xx", "b"), (n + 4, None, "yy", None), (n + 5, "q q q", None, None)]


@pytest.mark.parametrize("seed,cells,stripe", [(1, divergence.CELLS, divergence.STRIPE), (2, 40, divergence.STRIPE), (3, 20, 2), (4, 1, 1), (5, 100, 3)])
def test_audit_equals_sums_over_all_terms(frame, seed, cells, stripe):
    docs = corpus(seed)
    got = sorted(map(tuple, divergence.audit(frame(docs, SCHEMA).repartition(3), top=20, cells=cells, stripe=stripe).collect()))
    assert got == brute(docs, top=20) and len({r[0] for r in got}) == 4


def test_ties_stand_in_the_order_of_bytes(frame):
    docs = [(k, "zé zz z\U0001f600 z￮", "en", f"s{k % 2}") for k in range(6)] + [(9, "other " * 30, "en", f"s{k}") for k in range(3)]
    assert sorted(map(tuple, divergence.audit(frame(docs, SCHEMA)).collect())) == brute(docs)


def test_equal_subtrees_are_one_node():
    counts = np.zeros((5, 1000), np.int64)
    counts[3, 17], counts[4] = 2, counts[3]
    trees = divergence.Trees(counts)
    assert trees.roots[0] == trees.roots[1] == trees.roots[2] and trees.roots[3] == trees.roots[4] != trees.roots[0]
    assert sum(map(len, trees.children)) <= 4 * len(trees.children)  # of 4,995 inner nodes
    task, x, y, times = trees.meet(np.array([0, 3, 0]), np.array([1, 4, 3]))
    assert sorted(zip(task.tolist(), x.tolist(), y.tolist(), times.tolist(), strict=True)) == [
        (0, 0, 0, 1000), (1, 0, 0, 999), (1, 2, 2, 1), (2, 0, 0, 999), (2, 0, 2, 1)]


def test_shares_are_exact():
    rng = random.Random(1)
    n = [0, 1, 10**14, *[rng.randrange(10**rng.randint(1, 14)) for _ in range(200)]]
    total = [k + rng.randrange(1, 10**rng.randint(1, 15)) for k in n]
    assert divergence.shares(np.array(n), np.array(total)).tolist() == [1 + 10**9 * (a + 1) // b for a, b in zip(n, total, strict=True)]


def test_tasks_may_hand_counts_on_early(frame, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    docs = corpus(6, 40)
    assert sorted(map(tuple, divergence.audit(frame(docs, SCHEMA).coalesce(1)).collect())) == brute(docs)


def test_odd_rows(odd, none):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
    assert sorted(map(tuple, divergence.audit(odd).collect())) == brute(docs)
    assert divergence.audit(none).count() == 0
