"""Near duplicates, repeated passages and benchmark passages against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from greenwave.llm import decontaminate, near_dedup, substrings


def documents(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5)))
    shared = [[word() for _ in range(30)] for _ in range(3)]
    out = []
    for k in range(n):
        if k > 5 and rng.random() < 0.5:
            words = out[rng.randrange(len(out))][1].split(" ")
            for _ in range(rng.choice([0, 1, 2, 6])):
                words[rng.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(rng.randint(3, 120))]
        if rng.random() < 0.3:
            words += rng.choice(shared)
        out.append((k, " ".join(words)))
    return out


def runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(frame, seed):
    docs = documents(seed)
    group = {d: d for d, _ in docs}
    sets = {d: runs(t) for d, t in docs}
    text = dict(docs)
    changed = True
    while changed:
        changed = False
        for a in group:
            for b in group:
                x, y = sets[a], sets[b]
                both = sum((x & y).values())
                if text[a] == text[b] or both and both >= 0.8 * (sum(x.values()) + sum(y.values()) - both):
                    low = min(group[a], group[b])
                    changed |= group[a] != low or group[b] != low
                    group[a] = group[b] = low
    got = {r.doc_id: r.class_id for r in near_dedup.classes(frame(docs, "doc_id long, text string")).collect()}
    assert got == group and len(set(group.values())) < len(docs)


def test_signatures_estimate_similarity():
    texts = [" ".join(f"a{k}" for k in range(n, n + 500)) for n in range(0, 300, 50)]
    units, counts = near_dedup.elements(texts)
    best = near_dedup.signatures(units, counts, 400)
    for k in range(1, len(texts)):
        overlap = 496 - 50 * k
        assert abs((best[0] == best[k]).mean() - overlap / (992 - overlap)) < 0.1


def test_near_duplicates_of_odd_rows(odd, none):
    rows = near_dedup.classes(odd).collect()
    assert len(rows) == odd.count() and near_dedup.classes(none).count() == 0
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.class_id)
    assert by[4] == by[5] == {4} and by[6] == {4, 6} and by[None] == {0, 4} and by[8] == by[9] == {8} and by[1] == {0}
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4, 6, 7, 8, 10, 11]
    assert near_dedup.keep_first(none).count() == 0


def removed(docs, window):
    seen, flags = set(), {}
    for d, t in sorted(docs):
        words = (t or "").split(" ")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                gone[i:i + window] = [True] * window
            seen.add(w)
        flags[d] = (sum(gone), hashlib.sha256(" ".join(x for x, g in zip(words, gone) if not g).encode()).hexdigest())
    return flags


@pytest.mark.parametrize("seed,hot", [(1, 10_000), (2, 2), (3, 0), (4, 1)])
def test_passages_equal_brute_force(frame, seed, hot):
    docs = documents(seed) + [(100, " ".join(["for"] * 90)), (101, "x " + " ".join(["for", "you"] * 40))]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.removal(frame(docs, "doc_id long, text string"), 20, hot).collect()}
    assert got == removed(docs, 20) and any(n for n, _ in got.values())


def test_passages_of_odd_rows(odd, none):
    rows = substrings.removal(odd).collect()
    assert len(rows) == odd.count() and substrings.removal(none).count() == 0
    gone = defaultdict(set)
    for r in rows:
        gone[r.doc_id].add(r.n_removed)
    assert gone[None] == {0} and gone[4] == {80} and gone[5] == {80} and gone[6] == {80, 0} and gone[1] == {0}
    out = substrings.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert {r.text for r in out.where("doc_id = 6").collect()} == {"tail", "other text"}


@pytest.mark.parametrize("hot", [10_000, 0])
def test_repeated_rows_keep_their_first_copy(frame, hot):
    text = lambda name: " ".join(f"{name}{k}" for k in range(30))
    again = f"{text('d')} {text('d')}"
    docs = [(1, text("a")), (1, text("a")), (1, text("a")), (2, text("b")), (2, again), (2, again), (3, text("a")), (None, text("c")), (None, text("c")), (4, text("c"))]
    schema = "doc_id long, text string"
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substrings.removal(frame(docs, schema), 20, hot).collect())
    assert got == Counter({(1, 30, 0): 3, (2, 30, 0): 1, (2, 60, 30): 2, (3, 30, 30): 1, (None, 30, 0): 2, (4, 30, 30): 1})
    assert sorted(r.text for r in substrings.without_repeats(frame(docs, schema), 20, hot).where("doc_id IS NULL OR doc_id < 3").collect()) == sorted(
        [text("a")] * 3 + [text("b")] + [text("d")] * 2 + [text("c")] * 2)


def contaminated(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    found = {}
    for d, t in docs:
        w, hit, who = words(t), set(), set()
        for i, p in items:
            q = words(p)
            for s in range(max(1, len(q) - size + 1)) if q else ():
                g = q[s:s + size]
                for a in range(len(w) - len(g) + 1):
                    if w[a:a + len(g)] == g:
                        hit.update(range(a, a + len(g)))
                        who.add(str(i))
        found[d] = (len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest())
    return found


@pytest.mark.parametrize("block", [100_000, 7])
def test_contamination_equals_brute_force(frame, block):
    rng = random.Random(4)
    word = lambda: rng.choice("abcd") * rng.randint(1, 2)
    items = [(k, " ".join(word() for _ in range(rng.choice([0, 1, 2, 3, 9, 10, 14])))) for k in range(11, 25)] + [(99, None), (100, "É a,B")]
    docs = [(k, " ".join([word() for _ in range(rng.randint(0, 300))] + rng.choice(items)[1:2][0].split() if k % 2 and items[k % 14][1] else [])) for k in range(20)]
    docs = [(k, t.upper() if k % 3 == 0 else t.replace(" ", ", ")) for k, t in docs] + [(50, None), (51, "x É A b y")]
    marked = decontaminate.mark(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), 10, block)
    got = {r.doc_id: (r["__n_words"], r.n, len(r["__items"]), hashlib.sha256(",".join(sorted(map(str, r["__items"]))).encode()).hexdigest())
           for r in marked.withColumn("n", decontaminate.n_hit()).collect()}
    assert got == contaminated(docs, items)


def test_contamination_of_odd_rows(odd, none, frame):
    items = frame([(1, "one two"), (1, "one two"), (None, "copy1")], "item_id long, text string")
    rows = decontaminate.contamination(odd, items).collect()
    assert len(rows) == odd.count() and {r.doc_id for r in rows if r.contaminated} == {8, 9}
    out = decontaminate.drop_contaminated(odd, items)
    assert out.columns == odd.columns and out.count() == odd.count() - 2
    assert not any(r.contaminated for r in decontaminate.contamination(odd, items.where("false")).collect())
    assert decontaminate.contamination(none, items).count() == 0


def test_items_without_an_id_count_in_the_queries(spark, tmp_path):
    import duckdb

    import corpus_pipeline
    from greenwave.llm import catalog

    name = lambda table: str(tmp_path / f"{table}.parquet")
    docs = [(1, "x a b y"), (2, "c d e"), (3, "a b c d"), (4, "e f"), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(name("documents"))
    spark.createDataFrame([(None, "a b"), (None, "f"), (7, "c d"), (8, "a b"), (None, None)], "item_id long, text string").write.parquet(name("benchmark"))
    got = catalog.queries()["op4_decontamination"](spark, str(tmp_path))
    with duckdb.connect() as db:
        for table in ("documents", "benchmark"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{name(table)}/*.parquet')")
        want = db.execute(decontaminate.SQL).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got.collect()} == {1: (2, 2), 2: (2, 1), 3: (4, 3), 4: (1, 1), 5: (0, 0)}
    kept = corpus_pipeline.benchmark_decontamination(spark, spark.read.parquet(name("documents")).where("doc_id > 3"), str(tmp_path))
    assert [r.doc_id for r in kept.collect()] == [5]


def test_spans_hash_by_content():
    data = np.frombuffer(b"abc abd abc  abc", np.uint8)
    starts, ends, counts = near_dedup.word_spans(data, near_dedup._INSIDE, np.array([0, 8, 17]))
    h = near_dedup.hash_spans(data, starts, ends)
    assert counts.tolist() == [2, 2] and h[0] == h[2] == h[3] != h[1]
