"""Token files, packing and token counts against the libraries."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from greenwave.llm import packing, token_counts, token_files
from greenwave.session import new_table_path

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def encoded(df, path, end):
    tok = Tokenizer.from_file(path)
    return [(r.doc_id, np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [end], "<u4")) for r in df.collect()]


def crc(ids):
    return zlib.crc32(ids.tobytes())


def test_token_files_hold_every_text_in_order(spark, odd, none):
    folder = new_table_path(spark, "test-tokens")
    token_files.write_tokens(odd, folder, BYTES, 2)
    got = token_files.token_index(spark, folder).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((d or -1, len(x), crc(x)) for d, x in encoded(odd, BYTES, 2))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    named = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert named == sorted(named)
    found = token_files.read_tokens(spark, folder, token_files.F.col("doc_id") == 8)
    assert [len(r.ids) for r in found.collect()] == [len(x) for d, x in encoded(odd, BYTES, 2) if d == 8]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,8)]" in found._jdf.queryExecution().executedPlan().toString()
    empty = new_table_path(spark, "test-tokens")
    token_files.write_tokens(none, empty, BYTES, 2)
    assert token_files.token_index(spark, empty).count() == 0


def test_repeated_ids_start_where_their_ids_lie(spark, frame):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["ab", "cde", "f", "ghij", "\u00e9"], rng.integers(0, 30))) for _ in range(40)]
    docs = frame([(7 if k % 4 else k if k % 8 else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    folder = new_table_path(spark, "test-tokens")
    token_files.write_tokens(docs, folder, BYTES, 2)
    files = [r.file for r in token_files.read_tokens(spark, folder).select("file").distinct().orderBy(*token_files._file_order()).collect()]
    laid = np.array([i for f in files for row in orc.read_table(f"{folder}/{f}").column("ids").to_pylist() for i in row], "<u4")
    got = token_files.token_index(spark, folder).collect()
    assert len(got) == 40 and sum(r.n_tokens for r in got) == len(laid)
    assert all(crc(laid[r.start:r.start + r.n_tokens]) == r.ids_crc32 for r in got)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((d or -1, len(x), crc(x)) for d, x in encoded(docs, BYTES, 2))


def test_files_stand_in_the_order_of_their_tasks(frame):
    names = [f"part-{n}-x.zstd.orc" for n in ("00000", "00007", "99999", "100000", "250000")]
    got = [r.file for r in frame([(n,) for n in reversed(names)], "file string").orderBy(*token_files._file_order()).collect()]
    assert got == names


def test_packing_places_every_token_once(odd, none):
    rows = packing.pack(odd, BYTES).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for x in sequences.values():
        at = 0
        for r in sorted(x, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    want = sorted((d or -1, len(x)) for d, x in encoded(odd, BYTES, 0))
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    ids = {d: x for d, x in encoded(odd.where("doc_id IN (0, 1, 2, 3, 4, 10, 11)"), BYTES, 0)}
    for r in rows:
        if r.doc_id in ids:
            assert r.ids_crc32 == crc(ids[r.doc_id][r.start:r.start + r.length])
    assert packing.pack(none, BYTES).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_windows_are_near_equal(seed):
    rng = np.random.default_rng(seed)
    sizes = [p for n in rng.integers(1, 1024, 240).tolist() for p in packing.lengths_of_pieces(n, 1024)]
    window = packing.windows_of(sizes, 1024)
    sums = np.bincount(window, sizes)
    assert sums.max() <= 1024 and sums.min() > 900 and 1 - sum(sizes) / (1024 * len(sums)) < 0.03
    assert packing.windows_of([1024, 1024, 1], 1024).tolist().count(2) <= 1


def test_counts_equal_the_library(spark, odd, none):
    tok = Tokenizer.from_file(WORDS)
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), n := len(tok.encode(r.text or "", add_special_tokens=False).ids), n > 2048) for r in odd.collect())
    for hot in (1 << 20, 4):
        got = token_counts.count_tokens(odd, WORDS, hot=hot).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts.count_tokens(none, WORDS).count() == 0


def test_new_words_are_learned_without_looking_for_cycles():
    import gc
    from greenwave.llm.tokens import Encoder

    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaoinshé"), rng.integers(2, 9))) + str(rng.choice(["", "", ".", ",", "7", "中"])) for _ in range(20_000)]
    texts = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)] + ["a\nnew line. And, more", "", None]
    enc, learn, seen = Encoder(BYTES), Encoder._learn, []
    note = lambda phase, info: seen.append(phase)

    def watched():
        gc.callbacks.append(note)
        learn(enc)
        gc.callbacks.remove(note)

    enc._learn = watched
    ids, sizes = enc.encode(texts)
    assert not seen and gc.isenabled() and len(enc.numbers) > 10_000
    tok = Tokenizer.from_file(BYTES)
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_chunk_that_repeats_in_a_batch_is_looked_up_once():
    from greenwave.llm import tokens

    class Watched(tokens._Numbers):
        asked = 0

        def __getitem__(self, chunk):
            Watched.asked += 1
            return super().__getitem__(chunk)

    texts = ["one two one two, one\ntwo " * 300 + "end", None, "", "é中 one\x00 \r x", "one", "\n", " ", "a  b", "two <|endoftext|> one"]
    enc = tokens.Encoder(BYTES)
    enc.numbers = Watched()
    tok = Tokenizer.from_file(BYTES)
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):  # new chunks, then known ones
        ids, sizes = enc.encode(texts)
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert 0 < Watched.asked < 100
    ids, sizes = enc.encode([None, ""])
    assert ids.tolist() == [] and sizes.tolist() == [0, 0]
