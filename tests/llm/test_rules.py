"""Licences, shards, quality scores and host rules."""

import random
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from greenwave.llm import hilbert, host_rules, licences, quality


def test_licence_rules_match_in_order(frame, odd, none):
    bsd = ("Copyright (c) 2020 Someone.\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met: "
           "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
           "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
    texts = [(1, bsd), (2, "Words.\nReleased under the MIT License.\nMore words."), (3, "You need a license for this."), (4, "Nothing here."),
             (5, "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."), (6, "All rights reserved.")]
    got = {r.doc_id: (r.licences, r.n_known, r.n_unknown, r.n_unused) for r in licences.scan(frame(texts, "doc_id long, text string")).collect()}
    assert got == {1: ("BSD-2-Clause", 4, 0, 0), 2: ("MIT", 1, 0, 0), 3: ("", 0, 1, 0), 4: ("", 0, 0, 0), 5: ("Apache-2.0,CC-BY-NC-4.0", 2, 0, 0), 6: ("", 1, 0, 1)}
    assert licences.scan(odd).count() == odd.count() and licences.scan(none).count() == 0


GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    https://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
BSD = """Copyright (c) 2020, Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
CC = "This work is licensed under a Creative Commons {0}4.0 International\nLicense. To view a copy of this license, visit the site."


def scanned(frame, texts):
    rows = licences.scan(frame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [(r.sentences, r.licences, r.n_known, r.n_unused) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_licence_headers_wrapped_at_any_width(frame):
    narrow = lambda text, width, mark: "\n".join(mark + x for x in textwrap.wrap(" ".join(text.split()), width, break_long_words=False))
    gpl3, gpl2 = GPL.format(":", ",", 3), GPL.format(";", ";", 2)
    for number, text in ((3, gpl3), (2, gpl2)):
        forms = [text, "\r\n".join(text.split("\n")), *(narrow(text, width, mark) for width in (70, 40, 24, 1) for mark in ("", " * ", "# "))]
        assert set(scanned(frame, forms)) == {(f"Gpl{number}Later,GplCopy", f"GPL-{number}.0-or-later", 2, 0)}
    # a sentence still has to end with a part, and the shortest one counts
    assert scanned(frame, ["Licensed under the\nMIT License\nof theirs", "Licensed under the\nMIT License of theirs"]) == [("MitName", "MIT", 1, 0), ("", "", 0, 0)]


def test_whole_standard_notices(frame):
    texts = [MIT, MPL, APACHE, APACHE.replace("https", "http"), BSD + DISCLAIMER, BSD + ENDORSE + DISCLAIMER, CC.format("Attribution "), CC.format("Attribution-ShareAlike "),
             CC.format("Attribution-NonCommercial ")]
    apache, bsd = "Apache2Name,Apache2Comply,Apache2Where,Apache2Disclaim", "Copyright,BsdGrant,BsdSource,BsdBinary"
    want = [("Copyright,MitGrant,MitNotice,AsIs", "MIT", 4, 0), ("Mpl2Name", "MPL-2.0", 1, 0), (apache, "Apache-2.0", 4, 0), (apache, "Apache-2.0", 4, 0),
            (bsd, "BSD-2-Clause", 4, 0), (bsd + ",BsdEndorse", "BSD-3-Clause", 5, 0), ("CcByName", "CC-BY-4.0", 1, 0), ("CcBySaName", "CC-BY-SA-4.0", 1, 0), ("CcByNcName", "CC-BY-NC-4.0", 1, 0)]
    assert scanned(frame, texts) == want
    # each paragraph on a line, and wrapped in a comment block
    line = lambda text: "\n".join(" ".join(p.split()) for p in text.split("\n\n"))
    block = lambda text: "\n".join(" * " + x for p in text.split("\n\n") for x in textwrap.wrap(p, 40, break_long_words=False, break_on_hyphens=False))
    assert scanned(frame, map(line, texts)) == scanned(frame, map(block, texts)) == want
    # a dot that no cut follows
    assert scanned(frame, ["This Source Code Form is subject to the terms of the Mozilla Public License, v.\u00a02.0."]) == [("Mpl2Name", "MPL-2.0", 1, 0)]


def test_wrapped_hints_are_seen(frame):
    texts = ["All rights\nreserved.", "All  rights\t reserved", " * All rights\r\n * reserved.", "# This is free and unencumbered software released into the public\n# domain.", "free\nsoft ware"]
    assert scanned(frame, texts) == [("AllRights", "", 1, 1)] * 3 + [("Unlicense", "Unlicense", 1, 0), ("", "", 0, 0)]


def test_hilbert_curve_visits_neighbours(spark):
    bits, side = 2, 4
    cells = [(x, y, z) for x in range(side) for y in range(side) for z in range(side)]
    df = spark.createDataFrame(cells, "x int, y int, z int").withColumn("h", hilbert.hilbert_index([F.col(c) for c in "xyz"], bits))
    way = [(r.x, r.y, r.z) for r in sorted(df.collect(), key=lambda r: r.h)]
    assert sorted(r.h for r in df.collect()) == list(range(side**3))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(way, way[1:]))


def plain_place(cell, bits):
    """The curve's index by whole numbers: undo the excess of each bit from the top, Gray code, then bits in turn."""
    x, n = list(cell), len(cell)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                swap = (x[0] ^ x[i]) & p
                x[0], x[i] = x[0] ^ swap, x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] & (1 << b):
            turn ^= (1 << b) - 1
    return int("".join(str(((v ^ turn) >> b) & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_hilbert_index_and_runs_equal_plain_ones(frame):
    rng = random.Random(6)
    cells = [tuple(rng.randrange(32) for _ in range(3)) for _ in range(400)]
    got = frame(cells, "x int, y int, z int").withColumn("h", hilbert.hilbert_index([F.col(c) for c in "xyz"], 5)).collect()
    assert all(r.h == plain_place((r.x, r.y, r.z), 5) for r in got)
    rows = [(k, "y" * rng.randint(0, 400), rng.choice(["de", "en", None]), f"s{rng.randrange(9)}") for k in range(1003)]
    placed = hilbert.shard_documents(frame(rows, "doc_id long, text string, lang string, source string")).collect()
    way = sorted(placed, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in way] == sorted(r.hilbert for r in way)
    # row k of n lies in the shard whose share of n it falls into
    ends = [s * 1003 // 16 for s in range(17)]
    assert all(ends[r.shard] + r.slot == k and k < ends[r.shard + 1] for k, r in enumerate(way))


def test_shards_are_even_and_prunable(spark, frame, odd, none, tmp_path):
    rng = random.Random(3)
    rows = [(k if k % 50 else 7, "x" * rng.randint(0, 900), rng.choice(["de", "en", "fr", None]), rng.choice(["hot"] * 5 + [f"s{j}" for j in range(12)])) for k in range(3000)]
    docs = frame(rows, "doc_id long, text string, lang string, source string")
    placed = hilbert.shard_documents(docs).cache()
    got = placed.collect()
    counts, slots = Counter(r.shard for r in got), defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 3000 and max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 16
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((d, len(t) + 1, zlib.crc32(t.encode())) for d, t, *_ in rows)
    touched = placed.where("lang = 'de' AND source = 's3'").select("shard").distinct().count()
    assert touched <= 6
    few = hilbert.shard_documents(odd)
    assert few.count() == odd.count() and few.groupBy("shard").count().agg(F.max("count")).first()[0] == 1
    assert hilbert.shard_documents(none).count() == 0
    hilbert.write_shards(docs, str(tmp_path / "shards"))
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert {r.shard: r["count"] for r in written.groupBy("shard").count().collect()} == counts


def test_written_shards_keep_rows_and_clashing_names(spark, odd, none, tmp_path):
    docs = odd.withColumn("shard", F.lit("mine")).withColumn("shard_in", F.lit(5)).withColumn("__nth", F.col("n_chars"))
    hilbert.write_shards(docs, str(tmp_path / "odd"), 3)
    back = spark.read.parquet(str(tmp_path / "odd"))
    assert set(back.columns) == {*odd.columns, "shard", "shard_in", "shard_in_in", "__nth"}
    names = [*odd.columns, "__nth", "shard_in"]
    plain = lambda df: sorted(map(repr, df.select(*names).collect()))
    assert plain(back) == plain(docs) and {r[0] for r in back.select("shard_in_in").collect()} == {"mine"}
    want = Counter(r.shard for r in hilbert.shard_documents(odd, 3).collect())
    assert Counter(r.shard for r in back.select("shard").collect()) == want
    hilbert.write_shards(none, str(tmp_path / "none"), 3)


def test_rules_learn_what_labels_mark(frame, odd, none):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("etaoinsh") for _ in range(rng.randint(1, 8)))
    good = lambda: " ".join(word() for _ in range(120)) + "."
    bad = lambda: " ".join([word()] * 100) if rng.random() < 0.5 else " ".join(word() + "###" for _ in range(90))
    rows = [(k, good() if k % 4 else bad()) for k in range(600)]
    docs = frame(rows, "doc_id long, text string")
    labels = frame([(k, int(k % 4 > 0)) for k in range(600)], "doc_id long, quality int")
    got = quality.scores(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 60 and sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) / len(held) > 0.97
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.scores(docs, flipped).collect()} == {r.doc_id: r.score for r in got}
    rows = quality.scores(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == pytest.approx(0.5) for r in quality.scores(odd, labels.where("false")).collect())
    assert quality.scores(none, labels).count() == 0
    assert quality.drop_rejected(odd, labels.where("false")).columns == odd.columns


def test_paths_of_a_printed_tree():
    tree = "Model\n  If (feature 0 <= 1.5)\n   If (feature 0 <= 1.0)\n    Predict: 0.0\n   Else (feature 0 > 1.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    f = quality.FEATURES[0]
    assert quality.paths(tree) == {((f, "<=", 1.5),), ((f, "<=", 1.0),), ((f, "<=", 1.5), (f, ">", 1.0)), ((f, ">", 1.5),)}


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_host_rules(frame, odd, none):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(["a", "bb", "c#", "d\n", "e"]) for _ in range(rng.randint(0, 90))), "h") for k in range(150)]
    for r in host_rules.judge(frame(rows, "doc_id long, text string, source string")).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(rows[r.doc_id][1])
    fine = lambda: " ".join(f"{rng.random():.9f}" for _ in range(60))
    hosts = [(k, fine() if k % 10 else "short", "good") for k in range(100)] + [(100 + k, "short" if k % 10 else fine(), "bad") for k in range(100)] + [(300, "short", "tiny"), (301, fine(), None)]
    got = {r.doc_id: r for r in host_rules.judge(frame(hosts, "doc_id long, text string, source string")).collect()}
    assert all(got[k].kept == (k % 10 > 0) for k in range(100)) and not any(got[100 + k].kept for k in range(100)) and got[301].kept
    assert host_rules.judge(odd).count() == odd.count() and host_rules.judge(none).count() == 0


def test_host_verdicts_decide_rows(frame, tmp_path):
    """Hosts that fail one rule much more often than all do lose their good rows too; the SQL and plain Python agree."""
    rng = random.Random(11)
    fine = lambda: " ".join(f"{rng.random():.9f}" for _ in range(60))
    bad = {"short": lambda: "short", "symbols": lambda: fine() + " " + "#" * 200, "dup_lines": lambda: "\n".join(["x"] * 30 + fine().split()),
           "repeats": lambda: " ".join(["one two three four"] * 20)}
    rows = []
    for host, n, rates in (("big", 700, {}), ("mixed", 300, {"symbols": 0.08, "short": 0.1}), ("symbols", 120, {"symbols": 0.4}), ("lines", 150, {"dup_lines": 0.5, "short": 0.02}),
                           ("both", 200, {"repeats": 0.45, "symbols": 0.45}), ("tiny", 2, {"symbols": 1.0}), ("empty", 90, {"short": 0.7}), (None, 60, {"repeats": 0.05})):
        for k in range(n):
            share, text = k / n, fine()
            for rule, rate in rates.items():
                if 0 <= share < rate:
                    text = bad[rule]()
                share -= rate
            rows.append((len(rows), text, host))
    got = {r.doc_id: r for r in host_rules.judge(frame(rows, "doc_id long, text string, source string")).collect()}
    of = {h: {got[d].host_rules for d, _, x in rows if x == h} for h in {x for *_, x in rows}}
    assert of == {"big": {""}, "mixed": {""}, "symbols": {"symbols"}, "lines": {"dup_lines"}, "both": {"repeats,symbols"},
                  "tiny": {""}, "empty": {"short"}, None: {""}}
    decided = [d for d, r in got.items() if not r.base_failed and not r.kept]
    assert len(decided) > 150 and all(r.kept == (not r.base_failed and r.host_rules == "") for r in got.values())

    flags = {d: (10 * r.n_dup_lines > 3 * len([x for x in t.split("\n") if x.strip()]), 100 * r.n_repeat_words > 50 * r.n_words, r.n_words < 50, 10 * r.n_symbols > r.word_chars) for d, t, _ in rows for r in [got[d]]}
    for i, rule in enumerate(("dup_lines", "repeats", "short", "symbols")):
        by = defaultdict(list)
        for d, _, h in rows:
            by[h].append(flags[d][i])
        n, f = len(rows), sum(map(sum, by.values()))
        m = f / n
        v = sum(sum(x) ** 2 / len(x) for x in by.values()) / n - m * m - m * (1 - m) * len(by) / n
        w = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1e6
        for h, x in by.items():
            rate = (sum(x) + m * w) / (len(x) + w)
            rejected = rate - 3 * (rate * (1 - rate) / (len(x) + w + 1)) ** 0.5 > max(0.2, min(0.5, 2 * m))
            assert rejected == (rule in next(iter(of[h])).split(","))

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rules"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({host_rules.SQL})").fetchall()
    assert sorted(want) == sorted(tuple(r[c] for c in names) for r in got.values())
