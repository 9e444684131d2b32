"""Token ids of whole texts by a byte-level BPE of the tokenizers library, with a bounded memory of chunks.

The tokenizer's own rule starts a new piece at every single space or line break that stands
between two other characters.  So a text can be cut there, and each chunk (a word with its
space and punctuation) is encoded by the library once and looked up from then on.  Texts in
which white space runs together, and texts with special strings, go to the library whole.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from greenwave.llm.common import spread

_FIRST = "\x01"  # marks a chunk without a space before it
_POINTS = (",", ".")
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable, else one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)]


BYTE_LETTERS = _byte_letters()


def as_letters(text: str) -> str:
    if text.isascii() and text.isalpha():
        return text
    return "".join(map(BYTE_LETTERS.__getitem__, text.encode("utf-8", "surrogatepass")))


@contextmanager
def _no_cycles() -> Iterator[None]:
    """For steps that make very many small objects and no cycles: the search for cycles waits until they are done."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class _Numbers(dict):
    """Chunk -> number, counted up as new chunks come."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


class Encoder:
    """At most about ``most`` chunks are kept; when there are more, the less used half goes."""

    def __init__(self, path: str, most: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self.numbers = _Numbers()
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)  # -1: the text must be encoded whole
        self.uses = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0
        self.line_break = self._ids("\n")[0]
        self.points = {c: self._ids(c)[0] for c in _POINTS}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self) -> None:
        """Encode the new chunks, many in one text with a line break between them, which is a piece and an id of its own there."""
        new, self.numbers.new = self.numbers.new, []
        known = len(self.numbers) - len(new)
        usual, texts, ended, odd = [], [], [], []
        words, sizes, flat = [], [], []  # chunks of one piece, how many ids each has, and all of those ids
        tokenize, space = self.model.tokenize, BYTE_LETTERS[0x20]
        for n, c in enumerate(new, known):  # the list may grow on the way
            if c.isascii() and c.isalpha():  # the usual word, one piece
                got = tokenize(space + c)
                words.append(n)
                sizes.append(len(got))
                flat += [t.id for t in got]
                continue
            if c[-1:] in _POINTS and c[-2:-1].isalnum():  # a point after a letter or digit is a piece of its own
                ended.append((n, self.numbers[c[:-1]], self.points[c[-1]]))
                new.extend(self.numbers.new)
                self.numbers.new.clear()
                continue
            bare = c[1:] if c[:1] == _FIRST else c
            if c == "\n" or not bare:
                odd.append((n, "\n" if c == "\n" else "" if c else " "))
            elif bare.isalpha() and (bare.isascii() or max(bare) < "\u0250"):  # one piece
                letters = bare if bare.isascii() else as_letters(bare)
                ids = [t.id for t in tokenize(letters if c[:1] == _FIRST else space + letters)]
                words.append(n)
                sizes.append(len(ids))
                flat += ids
            elif not (bare[0].isspace() or bare[-1].isspace() or "\n" in bare):
                usual.append(n)
                texts.append(bare if c[:1] == _FIRST else " " + c)
        while len(self.start) < len(self.numbers):
            self.start, self.length, self.uses = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.uses))
        self.length[known:known + len(new)] = -1
        for n, text in odd:
            self._keep(np.array([n]), np.array(self._ids(text), np.uint32), None)
        if words:
            which, lengths, first = np.array(words), np.array(sizes), self.used
            self._keep(which[:0], np.array(flat, np.uint32), None)
            self.start[which], self.length[which] = first + np.cumsum(lengths) - lengths, lengths
        many = 2000
        groups = ["\n".join(texts[k:k + many]) for k in range(0, len(texts), many)]
        for k, got in enumerate(self.tokenizer.encode_batch_fast(groups, add_special_tokens=False)):
            ids = np.array(got.ids, np.uint32)
            self._keep(np.array(usual[k * many:(k + 1) * many]), ids, np.flatnonzero(ids == self.line_break))
        if ended:
            which, core, point = (np.array(x) for x in zip(*ended, strict=True))
            right = self.length[core] >= 0
            which, core, point = which[right], core[right], point[right]
            sizes = self.length[core]
            ids = np.insert(self.ids[spread(self.start[core], sizes)], np.cumsum(sizes), point.astype(np.uint32))
            first = self.used
            self._keep(which[:0], ids, None)
            self.start[which] = first + np.cumsum(sizes + 1) - sizes - 1
            self.length[which] = sizes + 1

    def _keep(self, which: np.ndarray, ids: np.ndarray, breaks: np.ndarray | None) -> None:
        """Store the ids of the chunks ``which``, which stand between the ``breaks``."""
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        if len(which):
            edges = np.concatenate([[-1], [] if breaks is None else breaks, [len(ids)]]).astype(np.int64)
            self.start[which] = self.used + edges[:-1] + 1
            self.length[which] = np.diff(edges) - 1
        self.used += len(ids)

    def _trim(self) -> None:
        n = len(self.numbers)
        if n <= self.most:
            return
        kept = np.argsort(-self.uses[:n], kind="stable")[: self.most // 2]
        chunks = list(self.numbers)
        self.numbers = _Numbers()
        self.numbers.update((chunks[k], i) for i, k in enumerate(kept.tolist()))
        sizes = np.maximum(self.length[kept], 0)
        ids = self.ids[spread(self.start[kept], sizes)]
        self.start[:len(kept)], self.length[:len(kept)] = np.cumsum(sizes) - sizes, self.length[kept]
        self.uses[:len(kept)], self.uses[len(kept):] = self.uses[kept] // 2, 0
        self.ids[:len(ids)], self.used = ids, len(ids)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """By the library alone; very long texts are cut between two letters' single space, which changes no id."""
        out = []
        for text in texts:
            parts, at = [], 0
            while len(text) - at > 1 << 19 and (m := _SAFE_CUT.search(text, at + (1 << 18))):
                parts.append(text[at:m.start()])
                at = m.start()
            parts.append(text[at:])
            out.append(np.concatenate([np.array(self._ids(p), np.uint32) for p in parts]))
        return out

    def _numbered(self, marked: list[str]) -> np.ndarray:
        """The numbers of all chunks, one text after another.  Each different chunk of the batch is looked up once."""
        if not marked:
            return np.zeros(0, np.int64)
        chunks = pc.split_pattern(pa.array([" ".join(marked)], pa.large_string()), " ").values.dictionary_encode()
        different = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        return np.fromiter(map(self.numbers.__getitem__, different), np.int64, len(different))[chunks.indices.to_numpy()]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All the ids, one text after another, and how many each text has; null is empty."""
        self._trim()
        marked: list[str] = []
        counts, slow = np.zeros(len(texts), np.int64), []
        for k, t in enumerate(texts):
            if not t:
                continue
            if "  " in t or "\n\n" in t or " \n" in t or "\n " in t or _FIRST in t or "<|" in t:
                slow.append(k)
                continue
            marked.append(_FIRST + t.replace("\n", " \n " + _FIRST))
            counts[k] = marked[-1].count(" ") + 1
        which = self._numbered(marked)
        if self.numbers.new:
            with _no_cycles():
                self._learn()
        self.uses += np.bincount(which, minlength=len(self.uses))
        lengths = self.length[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        if len(which) and lengths.min() < 0:
            odd = np.unique(np.searchsorted(ends, np.flatnonzero(lengths < 0), "right") - 1).tolist()
            slow += odd
            keep = np.ones(len(which), bool)
            for k in odd:
                keep[ends[k]:ends[k + 1]] = False
                counts[k] = 0
            which, lengths = which[keep], lengths[keep]
            ends = np.concatenate([[0], np.cumsum(counts)])
        total = np.concatenate([[0], np.cumsum(lengths)])
        sizes = np.diff(total[ends])
        ids = self.ids[spread(self.start[which], lengths)]
        if slow:
            found = dict(zip(slow, self.whole([texts[k] for k in slow]), strict=True))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.concatenate([found[k] if k in found else ids[bounds[k]:bounds[k + 1]] for k in range(len(texts))])
            sizes = sizes.copy()
            for k, x in found.items():
                sizes[k] = len(x)
        return ids, sizes


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; it lives on from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text, and the offsets of the texts."""
    ends = np.cumsum(sizes)
    return np.insert(ids, ends, np.uint32(end_id)), np.concatenate([[0], ends + np.arange(1, len(sizes) + 1)])
