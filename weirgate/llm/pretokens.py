"""Byte-level BPE over whole batches: cut texts into pre-tokens with array operations, encode each distinct pre-token once.

The cutting rule is the one of byte-level tokenizers: contractions, then a letter, number or symbol run with one blank
before it, then white space. Which class a character has is asked of the tokenizer itself, once per character, so the cut
agrees with the library for every script. Special tokens inside a text are found first, as the library does.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

from weirgate.llm.common import give_back
from weirgate.llm.kernels import flat, range_hashes

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = 0, 1, 2, 3, 255


class Table:
    """An open hash table from 64-bit hashes to small numbers, in two arrays; looked up for whole arrays at once."""

    def __init__(self, capacity: int):
        bits = max(int(capacity * 2 - 1).bit_length(), 4)
        self.shift, self.mask, self.room, self.used = np.uint64(64 - bits), (1 << bits) - 1, capacity, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where there is none."""
        slot = (hashes >> self.shift).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == hashes, self.values[slot], -1)
        open_ = np.flatnonzero((held != hashes) & (held != 0))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            held = self.keys[slot]
            hit = held == hashes[open_]
            out[open_[hit]] = self.values[slot[hit]]
            more = ~hit & (held != 0)
            open_, slot = open_[more], slot[more]
        return out

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that are not in the table yet."""
        slot = (hashes >> self.shift).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[slot[left]] == 0
            self.keys[slot[left[free]]] = hashes[left[free]]  # of several for one slot, the last stays
            won = self.keys[slot[left]] == hashes[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask
        self.used += len(hashes)


class Encoder:
    """The tokenizer of one file with a bounded cache of encoded pre-tokens. One per worker process."""

    ROOM = 400_000
    #: Pre-tokens that the library encodes at a time: what it builds for each token weighs many times its id.
    TOGETHER = 4_096

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        cutter = said.get("pre_tokenizer") or {}
        plain = (cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
                 and said.get("normalizer") is None)
        special = [token for token in said.get("added_tokens", [])]
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in special):
            raise ValueError("only byte-level BPE files without a normalizer and with plain special tokens are supported")
        self.special = {token["content"].encode(): token["id"] for token in special}
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.table = Table(self.ROOM)
        self.sizes = np.zeros(0, np.int32)
        self.places = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.learn([], np.zeros(0, np.uint64))

    def _classes_of(self, points: np.ndarray) -> np.ndarray:
        got = self.classes[points]
        if (got == UNKNOWN).any():
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for point in np.unique(points[got == UNKNOWN]):
                joined = [len(cut(before + chr(point))) == 1 for before in ("a", "1", "!")]
                self.classes[point] = joined.index(True) if any(joined) else SPACE
            got = self.classes[points]
        return got

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the pre-tokens of all texts in bytes, the offset of each text's among them, and the id of those
        that are special tokens (-1: none)."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int32)
        raw = data.tobytes()
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self._classes_of(points)
        count = len(points)
        fresh = np.zeros(count + 1, bool)  # where a text, or what stands between special tokens, begins
        texts = np.searchsorted(lead, offsets)
        fresh[texts] = True
        fresh[count] = True
        found = self._specials(raw, offsets)
        inside = np.zeros(count, bool)
        for first, last, _ in found:
            a, b = np.searchsorted(lead, (first, last))
            fresh[a] = fresh[b] = True
            inside[a:b] = True
        change = fresh.copy()
        change[1:count] |= kind[1:] != kind[:-1]
        start = change[:count].copy()
        blank = (kind == SPACE) & ~inside
        # The last white space before a text run stands alone, or leads the run if it is a blank.
        ends_run = np.zeros(count, bool)
        ends_run[:-1] = blank[:-1] & ~blank[1:] & ~fresh[1:count]
        start |= ends_run
        led = np.zeros(count, bool)
        led[1:] = ends_run[:-1] & (points[:-1] == 32)
        start &= ~led
        self._contractions(points, kind, change, fresh, start)
        start &= ~inside
        for first, _, _ in found:
            start[np.searchsorted(lead, first)] = True
        places = np.flatnonzero(start)
        special = np.full(len(places), -1, np.int32)
        starts = lead[places]
        for first, _, token in found:
            special[np.searchsorted(starts, first)] = token
        return starts, np.searchsorted(starts, offsets), special

    def _specials(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        import re

        if not self.special or not any(content in raw for content in self.special):
            return []
        pattern = re.compile(b"|".join(re.escape(one) for one in sorted(self.special, key=len, reverse=True)))
        found = []
        for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            found += [(m.start(), m.end(), self.special[m[0]]) for m in pattern.finditer(raw, first, last)]
        return found

    @staticmethod
    def _contractions(points, kind, change, fresh, start) -> None:
        """An apostrophe alone takes s, t, m, d, re, ve or ll from the letters after it."""
        count = len(points)
        mark = np.flatnonzero((points == 39) & start & change[:-1])
        mark = mark[(mark + 1 < count)]
        mark = mark[~fresh[mark + 1] & (kind[mark + 1] == LETTER)]
        if not len(mark):
            return
        one = points[mark + 1]
        after = np.minimum(mark + 2, count - 1)
        two = np.where((mark + 2 < count) & ~fresh[after], points[after], 0)
        letters = {name: ord(name) for name in "stmdrevl"}
        single = np.isin(one, [letters[name] for name in "stmd"])
        double = ((one == letters["r"]) | (one == letters["v"])) & (two == letters["e"])
        double |= (one == letters["l"]) & (two == letters["l"])
        size = np.where(single, 1, np.where(double, 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        rest = mark + 1 + size
        inside = rest < count
        rest = rest[inside]
        # What is left of the letters begins anew; other runs begin by themselves.
        start[rest[~change[rest]]] = True

    def learn(self, pretokens: list[str], hashes: np.ndarray) -> None:
        """Encode pre-tokens and keep them."""
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for first in range(0, len(pretokens), self.TOGETHER):
            some = pretokens[first:first + self.TOGETHER]
            made = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(made.ids, np.int32))
            sizes.append(np.bincount(np.array(made.word_ids, np.int64), minlength=len(some)))
        sizes, ids = np.concatenate(sizes), np.concatenate(ids)
        known = len(self.sizes)
        base = len(self.ids)
        self.places = np.concatenate((self.places, base + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes.astype(np.int32)))
        self.ids = np.concatenate((self.ids, ids))
        self.table.add(hashes, np.arange(known, known + len(pretokens), dtype=np.int32))

    def numbers(self, data, starts, ends, hashes) -> np.ndarray:
        """The cache's number of each pre-token; unseen ones are encoded first."""
        got = self.table.find(hashes)
        missing = np.flatnonzero(got < 0)
        if len(missing):
            fresh, first = np.unique(hashes[missing], return_index=True)
            if self.table.used + len(fresh) > self.table.room:
                self.clear()  # the numbers found above are gone with the cache
                missing = np.arange(len(hashes))
                fresh, first = np.unique(hashes, return_index=True)
                if len(fresh) > self.ROOM:
                    self.table = Table(len(fresh))
            first = missing[first]
            raw = data.tobytes()
            self.learn([raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())], fresh)
            got[missing] = self.table.find(hashes[missing])
        return got

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of the texts among them."""
        data, offsets = flat(texts)
        starts, bounds, special = self.cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        marked = special >= 0
        plain = ~marked
        numbers = np.zeros(len(starts), np.int64)
        numbers[plain] = self.numbers(data, starts[plain], ends[plain],
                                      range_hashes(data, starts[plain], ends[plain]))
        sizes = np.ones(len(starts), np.int64)
        sizes[plain] = self.sizes[numbers[plain]]
        sums = np.concatenate(([0], np.cumsum(sizes)))
        places = self.places[numbers] if len(self.places) else numbers
        index = np.arange(sums[-1]) + np.repeat(places - sums[:-1], sizes)
        index[sums[:-1][marked]] = 0  # set below
        ids = self.ids[index] if len(self.ids) else np.zeros(len(index), np.int32)
        ids[sums[:-1][marked]] = special[marked]
        return ids, sums[bounds]


def _kept() -> dict:
    """A dictionary that lives as long as the worker process, for what is costly to load."""
    return sys.modules.setdefault("_weirgate_worker", types.ModuleType("_weirgate_worker")).__dict__


def encoder(path: str) -> Encoder:
    """This worker's encoder for the file."""
    kept = _kept()
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(path)
        give_back()  # what reading the file took, some 20 MB
    return kept["encoder", path]


def forget_encoder(path: str) -> None:
    """Drop this worker's encoder for the file: reading it again takes a fraction of a second, keeping it some 50 MB in every
    worker that once had a task. Functions travel by value, so the tables of its hashes hang in a cycle of their own."""
    import gc

    _kept().pop(("encoder", path), None)
    gc.collect()
