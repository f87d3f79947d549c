"""Token ids of whole texts: the tokenizers library once per distinct run, arrays for the rest.

Both vocabularies in use never join bytes across the start of white space that follows a
character which is no white space, nor across ASCII punctuation that follows a Latin letter
or digit.  So a text is cut there, every distinct run is encoded once per Python worker (a
bounded cache that outlives tasks), and the ids are gathered.  Runs are told apart by
64-bit hashes: among the runs held at once a mix-up has a chance of about 6e-8.
Texts with white space beyond ASCII are given to the library whole, as the cut might
fall inside a white-space run.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from postloom.llm.words import hash_runs, text_bytes

CACHED_RUNS = 1_500_000
CACHED_IDS = 8_000_000
PIECE_BYTES = 4 << 20
_MARKER = "<|endoftext|>"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[b for b in range(0x30, 0x7B) if chr(b).isalnum()]] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF, *range(0x1C, 0x20)]] = True


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Places of white space (or what some engines take for it) beyond ASCII."""
    at = np.flatnonzero(_LEAD[data])
    if not at.size:
        return at
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    found = a < 0x20
    found |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    found |= (a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))
    found |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8F) | ((c >= 0xA8) & (c <= 0xAF)))) | ((b == 0x81) & (c >= 0x9F) & (c <= 0xAF)))
    found |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    found |= (a == 0xEF) & (b == 0xBB) & (c == 0xBF)
    return at[found]


class Encoder:
    """Ids of texts, each text closed by ``end``."""

    def __init__(self, path: str, end: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True  # their names in a text are ordinary text
        # A second instance splits at its special token: many runs go through one call.
        self.joined = Tokenizer.from_file(path)
        self.mark_id = self.joined.token_to_id(_MARKER)
        self.end = end
        self._forget()

    def _forget(self) -> None:
        """An empty cache: sorted run hashes, the slot of each, and per slot its ids.  Slot 0 is the end id."""
        self.keys, self.slots = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids, self.used = np.full(1 << 16, self.end, dtype=np.uint32), 1
        self.begin, self.length = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)

    def _encoded(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the runs end to end, and how many each has."""
        if self.mark_id is None or any(_MARKER[:2] in run for run in runs):
            found = [e.ids for e in self.plain.encode_batch_fast(runs, add_special_tokens=False)]
            length = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(length.sum())), length
        some = [_MARKER.join([*runs[i : i + 64], ""]) for i in range(0, len(runs), 64)]
        found = [np.array(e.ids, dtype=np.uint32) for e in self.joined.encode_batch_fast(some, add_special_tokens=False)]
        flat = np.concatenate(found)
        marks = np.flatnonzero(flat == self.mark_id)
        return flat[flat != self.mark_id], np.diff(marks, prepend=-1) - 1

    def _slots_of(self, keys: np.ndarray, runs: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """The slot of each key; ``runs`` gives the texts of those not seen before."""
        place = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        if new.size:
            new = new[np.argsort(keys[new])]
            flat, length = self._encoded(runs(new))
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.slots = np.insert(self.slots, place[new], len(self.length) + np.arange(len(new)))
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.begin = np.concatenate([self.begin, self.used + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.used += len(flat)
        return self.slots[np.searchsorted(self.keys, keys)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each text has (null: empty)."""
        data, offsets = text_bytes(texts)
        odd = np.unique(np.searchsorted(offsets, _wide_space(data), side="right") - 1)
        if odd.size:
            return self._with_odd(data, offsets, odd)
        return self._gathered(data, offsets)

    def _gathered(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > CACHED_RUNS or self.used > CACHED_IDS:
            self._forget()
        space, letter = _SPACE[data], _ALNUM[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = (space[1:] & ~space[:-1]) | (_MARK[data[1:]] & letter[:-1])
        cut[offsets[:-1]] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if starts.size else starts
        codes, keys = pd.factorize(hash_runs(np.concatenate([data, np.zeros(8, np.uint8)]), starts, ends))
        where = np.empty(len(keys), dtype=np.int64)
        where[codes[::-1]] = np.arange(len(codes))[::-1]

        def runs(some: np.ndarray) -> list[str]:
            spots = where[some]
            return [data[a:b].tobytes().decode() for a, b in zip(starts[spots].tolist(), ends[spots].tolist())]

        slot = self._slots_of(keys, runs)[codes]
        first = np.searchsorted(starts, offsets)
        run = np.insert(slot, first[1:], 0)
        length = self.length[run]
        total = np.cumsum(length)
        place = np.arange(total[-1] if total.size else 0) + np.repeat(self.begin[run] - total + length, length)
        bound = np.concatenate([[0], total])[first + np.arange(len(first))]
        return self.ids[place], np.diff(bound)

    def _with_odd(self, data: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, counts, at = [], [], 0
        for i in [*odd.tolist(), len(offsets) - 1]:
            if i > at:
                some = offsets[at : i + 1]
                found, n = self._gathered(data[some[0] : some[-1]], some - some[0])
                ids.append(found)
                counts.append(n)
            if i < len(offsets) - 1:
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                whole = self.plain.encode(text, add_special_tokens=False).ids
                ids.append(np.array([*whole, self.end], dtype=np.uint32))
                counts.append(np.array([len(whole) + 1]))
            at = i + 1
        return np.concatenate(ids), np.concatenate(counts)


@lru_cache(maxsize=2)
def encoder(path: str, end: int) -> Encoder:
    """The worker's encoder of this vocabulary, its cache kept from task to task."""
    return Encoder(path, end)
