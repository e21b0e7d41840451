"""Ids of text units a worker has met, in flat arrays.

Text is encoded unit by unit and units repeat, so a worker asks the tokenizer
for each distinct unit once.  The store is a sorted array of 64-bit hashes
with places in one pool of ids; a slice's units are looked up and put together
by numpy alone.  It starts anew when it is full, which bounds its memory.
"""
from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np

from .common import _MASKS as TAIL
from .common import byte_lanes, bytes_hash, ragged

#: Units a worker remembers: some 60 bytes each.
MOST_UNITS = 800_000
#: New units are merged into the sorted store when they are this many.
MERGE_UNITS = 50_000


#: Texts the library encodes at once; it returns some 2 kB for each.
ENCODE_AT_ONCE = 4_096


def library_ids(model, texts: list[str]) -> Iterator[list[int]]:
    """The tokenizers library's ids of each text, without threads of its own:
    a task has one core, the others belong to other tasks, and a worker with no
    second thread has none to wait for."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    for a in range(0, len(texts), ENCODE_AT_ONCE):
        for e in model.encode_batch_fast(texts[a : a + ENCODE_AT_ONCE], add_special_tokens=False):
            yield e.ids


class IdCache:
    def __init__(self, most: int = MOST_UNITS):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]  # merged, recent
        # First id, ids, first byte, bytes of each.
        self.places = [np.zeros((0, 4), np.int64), np.zeros((0, 4), np.int64)]
        self.ids, self.bytes = Pool(np.uint32), Pool(np.uint8)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; its count of ids is -1 where it is not known."""
        out = np.full((len(keys), 4), -1, np.int64)
        for have, places in zip(self.keys, self.places):
            if len(have):
                at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit = have[at] == keys
                out[hit] = places[at[hit]]
        return out

    def _store(self, texts: list[bytes], ids: Iterable[list[int]]) -> np.ndarray:
        """Places of units that are new to the pools."""
        flat, counts = array("I"), []
        for x in ids:
            flat.extend(x)
            counts.append(len(x))
        places = np.zeros((len(texts), 4), np.int64)
        for c, size in ((1, counts), (3, list(map(len, texts)))):
            places[:, c] = size
            places[:, c - 1] = np.cumsum(places[:, c]) - places[:, c]
        places[:, 0] += self.ids.add(np.frombuffer(flat, np.uint32) if len(flat) else np.zeros(0, np.uint32))
        places[:, 2] += self.bytes.add(np.frombuffer(b"".join(texts), np.uint8))
        return places

    def _add(self, keys: np.ndarray, texts: list[bytes], ids: Iterable[list[int]]) -> np.ndarray:
        places = self._store(texts, ids)
        self._merge(1, keys, places)
        if len(self.keys[1]) > MERGE_UNITS:
            self._merge(0, self.keys[1], self.places[1])
            self.keys[1], self.places[1] = self.keys[1][:0], self.places[1][:0]
        return places

    def _merge(self, level: int, keys: np.ndarray, places: np.ndarray) -> None:
        both = np.concatenate([self.keys[level], keys])
        order = np.argsort(both, kind="stable")
        self.keys[level] = both[order]
        self.places[level] = np.concatenate([self.places[level], places])[order]

    def encode(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, edges: np.ndarray,
        encode_new: Callable[[list[bytes], np.ndarray], Iterable[list[int]]],
    ) -> list[bytes]:
        """Ids of the units start:end of ``data`` for each document, whose
        units are edges[d] : edges[d + 1], as little-endian 32-bit bytes.
        ``encode_new`` gets units (and their numbers) met for the first time."""
        if len(self.keys[0]) + len(self.keys[1]) > self.most:
            self._clear()
        keys, first, back = np.unique(bytes_hash(data, start, end), return_index=True, return_inverse=True)
        places, length = self._find(keys), end - start
        raw = data.tobytes()
        spelled = lambda units: [raw[a:b] for a, b in zip(start[units].tolist(), end[units].tolist())]
        new = np.flatnonzero(places[:, 1] < 0)
        if len(new):
            texts = spelled(first[new])
            places[new] = self._add(keys[new], texts, encode_new(texts, first[new]))
        # Units that are not what their hash found, if there are any.
        odd = np.flatnonzero(differ(data, start, length, self.bytes.values, places[back, 2], places[back, 3]))
        if len(odd):
            texts = spelled(odd)
            back[odd] = len(places) + np.arange(len(odd))
            places = np.concatenate([places, self._store(texts, encode_new(texts, odd))])
        counts = places[back, 1]
        ids = self.ids.values[ragged(places[back, 0], counts)].astype("<u4", copy=False).tobytes()
        upto = np.concatenate([[0], np.cumsum(counts)])[edges] * 4
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]


def differ(a: np.ndarray, a0: np.ndarray, a_len: np.ndarray, b: np.ndarray, b0: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Whether range a0 of ``a`` and range b0 of ``b`` hold different bytes,
    compared eight at a time."""
    out = a_len != b_len
    x, y = byte_lanes(a), byte_lanes(b)
    left = np.flatnonzero(~out & (a_len > 0))
    k = 0
    while len(left):
        unlike = (x[a0[left] + k] ^ y[b0[left] + k]) & TAIL[np.minimum(a_len[left] - k, 8)]
        out[left[unlike != 0]] = True
        k += 8
        left = left[(unlike == 0) & (a_len[left] > k)]
    return out


class Pool:
    """Numbers one after the other in an array that grows."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> int:
        """Where ``more`` now begins."""
        begin, need = self.used, self.used + len(more)
        if need > len(self.values):
            grown = np.zeros(max(need, 2 * len(self.values)), self.values.dtype)
            grown[:begin] = self.values[:begin]
            self.values = grown
        self.values[begin:need] = more
        self.used = need
        return begin
