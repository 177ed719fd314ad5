"""A byte-level BPE vocabulary behind a minimal perfect hash.

n byte strings get n slots and no slot stays empty: keys fall into small buckets
by one part of their hash, and each bucket, the largest first, gets the
first displacement that sends its keys to free slots; buckets of one key name their
slot outright. A look-up is one hash, one displacement and one comparison.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable, Sequence

import numpy as np
import regex
import xxhash

# Fixed value: the public pattern that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KEYS_PER_BUCKET = 4
TRIES = 1 << 16


class PerfectHash:
    """The number of each of a fixed set of distinct byte strings, None for any other."""

    def __init__(self, keys: list[bytes], numbers: list[int]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // KEYS_PER_BUCKET)
        for seed in range(100):
            placed = self._place(keys, seed)
            if placed is not None:
                self.seed, (self.shift, slots) = seed, placed
                break
        else:
            raise ValueError("keys are not distinct")
        self.keys, self.numbers = [b""] * n, [0] * n
        for slot, key, number in zip(slots, keys, numbers, strict=True):
            self.keys[slot], self.numbers[slot] = key, number

    def _place(self, keys: list[bytes], seed: int):
        hashes = np.array([xxhash.xxh3_64_intdigest(k, seed) for k in keys], dtype=np.uint64)
        if len(np.unique(hashes)) < len(keys):
            return None
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        start = ((hashes >> np.uint64(16)) % np.uint64(self.n)).astype(np.int64)
        step = ((hashes >> np.uint64(40)) | np.uint64(1)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        free, shift, slots = np.ones(self.n, dtype=bool), [0] * self.buckets, np.zeros(len(keys), dtype=np.int64)
        singles = []
        for b in np.argsort(-sizes, kind="stable"):
            size = int(sizes[b])
            if size == 0:
                break
            own = order[ends[b] - size : ends[b]]
            if size == 1:
                singles.append((int(b), int(own[0])))
                continue
            s, t = start[own], step[own]
            for lo in range(0, TRIES, 64):
                at = (s[None, :] + np.arange(lo, lo + 64, dtype=np.int64)[:, None] * t[None, :]) % self.n
                fits = free[at].all(axis=1)
                for i in np.flatnonzero(fits):
                    if len(set(at[i].tolist())) == size:
                        shift[b], slots[own] = lo + int(i), at[i]
                        free[at[i]] = False
                        break
                else:
                    continue
                break
            else:
                return None
        for (b, k), slot in zip(singles, np.flatnonzero(free).tolist(), strict=True):
            shift[b], slots[k] = -slot - 1, slot
        return shift, slots.tolist()

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.shift[h % self.buckets]
        slot = -d - 1 if d < 0 else ((h >> 16) % self.n + d * ((h >> 40) | 1)) % self.n
        return self.numbers[slot] if self.keys[slot] == key else None


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file and their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Ids of texts. Built once by the driver and sent to the workers; its size is the vocabulary's."""

    MEMO = 1 << 18
    #: From this many characters on, pre-tokens come one by one and ids are packed.
    LONG = 1 << 20

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.table = PerfectHash(list(ranks), list(ranks.values()))
        self._split, self._memo = None, {}

    def __getstate__(self):
        return {"table": self.table, "_split": None, "_memo": {}}

    def word(self, data: bytes) -> tuple[int, ...]:
        """The ids of one pre-token: a whole entry of the vocabulary, else merged from bytes."""
        whole = self.table.get(data)
        return (whole,) if whole is not None else tuple(self._merge(data))

    def _merge(self, data: bytes) -> list[int]:
        """Repeatedly joins the neighbours of lowest rank, the leftmost first. Pieces form a linked
        list over byte positions; a heap holds the pairs, stale ones are skipped when
        they come up, so a run of n bytes takes O(n log n)."""
        n, get = len(data), self.table.get
        end = list(range(1, n + 1))  # of the piece that starts here
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(left: int) -> None:
            right = end[left]
            if right < n and (rank := get(data[left : end[right]])) is not None:
                heapq.heappush(heap, (rank, left, end[right]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, stop = heapq.heappop(heap)
            right = end[left] if alive[left] else n
            if right >= n or end[right] != stop:
                continue
            alive[right], end[left] = False, stop
            if stop < n:
                before[stop] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        out, i = [], 0
        while i < n:
            out.append(get(data[i : end[i]]))
            i = end[i]
        return out

    def _pieces(self, text: str) -> Iterable[str]:
        if self._split is None:
            self._split = regex.compile(PATTERN)
        return self._split.findall(text) if len(text) < self.LONG else (m[0] for m in self._split.finditer(text))

    def encode(self, text: str | None) -> Sequence[int]:
        if not text:
            return []
        memo, out = self._memo, [] if len(text) < self.LONG else array("i")
        for piece in self._pieces(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.word(piece.encode("utf-8", "surrogatepass"))
                if len(piece) <= 64:
                    if len(memo) >= self.MEMO:
                        memo.clear()
                    memo[piece] = ids
            out.extend(ids)
        return out
