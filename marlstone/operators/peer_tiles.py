"""Peers within one tile: members against candidates, all correlations by products of matrices.

A tile holds at most some thousand members and candidates of one group with their whole series, so no pair of a tile is ever
written or shuffled, only the best of each member. Series are laid out by time, with a mask for the times they have; sums over
the times that a pair shares are then products of those matrices, taken over blocks of times and strips of members.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRIP, TIMES = 128, 128
#: Where the variance is a smaller part of the sum of squares, the difference of sums is too coarse and the pair is worked out by itself.
COARSE = 1e-3


class Side:
    """The series of one side: entries (row, time, value) in order of time, centred by each row's median."""

    def __init__(self, rows: np.ndarray, times: np.ndarray, x: np.ndarray, n: int) -> None:
        order = np.lexsort((rows, times))
        self.n, self.rows, self.times, self.raw = n, rows[order].astype(np.int32), times[order].astype(np.int32), x[order]
        self.odd = ~np.isfinite(self.raw)
        fine = np.where(self.odd, 0.0, self.raw)
        by_value = np.lexsort((fine, self.odd, self.rows))
        known = np.bincount(self.rows[~self.odd], minlength=n)
        start = np.concatenate([[0], np.cumsum(np.bincount(self.rows, minlength=n))[:-1]])
        middle = np.zeros(n)
        middle[known > 0] = fine[by_value][(start + known // 2)[known > 0]]
        self.x = np.where(self.odd, 0.0, fine - middle[self.rows])
        top = np.zeros(n)
        np.maximum.at(top, self.rows, np.abs(self.x))
        self.x /= np.where(top > 1e100, top, 1.0)[self.rows]  # squares stay finite
        self.by_row = np.argsort(self.rows, kind="stable").astype(np.int32)
        self.start = np.append(start, len(rows))
        self.block = lru_cache(maxsize=1)(self._block)

    def _block(self, at: int) -> tuple[np.ndarray, ...]:
        a, b = np.searchsorted(self.times, [at, at + TIMES])
        return self._dense(slice(a, b), at, 0, self.n)

    def strip(self, at: int, rows: slice) -> tuple[np.ndarray, ...]:
        mine = self.by_row[self.start[rows.start] : self.start[rows.stop]]
        times = self.times[mine]
        return self._dense(mine[(times >= at) & (times < at + TIMES)], at, rows.start, rows.stop)

    def _dense(self, entries: slice | np.ndarray, at: int, first: int, end: int) -> tuple[np.ndarray, ...]:
        """(mask, values, squares, values that are not finite), rows by times, of the block's times."""
        cell = self.rows[entries] - first, self.times[entries] - at
        x = self.x[entries]
        out = [np.zeros((end - first, TIMES)) for _ in range(4)]
        for m, v in zip(out, (1.0, x, x * x, self.odd[entries]), strict=True):
            m[cell] = v
        return tuple(out)

    def series(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        mine = self.by_row[self.start[row] : self.start[row + 1]]
        return self.times[mine], self.raw[mine]


def sides(of: pa.Table, others: pa.Table) -> tuple[Side, Side, int]:
    """Both sides and the number of times they share; other times belong to no pair."""
    def entries(t: pa.Table) -> tuple:
        ts, xs = t["ts"].combine_chunks(), t["xs"].combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(ts), 0).to_numpy(zero_copy_only=False)
        return np.repeat(np.arange(t.num_rows), sizes), ts.flatten(), xs.flatten().to_numpy(zero_copy_only=False)
    (ra, ta, xa), (rb, tb, xb) = entries(of), entries(others)
    codes = pa.concat_arrays([ta, tb]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ca, cb = codes[: len(ra)], codes[len(ra) :]
    shared = np.intersect1d(ca, cb)
    def kept(rows, c, x, n):
        at = np.searchsorted(shared, c)
        ok = at < len(shared)
        ok[ok] = shared[at[ok]] == c[ok]
        return Side(rows[ok], at[ok], x[ok], n)
    return kept(ra, ca, xa, of.num_rows), kept(rb, cb, xb, others.num_rows), len(shared)


def alone(a: Side, b: Side, i: int, j: int) -> float:
    """The correlation of one pair by deviations from its own means; NaN if a side doesn't vary."""
    (ta, xa), (tb, xb) = a.series(i), b.series(j)
    _, p, q = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
    x, y = xa[p], xb[q]
    if x.min() == x.max() or y.min() == y.max():
        return math.nan
    x, y = x - x.mean(), y - y.mean()
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float((x * y).sum() / math.sqrt((x * x).sum() * (y * y).sum()))


def correlations(a: Side, b: Side, times: int, rows: slice, near: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(correlation, whether the pair has one) of a strip with all of the other side. As in SQL it is NaN where a side doesn't vary
    or has a value that is not finite, and there is none for fewer than `least` shared times."""
    size = rows.stop - rows.start
    n, sx, sxx, sy, syy, sxy, odd = (np.zeros((size, b.n)) for _ in range(7))
    for at in range(0, times, TIMES):
        m, x, xx, o = a.strip(at, rows)
        bm, y, yy, bo = b.block(at)
        n += m @ bm.T
        sx += x @ bm.T
        sxx += xx @ bm.T
        sy += m @ y.T
        syy += m @ yy.T
        sxy += x @ y.T
        if o.any() or bo.any():
            odd += o @ bm.T + m @ bo.T
    has = n >= max(least, 1)
    k = np.maximum(n, 1)
    vx, vy = sxx - sx * sx / k, syy - sy * sy / k
    flat = (sxx == 0) | (syy == 0) | (n < 2)
    with np.errstate(invalid="ignore", divide="ignore"):
        c = (sxy - sx * sy / k) / np.sqrt(vx * vy)
    c[flat | (odd > 0)] = np.nan
    for i, j in np.argwhere(near & has & ~flat & (odd == 0) & ((vx < COARSE * sxx) | (vy < COARSE * syy))).tolist():
        c[i, j] = alone(a, b, rows.start + i, j)
    return c, has


def log_ratios(s: np.ndarray, ps: np.ndarray, most: float) -> np.ndarray:
    with np.errstate(all="ignore"):
        ratio = ps[None, :] / s[:, None]
        out = np.log10(ratio)
        # a ratio right at the limit: as the C library has it, which is exact for powers of ten
        for i, j in np.argwhere(np.abs(np.abs(out) - most) < 1e-9).tolist():
            out[i, j] = math.log10(ratio[i, j])
    return out


def best(of: pa.Table, others: pa.Table, most: int, max_log_ratio: float, least: int, weights: tuple[float, float]) -> dict[str, pa.Array]:
    """The best `most` candidates in `others` of each member in `of`: columns key, n, s, ts, xs on both sides."""
    others = others.take(pc.sort_indices(others["key"]))  # ties go to the lesser key
    both = [pa.concat_arrays([c for t in (of, others) for c in t[name].chunks]).dictionary_encode().indices for name in ("key", "n")]
    keys, narrow = (pc.fill_null(c, -1).to_numpy(zero_copy_only=False) for c in both)
    size, other_size = (t["s"].to_numpy() for t in (of, others))
    a, b, times = sides(of, others)
    top = sum(abs(w) for w in weights) + 1  # beyond any score: the place of NaN, which sorts first
    found: list[tuple] = []
    for start in range(0, of.num_rows, STRIP):
        rows = slice(start, min(start + STRIP, of.num_rows))
        mine, theirs = slice(rows.start, rows.stop), slice(of.num_rows, None)
        lr = log_ratios(size[rows], other_size, max_log_ratio)
        near = (np.abs(lr) <= max_log_ratio) & (keys[mine][:, None] != keys[theirs][None, :])
        if not near.any():
            continue
        same = (narrow[mine][:, None] == narrow[theirs][None, :]) & (narrow[mine] >= 0)[:, None]
        c, has = correlations(a, b, times, rows, near, least)
        score = weights[0] * (1 - np.abs(lr) / max_log_ratio) + weights[1] * np.where(has, c, 0.0)
        order = np.where(np.isnan(score), top, np.round(score, 9)) + np.where(same, 4 * top, 0.0)
        order[~near] = -np.inf
        limit = np.partition(order, max(b.n - most, 0), axis=1)[:, max(b.n - most, 0)]
        i, j = np.nonzero(near & (order >= limit[:, None]))
        placed = np.lexsort((j, -order[i, j], i))
        i, j = i[placed], j[placed]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < most
        i, j = i[kept], j[kept]
        found.append((start + i, j, same[i, j], lr[i, j], c[i, j], has[i, j], score[i, j]))
    i, j, same, lr, c, has, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, t) for t in (int, int, bool, float, float, bool, float)]
    return {"key": of["key"].combine_chunks().take(pa.array(i)), "peer": others["key"].combine_chunks().take(pa.array(j)), "narrow_match": pa.array(same), "log_ratio": pa.array(lr), "c": pa.array(c, mask=~has), "score": pa.array(score)}
