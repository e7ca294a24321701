"""Exact nearest entries of a codebook: floating-point screening with rigorous error bounds, exact whole numbers where it can't decide."""

from __future__ import annotations

import numpy as np

#: Magnitudes up to which a screening type can hold squared distances, and its unit of rounding.
TIERS = ((np.float32, float(1 << 40), 2.0**-24), (np.float64, 2.0**400, 2.0**-53))
#: Rows screened at a time.
STEP = 4096
LONG = (1 << 63) - 1


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, which hold it exactly; a product beyond what a double holds becomes the largest one."""
    top = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x.astype(np.float64) * scale), -top, top)


def exactly(x: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers if all of them fit easily, else as Python's integers."""
    if np.abs(x).max(initial=0) < float(1 << 62):
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


class Book:
    """Entries of whole numbers, with what the screening needs of them."""

    def __init__(self, entries: list[list[int]]):
        self.exact = np.array(entries, object).reshape(len(entries), -1)
        self.size, self.width = self.exact.shape
        self.most = max((abs(int(v)) for v in self.exact.ravel()), default=0)
        top = int(np.finfo(np.float64).max)
        self.near = np.array([float(max(-top, min(top, int(v)))) for v in self.exact.ravel()]).reshape(self.exact.shape)
        self.reach = np.abs(self.near).max(axis=1, initial=0)
        self.short = self.exact.astype(np.int64) if self.most < 1 << 62 else None

    def intervals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds from below and above of |c|^2 - 2 x.c for each row of x and entry c; unbounded where no type can hold them.

        A product of vectors of width n, whose components were rounded once before, is off by at
        most gamma * |x||c| with gamma = (n + 4) u / (1 - (n + 4) u), however it is summed up.
        """
        low, high = np.full((len(x), self.size), -np.inf), np.full((len(x), self.size), np.inf)
        sizes = np.abs(x).max(axis=1, initial=0)
        rows_left, done = np.ones(len(x), bool), np.zeros(self.size, bool)
        tiny = (self.width + 8) * 2.0**-51  # over what all roundings in doubles below add up to
        for kind, most, unit in TIERS:
            cols = np.flatnonzero(self.reach <= most)
            rows = np.flatnonzero(sizes <= most)
            if not len(cols) or not len(rows) or (self.width + 4) * unit > 0.5:
                continue
            gamma = (self.width + 4) * unit / (1 - (self.width + 4) * unit)
            # the first type settles most rows and entries; the second one what the first can't hold
            todo = [(rows, cols)] if not done.any() else [(rows[rows_left[rows]], cols), (rows[~rows_left[rows]], cols[~done[cols]])]
            for r, c in todo:
                if not len(r) or not len(c):
                    continue
                near = self.near[c]
                dot = (x[r].astype(kind) @ near.astype(kind).T).astype(np.float64)
                own, norm = np.einsum("ij,ij->i", near, near), np.sqrt(np.einsum("ij,ij->i", x[r], x[r]))
                score = own - 2 * dot
                slack = (2 * gamma * np.outer(norm, np.sqrt(own)) + tiny * (own + 2 * np.abs(dot))) * (1 + tiny)
                low[np.ix_(r, c)], high[np.ix_(r, c)] = score - slack, score + slack
            rows_left[rows] = False
            done[cols] = True
        return low, high

    def distances(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Exact squared distance of each row of x to its entry."""
        most = max(float(np.abs(x).max(initial=0)), float(self.most))
        if 4 * most * most * max(1, self.width) < float(1 << 62):
            gap = x.astype(np.int64) - self.short[entry]
            return np.einsum("ij,ij->i", gap, gap)
        if not len(x):
            return np.zeros(0, object)
        gap = np.array([int(v) for v in x.ravel()], object).reshape(x.shape) - self.exact[entry]
        return (gap * gap).sum(axis=1) if self.width else np.zeros(len(x), object)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """Number of the entry nearest to each row of x (whole doubles), the smallest of equals."""
        out = np.zeros(len(x), np.int64)
        for at in range(0, len(x), STEP):
            out[at : at + STEP] = self._some(x[at : at + STEP])
        return out

    def _some(self, x: np.ndarray) -> np.ndarray:
        low, high = self.intervals(x)
        able = low <= high.min(axis=1)[:, None]
        best = able.argmax(axis=1)
        open_ = np.flatnonzero(able.sum(axis=1) > 1)
        if len(open_):
            row, entry = np.nonzero(able[open_])
            wide = np.abs(x[open_]).max(axis=1, initial=0) > float(1 << 26)
            for some in (wide, ~wide):  # only the rows with large components need Python's integers
                at = np.flatnonzero(some[row])
                if len(at):
                    d = self.distances(x[open_[row[at]]], entry[at])
                    order = np.lexsort((entry[at], d, row[at])) if d.dtype != object else np.array(sorted(range(len(at)), key=lambda i: (row[at[i]], d[i], entry[at[i]])))
                    heads = at[order][np.r_[True, np.diff(row[at][order]) > 0]]
                    best[open_[row[heads]]] = entry[heads]
        return best


#: Digits in which exact sums travel: a sum is a list of such digits, the last one signed.
DIGIT = 1 << 32


def digits(total: int) -> list[int]:
    """A whole number in digits to the base DIGIT, lowest first; the last one holds the sign."""
    out = []
    while not -DIGIT <= total < DIGIT:
        total, low = divmod(total, DIGIT)
        out.append(low)
    return [*out, total]


def undigits(parts: dict[int, int]) -> int:
    """The number whose digits, summed up over tasks, are these."""
    return sum(int(v) * DIGIT**k for k, v in parts.items())


def sums(x: np.ndarray, entry: np.ndarray, size: int, sign: np.ndarray | None = None) -> dict[int, tuple[int, list[int]]]:
    """For each entry that occurs: number of rows (by sign, if given) and exact componentwise sums of its rows."""
    out = {}
    for e in np.flatnonzero(np.bincount(entry, minlength=size)):
        own = entry == e
        rows, s = x[own], np.ones(int(own.sum()), np.int64) if sign is None else sign[own]
        if np.abs(rows).max(initial=0) * max(1, len(rows)) < float(1 << 62):
            total = (rows.astype(np.int64) * s[:, None]).sum(axis=0).tolist()
        else:
            total = [sum(int(v) * int(g) for v, g in zip(col, s, strict=True)) for col in rows.T]
        out[int(e)] = (int(s.sum()), total)
    return out
