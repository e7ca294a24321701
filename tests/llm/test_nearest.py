import numpy as np
import pytest

from strataloom.llm.nearest import Book, digits, sums, undigits, whole


def brute(x, entries):
    out = []
    for row in x:
        d = [sum((int(a) - b) ** 2 for a, b in zip(row, e, strict=True)) for e in entries]
        out.append((d.index(min(d)), min(d)))
    return out


def made(kind, rng, n, k, width):
    if kind == "small":
        return rng.integers(-40, 40, (n, width)).astype(float), rng.integers(-40, 40, (k, width)).tolist()
    if kind == "ties":
        return rng.integers(0, 3, (n, width)).astype(float), rng.integers(0, 3, (k, width)).tolist()
    if kind == "far":  # distances that differ by less than float32 can tell
        c = rng.integers(-(2**24), 2**24, width)
        return c + rng.integers(-2, 3, (n, width)).astype(float), (c + rng.integers(-2, 3, (k, width))).tolist()
    if kind == "wide":
        x = rng.integers(-40, 40, (n, width)).astype(float)
        x[::5] *= 2.0**90
        x[1::5] *= 2.0**600
        c = [[int(v) for v in r] for r in rng.integers(-40, 40, (k, width))]
        c[0] = [v * 2**90 + 1 for v in c[0]]
        c[-1] = [v * 2**600 for v in c[-1]]
        return x, c
    x = whole(rng.normal(0, 1e38, (n, width)), 256)
    return x, [[int(v) + 1 for v in r] for r in x[:k]]


@pytest.mark.parametrize("kind", ["small", "ties", "far", "wide", "huge"])
def test_nearest_is_exact(kind):
    rng = np.random.default_rng(5)
    for width in (1, 4, 64):
        x, entries = made(kind, rng, 60, 12, width)
        book = Book(entries)
        got = book.nearest(x)
        assert list(zip(got.tolist(), [int(v) for v in book.distances(x, got)], strict=True)) == brute(x, entries)
        low, high = book.intervals(x)
        for i in range(len(x)):
            for j, e in enumerate(entries):
                true = sum(c * c - 2 * int(a) * c for a, c in zip(x[i], e, strict=True))
                assert (low[i, j] == -np.inf or int(np.floor(low[i, j])) <= true) and (high[i, j] == np.inf or true <= int(np.ceil(high[i, j])))


def test_ordinary_vectors_are_settled_by_the_screening():
    rng = np.random.default_rng(1)
    x = whole(rng.normal(0, 0.13, (2000, 64)), 256)
    low, high = Book([[int(v) for v in r] for r in x[:40]]).intervals(x)
    assert ((low <= high.min(axis=1)[:, None]).sum(axis=1) == 1).mean() > 0.99


def test_sums_and_digits():
    x = np.array([[1.0, -2.0], [2.0**80, 5.0], [-3.0, 2.0**80]])
    got = sums(x, np.array([1, 1, 0]), 3, np.array([1, -1, 1]))
    assert got == {1: (0, [1 - 2**80, -7]), 0: (1, [-3, 2**80])}
    for v in (0, 1, -1, 2**32, -(2**32), 2**75 + 3, -(2**75) - 3):
        assert undigits(dict(enumerate(digits(v)))) == v
        assert undigits({k: 3 * d for k, d in enumerate(digits(v))}) == 3 * v


def test_empty():
    book = Book([[1, 2]])
    assert len(book.nearest(np.zeros((0, 2)))) == 0 and len(book.distances(np.zeros((0, 2)), np.zeros(0, int))) == 0
    assert Book([[], []]).nearest(np.zeros((3, 0))).tolist() == [0, 0, 0]
