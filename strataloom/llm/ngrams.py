"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

The filter holds each word pair once per level of its count, on a logarithmic scale; a count is
read by probing level after level until one is missing. Texts are read once, into slices of
numbered words. Words and pairs are dealt to parts by ranges of their hashes: a slice sends its
distinct ones to their parts, with counts if it is learned from; the task of a part sums them,
builds its own segments of the filter and answers all slices at once; the answers go back to the
slices. A filter and a word table of bounded size can also be broadcast, to score other texts. A
pair's probability mixes its relative frequency with that of the word, with shares that depend on
the magnitude of the first word's count and are tuned on training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import forget, stored

#: Ratio of neighbouring levels; probes of an entry; filter bits of an entry; bits of a segment.
RATIO, PROBES, BITS, SEGMENT = 1.5, 5, 10, 1 << 20
#: Words that a worker remembers; documents that are read and words that are scored at a time.
REMEMBER, ROWS, SOME = 250_000, 256, 200_000
#: Filter segments of a part at most; words of a part, counted once for each slice that has them; words of a slice (more in a longer text).
PART, WORDS_PART, SLICE = 32, 2_000_000, 1_000_000
#: Kinds of keys, and what a row that goes to a part is: its table, keys that are counted, or keys that are only asked for.
WORD, PAIR = 1, 2
TABLE, COUNTED, ASKED = range(3)
SHAPE = "kind byte, part int, step byte, slice long, key binary, n binary, many long"
START = np.uint64(0x9E3779B97F4A7C15)
_digest = xxhash.xxh64_intdigest


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One key of 48 bits per pair of word hashes."""
    x = first * np.uint64(0xD6E8FEB86659FD93) ^ (second + np.uint64(0x9E3779B97F4A7C15))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(16)


class Numbers(dict):
    """A number for each word, given when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Words:
    """Reads texts as numbers of words; remembers the words' hashes, and what `look` says of each hash."""

    def __init__(self, look=None) -> None:
        self.look = look
        self.clear()

    def clear(self) -> None:
        self.number = Numbers({b"": 0})  # the end of a text
        self.hash = np.array([_digest(b"")], np.uint64)
        self.count = self.look(self.hash) if self.look else None

    def read(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word, length of each text), an end behind each text."""
        if len(self.number) > REMEMBER:
            self.clear()
        words, sizes = [], []
        for text in texts:
            own = (text or "").encode("utf-8", "surrogatepass").lower().split()
            own.append(b"")
            words += own
            sizes.append(len(own))
        ids = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        old = len(self.hash)
        if len(self.number) > old:
            fresh = np.fromiter(map(_digest, islice(self.number, old, None)), np.uint64, len(self.number) - old)
            self.hash = np.append(self.hash, fresh)
            if self.look:
                self.count = np.append(self.count, self.look(fresh))
        return ids, np.array(sizes, np.int64)


def firsts(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word the number of the word before it; -1 at the start of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(sizes) - sizes] = -1
    return before


def levels_of(n: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(n, 1)) / np.log(RATIO) + 1e-9).astype(np.int64)


def value(level: int) -> float:
    """The count that a level stands for: the middle of the whole numbers in it; 0 for level 0."""
    if level == 0:
        return 0.0
    low, high = np.ceil(RATIO ** (level - 1) - 1e-9), np.ceil(RATIO**level - 1e-9) - 1
    return float((low + max(low, high)) / 2)


VALUES = np.array([value(x) for x in range(110)])


def place(key: np.ndarray, level, i: int) -> np.ndarray:
    """The i-th bit of a segment that holds a level of each key."""
    a, b = key & np.uint64(SEGMENT - 1), (key >> np.uint64(20)) | np.uint64(1)
    return (a + (np.asarray(level, np.uint64) * np.uint64(PROBES) + np.uint64(i)) * b) & np.uint64(SEGMENT - 1)


def part_of(kind: int, key: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key: parts are ranges of keys of equal width."""
    return (((key >> np.uint64(32 if kind == WORD else 16)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def segment_of(key: np.ndarray, segments) -> np.ndarray:
    return (((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(16)) % np.asarray(segments, np.uint64)).astype(np.int64)


def filled(key: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The segments that hold each key once per level up to its own, BITS bits for each: (segments, SEGMENT / 8) bytes."""
    segments = max(1, -(-int(level.sum(dtype=np.int64)) * BITS // SEGMENT))
    flags, start, on = np.zeros(segments * SEGMENT, bool), segment_of(key, segments) * SEGMENT, np.arange(len(key))
    for now in range(1, int(level.max(initial=0)) + 1):
        on = on[level[on] >= now]
        for i in range(PROBES):
            flags[start[on] + place(key[on], now, i).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").reshape(segments, -1)


def probe(bits: np.ndarray, segment: np.ndarray, key: np.ndarray, level: np.ndarray | None = None) -> np.ndarray:
    """The level of each key, 0 if it isn't held: levels are probed upwards until one is missing. level: up to where each key is known to be held."""
    out, at = np.zeros(len(key), np.uint8) if level is None else level.astype(np.uint8), np.arange(len(key))
    while len(at):
        for i in range(PROBES):
            p = place(key[at], out[at] + np.uint64(1), i)
            at = at[(bits[segment[at], p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        out[at] += 1
        at = at[out[at] < len(VALUES) - 1]
    return out


@dataclass
class Filter:
    """All segments of the filter, in one place. first: the first segment of each part, and their number."""

    bits: np.ndarray
    first: np.ndarray

    def of(self, key: np.ndarray) -> np.ndarray:
        """The level of each key, 0 if not held. Remembers the last key of each of 2^20 slots."""
        if not hasattr(self, "_keys"):
            self._keys, self._levels = np.full(1 << 20, (1 << 64) - 1, np.uint64), np.zeros(1 << 20, np.uint8)
        slot = key >> np.uint64(28)
        out, miss = self._levels[slot], np.flatnonzero(self._keys[slot] != key)
        k, s = key[miss], slot[miss]
        part = part_of(PAIR, k, len(self.first) - 1)
        out[miss] = got = probe(self.bits, self.first[part] + segment_of(k, self.first[part + 1] - self.first[part]), k)
        self._keys[s], self._levels[s] = k, got
        return out

    def counts(self, key: np.ndarray) -> np.ndarray:
        """The count of each key as the filter knows it, 0 if not held."""
        return VALUES[self.of(key)]


def gathered(parts: list[tuple[int, np.ndarray]], number: int) -> Filter:
    """The filter of (part, segments) pairs; of a part without any, an empty segment."""
    by = dict(parts)
    each = [by.get(p, np.zeros((1, SEGMENT // 8), np.uint8)) for p in range(number)]
    return Filter(np.concatenate(each), np.cumsum([0, *map(len, each)]))


class Known:
    """What was found for the keys of a slice: keys, ascending, and a value of each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values

    def of(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key), self.values.dtype)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.values[i], 0)


@dataclass
class Model:
    """tokens N and words V of the training texts, their number, the share of pairs by magnitude, and what is broadcast: the words' counts and the filter, or None."""

    tokens: int
    words: int
    texts: int
    share: np.ndarray
    look: Known | None
    filter: Filter | None

    def parts(self, sizes: np.ndarray, count: np.ndarray, level: np.ndarray, less: int = 0):
        """(frequency of the word, relative frequency of the pair, magnitude of the first word's count) for each word, from what `found` gives; less: how often the text itself was counted."""
        first = firsts(count, sizes)
        first[first < 0] = self.texts
        both = np.maximum(np.minimum(np.minimum(VALUES[level], count), first) - less, 0)
        c1 = np.maximum(first - less, 1)
        return (count - less + 1) / (self.tokens + self.words + 1), both / c1, np.log2(c1).astype(int)

    def scores(self, sizes: np.ndarray, count: np.ndarray, level: np.ndarray):
        """Per text (n_known, base_score, score)."""
        one, pair, magnitude = self.parts(sizes, count, level)
        at = np.cumsum(sizes) - sizes
        base = np.add.reduceat(np.log10(one), at)
        share = self.share[np.minimum(magnitude, len(self.share) - 1)]
        return np.add.reduceat((count > 0).astype(np.int64), at), base, np.add.reduceat(np.log10(share * pair + (1 - share) * one), at)


def found(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, counts: np.ndarray, pairs: Filter | Known, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, level) for each word: its count in training texts and the level of the pair that it ends, 0 where a word of it is unknown."""
    before, count, level = firsts(ids, sizes), counts[ids], np.zeros(len(ids), np.uint8)
    some = np.flatnonzero((count > 0) & (np.where(before < 0, texts, counts[before]) > 0))
    left = np.where(before[some] < 0, START, hashes[before[some]])
    level[some] = pairs.of(pair_keys(left, hashes[ids[some]]))
    return count, level


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def entries(pairs: DataFrame) -> int:
    """The filter's entries for the pairs (key, n): one per level of each."""
    hist = pairs.groupBy(F.floor(F.log2(F.col("n").cast("double")) * 64).alias("magnitude")).agg(F.count("*").alias("many"), F.max("n").alias("n")).toPandas()
    return int((hist["many"].to_numpy(np.int64) * levels_of(hist["n"].to_numpy(np.int64))).sum())


def build_filter(pairs: DataFrame, parts: int) -> Filter:
    """The filter of pairs (key, n) that were counted elsewhere, each part built by one task."""

    def place_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = part_of(PAIR, b.column("key").to_numpy().view(np.uint64), parts)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), b.column("key"), b.column("n")], ["part", "key", "n"])

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        bits = filled(rows["key"].to_numpy().view(np.uint64), levels_of(rows["n"].to_numpy()))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits.tobytes()], pa.binary())})

    rows = pairs.select("key", "n").mapInArrow(place_, "part int, key long, n long").groupBy("part").applyInArrow(build, "part int, bits binary")
    return gathered([(r.part, np.frombuffer(bytes(r.bits), np.uint8).reshape(-1, SEGMENT // 8)) for r in rows.toLocalIterator()], parts)


@dataclass
class Tables:
    """What the model gathers and doesn't broadcast: rows of SHAPE with words' counts and with the filter's segments, None if broadcast, and their numbers of parts."""

    words: DataFrame | None
    words_parts: int
    bits: DataFrame | None
    bits_parts: int

    def asked(self) -> dict[int, int]:
        """The number of parts of each kind that isn't broadcast."""
        return {kind: parts for kind, rows, parts in ((WORD, self.words, self.words_parts), (PAIR, self.bits, self.bits_parts)) if rows is not None}


def _pack(key: np.ndarray) -> np.ndarray:
    """Keys of 48 bits in 6 bytes each."""
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _unpack(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _blobs(rows: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values: the rows between each cut and the next."""
    width = rows.itemsize * int(np.prod(rows.shape[1:]))
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(rows.reshape(-1).view(np.uint8))])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, cuts) of binary values, as _blobs joins them."""
    _, at, data = column.buffers()
    cuts = np.frombuffer(at, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if cuts[-1] > cuts[0] else np.zeros(0, np.uint8), cuts - cuts[0]


def _zip(x: np.ndarray) -> pa.Array:
    """Numbers as one binary value, byte by byte of all of them, compressed."""
    return pa.array([pa.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unzip(blob: pa.Scalar, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(blob.as_buffer(), decompressed_size=n * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(-1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, len(b), ROWS):
            yield b.slice(i, ROWS)


def _prepared(docs: DataFrame, learned: bool) -> DataFrame:
    """(slice, learned, tokens, own, ids, sizes, words, hashes): docs put together up to SLICE words. words: each word's number among the slice's `own` distinct ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, tokens, number = Words(), [], 0, (TaskContext.get().partitionId() << 34) + learned

        def row() -> pa.RecordBatch:
            names, ids, sizes = zip(*held, strict=True)
            ids, sizes, names = np.concatenate(ids), np.concatenate(sizes), pa.concat_arrays(names)
            own = np.flatnonzero(np.bincount(ids, minlength=len(reader.hash)))
            local = np.zeros(len(reader.hash), np.uint32)
            local[own] = np.arange(len(own))
            blobs = [pa.array([sizes.tobytes()], pa.binary()), _zip(local[ids]), pa.array([reader.hash[own].tobytes()], pa.binary())]
            plain = [pa.array([number], pa.int64()), pa.array([learned]), pa.array([len(ids)], pa.int64()), pa.array([len(own)], pa.int64())]
            return pa.RecordBatch.from_arrays([*plain, pa.ListArray.from_arrays([0, len(names)], names), *blobs], ["slice", "learned", "tokens", "own", "ids", "sizes", "words", "hashes"])

        for b in _slices(batches):
            if held and len(reader.number) > REMEMBER:  # it begins to number anew
                yield row()
                held, tokens, number = [], 0, number + 2
            texts = b.column("text")
            held.append((b.column("doc_id"), *(x.astype(k) for x, k in zip(reader.read(texts.to_pylist()), (np.uint32, np.int64), strict=True))))
            tokens += len(held[-1][1])
            if tokens >= SLICE:
                yield row()
                held, tokens, number = [], 0, number + 2
        if held:
            yield row()

    return _texts(docs).mapInArrow(work, "slice long, learned boolean, tokens long, own long, ids array<long>, sizes binary, words binary, hashes binary")


def _row(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, words, hashes) of a slice."""
    sizes, hashes = (np.frombuffer(b.column(c)[i].as_buffer(), k) for c, k in (("sizes", np.int64), ("hashes", np.uint64)))
    return sizes, _unzip(b.column("words")[i], np.uint32, sizes.sum()).astype(np.int64), hashes


def _pairs(sizes: np.ndarray, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The key of the pair that each word ends."""
    before = firsts(words, sizes)
    return pair_keys(np.where(before < 0, START, hashes[before]), hashes[words])


def _said(kind, part, step: int, slices, key: pa.Array, n: pa.Array | None = None, many: int = 0) -> pa.RecordBatch:
    """Rows of SHAPE; one kind and part, or one each."""
    size = len(key)
    full = lambda x, k: pa.array(np.broadcast_to(np.asarray(x, k), size))
    n = _blobs(np.zeros(0, np.uint8), np.zeros(size + 1, np.int64)) if n is None else n
    return pa.RecordBatch.from_arrays([full(kind, np.int8), full(part, np.int32), full(step, np.int8), full(slices, np.int64), key, n, full(many, np.int64)], ["kind", "part", "step", "slice", "key", "n", "many"])


class Part:
    """One part: its table, and the answers of it."""

    def __init__(self, kind: int, part: int) -> None:
        self.kind, self.part = kind, part
        self.known, self.bits = Known(np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.zeros((1, SEGMENT // 8), np.uint8)

    def take(self, step: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Takes rows of a step; gives rows of SHAPE: the answers, in the rows' key, and the table when it is counted."""
        slices, key, n = (pa.concat_arrays([b.column(c) for b in held]) for c in ("slice", "key", "n"))
        raw, cuts = _bytes(key)
        if step == TABLE:
            if self.kind == WORD:
                self.known = Known(raw.view(np.uint64), _bytes(n)[0].view(np.int64))
            else:
                self.bits = raw.reshape(-1, SEGMENT // 8)
            return
        key, cuts = (raw.view(np.uint64), cuts // 8) if self.kind == WORD else (_unpack(raw), cuts // 6)
        order = np.argsort(key)
        new = np.diff(key[order], prepend=~key[order[:1]]) != 0
        distinct, at = key[order[new]], np.cumsum(new) - 1
        if step == COUNTED:
            sums = np.add.reduceat(_bytes(n)[0].view(np.uint32)[order].astype(np.int64), np.flatnonzero(new))
            if self.kind == WORD:
                self.known = Known(distinct, sums)
                yield _said(WORD, self.part, TABLE, -1, _blobs(distinct, np.array([0, len(distinct)])), _blobs(sums, np.array([0, len(sums)])), len(distinct))
            else:
                level = levels_of(sums)
                self.bits = filled(distinct, level)
                yield _said(PAIR, self.part, TABLE, -1, _blobs(self.bits, np.array([0, len(self.bits)])), None, len(self.bits))
        if self.kind == WORD:
            got = sums if step == COUNTED else self.known.of(distinct)
        else:
            got = probe(self.bits, segment_of(distinct, len(self.bits)), distinct, level if step == COUNTED else None)
        out = np.empty(len(key), got.dtype)
        out[order] = got[at]
        yield _said(self.kind, self.part, step, slices.to_numpy(), _blobs(out, cuts))


def answered(slices: DataFrame, parts: dict[int, int], tables: list[DataFrame]) -> DataFrame:
    """Rows of SHAPE, stored: by slice, kind and part the counts of words and the levels of pairs, for the slice's distinct ones as they ascend, and the tables of what was counted. parts: their numbers, of the kinds to be asked for; tables: rows of SHAPE of an earlier call, if slices aren't counted."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (number, learned) in enumerate(zip(b.column("slice").to_pylist(), b.column("learned").to_pylist(), strict=True)):
                sizes, words, hashes = _row(b, i)
                for kind, many in parts.items():
                    if kind == WORD:
                        order = np.argsort(hashes)
                        key, n = hashes[order], np.bincount(words, minlength=len(hashes))[order]
                    else:
                        key, n = np.unique(_pairs(sizes, words, hashes), return_counts=True)
                    part = part_of(kind, key, many)
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    cuts = np.r_[first, len(key)]
                    yield _said(kind, part[first], COUNTED if learned else ASKED, number, _blobs(key if kind == WORD else _pack(key), cuts), _blobs(n.astype(np.uint32), cuts) if learned else None)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Reads a sorted partition: by part its table, what is counted, what is asked; the last as it comes, so that its size doesn't matter."""
        now, own, held, size = None, None, [], 0
        for b in batches:
            if not len(b):
                continue
            by = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("kind", "part", "step")])
            cuts = np.r_[0, np.flatnonzero((by[:, 1:] != by[:, :-1]).any(axis=0)) + 1, len(b)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                kind, part, step = by[:, lo].tolist()
                if held and ((kind, part, step) != own or step == ASKED and size > 8 * WORDS_PART):
                    yield from now.take(own[2], held)
                    held, size = [], 0
                if now is None or (kind, part) != (now.kind, now.part):
                    now = Part(kind, part)
                own = kind, part, step
                held.append(b.slice(lo, hi - lo))
                size += len(_bytes(held[-1].column("key"))[0])
        if held:
            yield from now.take(own[2], held)

    rows = slices.select("slice", "learned", "sizes", "words", "hashes").mapInArrow(ask, SHAPE)
    for table in tables:
        rows = rows.union(table)
    # a partition for each part
    at = F.col("part") + F.when(F.col("kind") == PAIR, parts.get(WORD, 0)).otherwise(0)
    rows = rows.repartitionById(sum(parts.values()), at).sortWithinPartitions("kind", "part", "step")
    return stored(rows.mapInArrow(answer, SHAPE), "answers")


def _read(batches: Iterator[pa.RecordBatch], m: Model):
    """(doc_ids, sizes, count and level of each word) of a few documents at a time, from what is broadcast."""
    words = Words(m.look.of)
    for b in _slices(batches):
        ids, sizes = words.read(b.column("text").to_pylist())
        yield b.column("doc_id"), sizes, *found(ids, sizes, words.hash, words.count, m.filter, m.texts)


def looked_up(slices: DataFrame, said: DataFrame, many: int, model: Model) -> DataFrame:
    """(learned, ids, sizes, count, level): a row per few documents of the slices, whose number is many, with the count of each of their words and the level of each pair. said: as answered() gives it; what isn't asked there comes from the model."""
    shared = slices.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, slice_, said = shared.value, None, {WORD: [], PAIR: []}

        def rows() -> Iterator[pa.RecordBatch]:
            learned, ids, sizes, words, hashes = slice_
            counts = np.empty(len(hashes), np.int64)
            counts[np.argsort(hashes)] = m.look.of(np.sort(hashes)) if m.look else np.concatenate(said[WORD]).view(np.int64)
            key = _pairs(sizes, words, hashes)
            order = np.argsort(key)
            new = np.diff(key[order], prepend=~key[order[:1]]) != 0
            got = m.filter.of(key[order[new]]) if m.filter else np.concatenate(said[PAIR])
            level = np.empty(len(key), np.uint8)
            level[order] = got[np.cumsum(new) - 1]
            before, count = firsts(words, sizes), counts[words]
            level[(count == 0) | (np.where(before < 0, m.texts, counts[before]) == 0)] = 0
            ends = np.cumsum(sizes)
            last = np.r_[np.flatnonzero(np.diff((ends - 1) // SOME)), len(sizes) - 1]
            for lo, hi in zip(np.r_[0, last[:-1] + 1], last + 1, strict=True):
                at = slice(ends[lo] - sizes[lo], ends[hi - 1])
                kinds = (np.int64, np.uint32 if m.tokens < 1 << 32 else np.int64, np.uint8)
                blobs = [_zip(x.astype(k)) for x, k in zip((sizes[lo:hi], count[at], level[at]), kinds, strict=True)]
                own = ids.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([pa.array([learned]), pa.ListArray.from_arrays([0, len(own)], own), *blobs], ["learned", "ids", "sizes", "count", "level"])

        for b in batches:
            if not len(b):
                continue
            by = np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("slice", "kind")])
            cuts = np.r_[0, np.flatnonzero((by[:, 1:] != by[:, :-1]).any(axis=0)) + 1, len(b)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if by[1, lo]:
                    said[int(by[1, lo])].append(_bytes(b.column("key").slice(lo, hi - lo))[0])
                    continue
                if slice_:
                    yield from rows()
                slice_, said = (b.column("learned")[lo].as_py(), b.column("ids")[lo].values, *_row(b, lo)), {WORD: [], PAIR: []}
        if slice_:
            yield from rows()

    own = slices.select("slice", F.lit(0).cast("byte").alias("kind"), F.lit(0).alias("part"), "learned", "ids", "sizes", "words", "hashes", F.lit(None).cast("binary").alias("key"))
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("learned", "ids", "sizes", "words", "hashes")]
    rows = own.union(said.where("slice >= 0").select("slice", "kind", "part", *none, "key"))
    rows = rows.repartition(max(1, many), "slice").sortWithinPartitions("slice", "kind", "part")
    return rows.mapInArrow(work, "learned boolean, ids array<long>, sizes binary, count binary, level binary")


def _found(batches: Iterator[pa.RecordBatch], m: Model):
    """(doc_ids, sizes, count, level) of the rows of looked_up, as _read gives them."""
    for b in batches:
        for i in range(len(b)):
            ids = b.column("ids")[i].values
            sizes = _unzip(b.column("sizes")[i], np.int64, len(ids))
            count = _unzip(b.column("count")[i], np.uint32 if m.tokens < 1 << 32 else np.int64, sizes.sum())
            yield ids, sizes, count.astype(np.int64), _unzip(b.column("level")[i], np.uint8, len(count))


def tune(model: Model, looked: DataFrame) -> np.ndarray:
    """Shares of pairs by magnitude: expectation steps over all training texts, as looked_up gives them, each left out of the counts."""
    shared = looked.sparkSession.sparkContext.broadcast(replace(model, look=None, filter=None))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bins = shared.value, np.zeros(64_000, np.int64)
        for _, sizes, count, level in _found(batches, m):
            one, pair, magnitude = m.parts(sizes, count, level, 1)
            # texts give triples in bins: only how the pair compares with the word matters for the share
            ratio = np.clip(np.round(8 * np.log2(np.maximum(pair, 1e-12) / np.maximum(one, 1e-12))), -400, 400).astype(np.int64)
            bins += np.bincount(magnitude * 1000 + ratio + 400, minlength=len(bins))
        key = np.flatnonzero(bins)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bins[key])], ["key", "n"])

    bins = looked.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    share, mag, ratio, many = np.full(64, 0.3), bins["key"].to_numpy(np.int64) // 1000, 2.0 ** ((bins["key"].to_numpy(np.int64) % 1000 - 400) / 8), bins["n"].to_numpy(float)
    for _ in range(30):
        own = share[mag] * ratio / (share[mag] * ratio + 1 - share[mag])
        total = np.bincount(mag, many, 64)
        share = (np.bincount(mag, many * own, 64) + 0.3) / (total + 1)
    return np.clip(share, 0.001, 0.95)


def learned_from(slices: DataFrame) -> tuple[Model, DataFrame, dict[int, int], DataFrame]:
    """(model, answers, parts, looked): a model of the slices that are `learned`, with what answered() says of all slices and its numbers of parts, and all slices looked up in it, stored."""
    own = F.sum(F.when(F.col("learned"), F.col("own")))
    many, n, texts, own = slices.agg(F.count("*"), *(F.coalesce(x, F.lit(0)) for x in (F.sum(F.when(F.col("learned"), F.col("tokens"))), F.sum(F.when(F.col("learned"), F.size("ids"))), own))).first()
    parts = {WORD: max(1, -(-own // WORDS_PART)), PAIR: max(1, -(-n * BITS // (PART * SEGMENT)))}  # no more entries than words
    said = answered(slices, parts, [])
    v = said.where(f"step = {TABLE} and kind = {WORD}").agg(F.coalesce(F.sum("many"), F.lit(0))).first()[0]
    model = Model(n, v, texts, np.full(64, 0.3), None, None)
    looked = stored(looked_up(slices, said, many, model), "found")
    model.share = tune(model, looked.where("learned"))
    return model, said, parts, looked


def fit(training: DataFrame, max_vocabulary: int = 8_000_000, max_bits: int = 1 << 30) -> tuple[Model, Tables]:
    """(model, tables): a model of all training texts (doc_id, text), and what it needs besides where that is too large to broadcast.

    Words are known by XXH64. max_vocabulary bounds the word table that is broadcast and max_bits the
    filter; larger ones stay on the executors and are asked there, so no word and no pair is left
    out, those that occur once included. Texts of null count as empty; of no texts, all words are unknown.
    """
    slices = stored(_prepared(training, True), "slices")
    model, said, parts, looked = learned_from(slices)
    words, bits = (said.where(f"step = {TABLE} and kind = {kind}") for kind in (WORD, PAIR))
    tables = Tables(None, parts[WORD], None, parts[PAIR])
    if model.words <= max_vocabulary:
        rows = words.select("key", "n").toArrow()
        hashes, n = (np.concatenate([np.zeros(0, np.uint8), *(_bytes(c)[0] for c in rows[name].chunks if len(c))]) for name in ("key", "n"))
        hashes, n = hashes.view(np.uint64), n.view(np.int64)
        order = np.argsort(hashes)
        model.look = Known(hashes[order], n[order])
    else:
        tables.words = stored(words, "words")
    if bits.agg(F.coalesce(F.sum("many"), F.lit(0))).first()[0] * SEGMENT <= max_bits:
        model.filter = gathered([(r.part, np.frombuffer(bytes(r.key), np.uint8).reshape(-1, SEGMENT // 8)) for r in bits.select("part", "key").toLocalIterator()], parts[PAIR])
    else:
        tables.bits = stored(bits, "segments")
    for table in (slices, said, looked):
        forget(table)
    return model, tables


def score_documents(docs: DataFrame, model: Model, tables: Tables) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score per row.

    base_score sums the words' log10 frequencies, add-one smoothed; score is the model's log10
    probability. A null or empty text is one end, long texts are read whole. Repeated rows come out
    repeated, an empty table gives an empty one, other columns are ignored. tables: as fit() gives them.
    """
    parts = tables.asked()
    if not parts:
        return _scored(_texts(docs), model, _read)
    slices = stored(_prepared(docs, False), "slices")
    said = answered(slices, parts, [x for x in (tables.words, tables.bits) if x is not None])
    return _scored(looked_up(slices, said, slices.count(), model), replace(model, look=None, filter=None), _found)


def _scored(rows: DataFrame, model: Model, read) -> DataFrame:
    """score_documents of the documents that read(batches, model) gives."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for names, sizes, count, level in read(batches, m):
            if len(sizes):
                known, base, score = m.scores(sizes, count, level)
                yield pa.RecordBatch.from_arrays([names, pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), m.tokens, np.int64)), pa.array(base), pa.array(score)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(work, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def fit_and_score(docs: DataFrame, learned: Column) -> DataFrame:
    """score_documents of docs by a model of those that are `learned`, whose words and pairs are counted and looked up together; nothing is broadcast."""
    slices = stored(_prepared(docs.where(learned), True).union(_prepared(docs.where(~learned), False)), "slices")
    model, said, _, looked = learned_from(slices)
    for table in (slices, said):
        forget(table)
    return _scored(looked, model, _found)


def held_out(doc_id: str = "doc_id"):
    """True for the seventh of the documents that is never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 7 == 2, F.lit(False))


def op4_ngrams(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fit_and_score(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op4_ngrams": op4_ngrams}
ORACLES: dict[str, str] = {}
