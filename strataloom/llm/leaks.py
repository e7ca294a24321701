"""Benchmark decontamination: an FM-index per shard of documents, asked for the windows of the benchmark's items.

A task lays the words of its documents end to end, with a separator for every run of words that
no item has, sorts the suffixes, and keeps the words before them in a wavelet tree. A window is
found by backward search; its places come from sampled suffix positions; places that overlap or
touch make one span of the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import forget, stored

#: One word, once A to Z are lower-cased.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Words of a piece besides its overlap with the next one; symbols of a shard; every how many positions one is kept.
PIECE, SHARD, KEPT = 96, 1 << 19, 8
#: Bytes of texts read at a time; bytes and rows that a task holds until their shard is asked.
READ, HELD, ROWS = 4 << 20, 32 << 20, 20_000
#: Windows of the benchmark that are broadcast at a time; places looked up at a time.
WINDOWS, PLACES = 1 << 18, 1 << 20
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Bytes of words as they are compared, 0 for all others. Every byte of a character beyond ASCII belongs to a word.
_FOLD = np.array([c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 0 for c in range(256)], np.uint8)


@dataclass
class Phrases:
    """Distinct windows of some items: their words (numbers in vocabulary, -1 behind the last), and the items that each is of."""

    vocabulary: list[bytes]
    words: np.ndarray
    sizes: np.ndarray
    items: list[str]
    item_at: np.ndarray
    item_of: np.ndarray


class Index:
    """FM-index of pieces of word numbers: suffixes in order, a wavelet tree of the words before them, sampled positions."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """words: all pieces end to end; starts, sizes: of the pieces. Each piece gets a separator of its own behind it."""
        pieces, n = len(sizes), int(sizes.sum()) + len(sizes)
        self.start = np.cumsum(sizes + 1) - sizes - 1
        self.known = np.unique(words)
        text = np.empty(n, np.int64)
        ends = self.start + sizes
        text[ends] = np.arange(pieces)
        inner = np.ones(n, bool)
        inner[ends] = False
        self.source = np.repeat(starts - self.start, sizes + 1) + np.arange(n)
        text[inner] = pieces + np.searchsorted(self.known, words[self.source[inner]])
        order = _suffixes(text)
        before = np.maximum(text[order - 1] - pieces + 1, 0)  # separators are 0; the one before the first piece is the last
        self.first = np.r_[0, pieces + np.cumsum(np.r_[0, np.bincount(text[inner] - pieces, minlength=len(self.known))])]
        self.tree = Tree(before, int(len(self.known)).bit_length())
        head = np.zeros(n, bool)
        head[self.start] = True
        kept = head[order] | (order % KEPT == 0)  # a walk back never leaves its piece
        self.kept, self.place = Bits(kept), order[kept]

    def ranges(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes [low, high) that begin with each phrase (rows of word numbers)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.tree.n, np.int64)
        at = np.searchsorted(self.known, phrases)
        there = self.known[np.minimum(at, len(self.known) - 1)] == phrases
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero((step < sizes) & (low < high))
            col = sizes[live] - 1 - step
            c, ok = at[live, col] + 1, there[live, col]
            low[live[~ok]] = high[live[~ok]] = 0
            live, c = live[ok], c[ok]
            low[live], high[live] = self.first[c] + self.tree.rank(c, low[live]), self.first[c] + self.tree.rank(c, high[live])
        return low, high

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text at which these suffixes begin."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.kept.get(at))
        while len(open_):
            c, rank = self.tree.access(at[open_])
            at[open_] = self.first[c] + rank
            steps[open_] += 1
            open_ = open_[~self.kept.get(at[open_])]
        return self.place[self.kept.rank(at)] + steps


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes. Every suffix ends in a separator of its own, so all differ.

    Ranks by 1, 3, 9 ... symbols come from those by a third as many; only what is still tied is sorted again.
    """
    n = len(text)
    rank = np.zeros(n + 1, np.int64)
    rank[:n] = text
    order, slots, depth = np.arange(n), np.arange(n), 1
    bits = max(int(n + 1).bit_length(), int(text.max(initial=0)).bit_length())
    each = 3 if 3 * bits <= 63 else 2
    while len(slots):
        who = order[slots]
        key = rank[who]
        for k in range(1, each):
            key = (key << bits) | rank[np.minimum(who + k * depth, n)]
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[slots] = who
        new = np.r_[True, key[1:] != key[:-1]]
        # a rank is the slot of the first of the group; those of the groups sorted before stay in between
        rank[who] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        alone = new & np.r_[new[1:], True]
        slots = slots[~alone]
        depth *= each
    return order


class Bits:
    """Bits with counts before every 64 of them."""

    def __init__(self, flags: np.ndarray):
        self.words = np.zeros(len(flags) // 64 + 1, np.uint64)
        packed = np.packbits(flags, bitorder="little")
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & below)


class Tree:
    """Wavelet tree over numbers of that many bits, laid out level by level: zeros of a level go before its ones."""

    def __init__(self, values: np.ndarray, depth: int):
        self.n, self.depth, self.levels = len(values), max(1, depth), []
        for k in range(self.depth - 1, -1, -1):
            one = (values >> k) & 1 == 1
            self.levels.append((k, Bits(one), self.n - int(one.sum())))
            values = np.r_[values[~one], values[one]]
        c = np.arange(1 << self.depth)
        self.begin = self._down(c, np.zeros(len(c), np.int64))

    def _down(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((c >> k) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, c: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often c stands before each place."""
        return self._down(c, at) - self.begin[c]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number at each place, and how often it stands before it."""
        c = np.zeros(len(at), np.int64)
        for k, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            c |= one.astype(np.int64) << k
            at = np.where(one, zeros + ones, at - ones)
        return c, at - self.begin[c]


def _tokens(data: np.ndarray, cuts: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end from the bytes `cuts` on: each word's number in the vocabulary (-1: none), its first byte, and the byte behind it."""
    found = []
    at = 0
    while at < len(data):
        to = min(len(data), at + READ)
        if to < len(data):  # not inside a word, unless a text ends there
            gap = np.flatnonzero(_FOLD[data[at:to]] == 0)
            text = cuts[(cuts > at) & (cuts <= to)]
            to = max(at + int(gap[-1]) + 1 if len(gap) else 0, int(text[-1]) if len(text) else 0)
            if to <= at:  # one long word
                gap = np.flatnonzero(_FOLD[data[at:]] == 0)
                text = cuts[cuts > at]
                to = min(at + int(gap[0]) + 1 if len(gap) else len(data), int(text[0]) if len(text) else len(data))
        low = _FOLD[data[at:to]]
        word = low != 0
        edge = np.zeros(to - at + 1, bool)
        inside = cuts[(cuts >= at) & (cuts <= to)] - at
        edge[inside] = True
        edge[[0, -1]] = True
        starts = np.flatnonzero(word & (edge[:-1] | ~np.r_[False, word[:-1]]))
        ends = np.flatnonzero(word & (edge[1:] | ~np.r_[word[1:], False])) + 1
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[word])])
        numbers = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
        found.append((numbers.astype(np.int32), starts + at, ends + at))
        at = to
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column's texts end to end, and where each begins and the last one ends."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _pieces(known: np.ndarray, bounds: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of pieces that hold every window of known words. bounds: first word of each text, and the end.

    Runs of fewer known words than the shortest window hold none. Long runs are cut into pieces
    that overlap by one word less than the longest window, which bounds how deep suffixes can agree.
    """
    edge = np.zeros(len(known) + 1, bool)
    edge[bounds] = True
    first = np.flatnonzero(known & (edge[:-1] | ~np.r_[False, known[:-1]]))
    size = np.flatnonzero(known & (edge[1:] | ~np.r_[known[1:], False])) + 1 - first
    first, size = first[size >= least], size[size >= least]
    many = np.maximum(1, -(-(size - most + 1) // PIECE))
    k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    begin = np.repeat(first, many) + k * PIECE
    size = np.minimum(np.repeat(first + size, many) - begin, PIECE + most - 1)
    return np.searchsorted(bounds, begin, side="right") - 1, begin, size


def merge(spans: np.ndarray) -> np.ndarray:
    """Spans (text, from word, to word, from character, to character) joined where they overlap or touch, in order."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = 1 << 40
    end = np.maximum.accumulate(spans[:, 0] * far + spans[:, 2])
    new = np.r_[True, spans[1:, 0] * far + spans[1:, 1] > end[:-1]]
    heads = np.flatnonzero(new)
    out = spans[heads].copy()
    out[:, 2], out[:, 4] = np.maximum.reduceat(spans[:, 2], heads), np.maximum.reduceat(spans[:, 4], heads)
    return out


def _ask(phrases: Phrases, words: np.ndarray, text: np.ndarray, begin: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged spans and distinct (text, item) pairs of one shard. begin: the pieces' first words in their texts; starts: in words; chars: where words begin and end."""
    index = Index(words, starts, sizes)
    low, high = index.ranges(phrases.words, phrases.sizes)
    there = np.flatnonzero(low < high)
    spans, pairs = [np.zeros((0, 5), np.int64)], [np.zeros((0, 2), np.int64)]
    count, at = (high - low)[there], 0
    total = np.cumsum(count)
    for at in range(0, int(total[-1]) if len(total) else 0, PLACES):
        nth = np.arange(at, min(at + PLACES, int(total[-1])))
        which = np.searchsorted(total, nth, side="right")
        phrase = there[which]
        place = index.places(low[phrase] + nth - (total - count)[which])
        piece = np.searchsorted(index.start, place, side="right") - 1
        first = begin[piece] + place - index.start[piece]
        size = phrases.sizes[phrase]
        source = index.source[place]
        spans.append(merge(np.stack([text[piece], first, first + size, chars[source, 0], chars[source + size - 1, 1]], axis=1)))
        seen = np.unique(np.stack([text[piece], phrase], axis=1), axis=0)
        many = phrases.item_at[seen[:, 1] + 1] - phrases.item_at[seen[:, 1]]
        k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(phrases.item_at[seen[:, 1]], many)
        pairs.append(np.unique(np.stack([np.repeat(seen[:, 0], many), phrases.item_of[k]], axis=1), axis=0))
    return merge(np.concatenate(spans)), np.unique(np.concatenate(pairs), axis=0)


#: What the search says of a text: n_words, spans of words and of characters (from 0, ends exclusive), and the items found.
FOUND = "n_words long, spans array<struct<word:long,word_end:long,char:long,char_end:long>>, items array<string>"
_SPAN = pa.struct([(c, pa.int64()) for c in ("word", "word_end", "char", "char_end")])


def _search(held):
    """Reads rows, texts and what blocks of the benchmark before this one have found; adds what this one finds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = held.value
        vocabulary = pa.array(phrases.vocabulary, pa.binary())
        least, most = int(phrases.sizes.min(initial=1 << 30)), int(phrases.sizes.max(initial=1))
        kept: list = []
        room = [0, 0, 0]

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches([k[0] for k in kept]).combine_chunks()
            base = np.cumsum([0, *(k[0].num_rows for k in kept)])
            n_words = np.concatenate([k[1] for k in kept])
            words, chars = np.concatenate([k[2] for k in kept]), np.concatenate([k[3] for k in kept])
            text = np.concatenate([k[4] + b for k, b in zip(kept, base, strict=False)])
            begin, sizes = np.concatenate([k[5] for k in kept]), np.concatenate([k[6] for k in kept])
            starts = np.cumsum(sizes) - sizes
            spans, pairs = [], []
            shard = np.cumsum(sizes + 1) // SHARD
            cuts = np.flatnonzero(np.r_[shard[:-1] != shard[1:], True]) + 1 if len(sizes) else []
            for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
                own = slice(int(starts[a]), int(starts[b - 1] + sizes[b - 1]))
                s, p = _ask(phrases, words[own], text[a:b], begin[a:b], starts[a:b] - starts[a], sizes[a:b], chars[own])
                spans.append(s)
                pairs.append(p)
            before = rows.column("spans").combine_chunks()
            if before.null_count < len(before):
                row = np.repeat(np.arange(len(before)), pc.fill_null(pc.list_value_length(before), 0).to_numpy(zero_copy_only=False))
                flat = before.flatten()
                spans.append(np.stack([row, *(flat.field(c).to_numpy(zero_copy_only=False) for c in ("word", "word_end", "char", "char_end"))], axis=1))
            spans = merge(np.concatenate([np.zeros((0, 5), np.int64), *spans]))
            pairs = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0)
            names: dict[int, set] = {}
            for r, items in enumerate(rows.column("items").to_pylist()) if before.null_count < len(before) else ():
                if items:
                    names[r] = set(items)
            for r, i in pairs.tolist():
                names.setdefault(r, set()).add(phrases.items[i])
            items = pa.array([sorted(names[r]) if r in names else [] for r in range(rows.num_rows)], pa.list_(pa.string()))
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(spans[:, 0], minlength=rows.num_rows))].astype(np.int32))
            flat = pa.StructArray.from_arrays([pa.array(spans[:, k]) for k in range(1, 5)], fields=list(_SPAN))
            out = [rows.column("row").combine_chunks(), rows.column("text").combine_chunks(), pa.array(n_words), pa.ListArray.from_arrays(offsets, flat), items]
            kept.clear()
            room[:] = [0, 0, 0]
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out], ["row", "text", "n_words", "spans", "items"])

        for batch in batches:
            data, cuts = _texts(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + READ, side="right")) - 1)
                some, own = data[cuts[at] : cuts[to]], cuts[at : to + 1] - cuts[at]
                number, first, end = _tokens(some, own[:-1], vocabulary)
                bounds = np.searchsorted(first, own)
                text, begin, sizes = _pieces(number >= 0, bounds, least, most)
                k = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                # characters before a byte: bytes that don't continue one
                chars = np.zeros((len(k), 2), np.int64)
                if len(k):
                    upto = np.r_[0, np.cumsum((some & 0xC0) != 0x80)]
                    chars = np.stack([upto[first[k]], upto[end[k]]], axis=1) - np.repeat(upto[own[text]], sizes)[:, None]
                kept.append((batch.slice(at, to - at), np.diff(bounds).astype(np.int64), number[k], chars, text, begin - bounds[text], sizes))
                room = [a + b for a, b in zip(room, (len(some), to - at, len(k) + len(sizes)), strict=True)]
                at = to
                if room[0] >= HELD or room[1] >= ROWS or room[2] >= SHARD:
                    yield done()
        if kept:
            yield done()

    return work


def phrases_of(items: DataFrame, window: int = WINDOW, most: int = WINDOWS) -> Iterator[Phrases]:
    """Windows of all items (item_id, text), in blocks of about `most`, so that the driver and a broadcast hold a bounded part."""

    def block(found: dict[tuple, set]) -> Phrases:
        vocabulary: dict[str, int] = {}
        names: dict[str, int] = {}
        words = np.full((len(found), window), -1, np.int32)
        item_of, item_at = [], [0]
        for r, (phrase, of) in enumerate(found.items()):
            words[r, : len(phrase)] = [vocabulary.setdefault(w, len(vocabulary)) for w in phrase]
            item_of += sorted(names.setdefault(i, len(names)) for i in of)
            item_at.append(len(item_of))
        return Phrases([w.encode() for w in vocabulary], words, np.array([len(p) for p in found], np.int64), list(names), np.array(item_at), np.array(item_of, np.int64))

    found: dict[tuple, set] = {}
    held = 0
    for r in items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").toLocalIterator():
        words = re.findall(TOKEN, (r.text or "").translate(_LOWER))
        for at in range(max(1, len(words) - window + 1) if words else 0):
            of = found.setdefault(tuple(words[at : at + window]), set())
            held += r.item_id not in of
            of.add(r.item_id)
            if held >= most:
                yield block(found)
                found, held = {}, 0
    if found:
        yield block(found)


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = WINDOWS) -> DataFrame:
    """(row, text, n_words, spans, items) of each document: row holds its columns, spans what occurs of the items, items whose.

    docs: text and any other columns, which may have any names; items: item_id, text. A word is a
    run of anything but ASCII characters other than letters and digits, A to Z lower-cased. A
    window is `window` consecutive words of an item, or all words of one with fewer; items without
    words have none. spans are merged and in order, by words and by code points of the text, from
    0, ends exclusive. items are distinct item_ids as texts in order, "null" for a null one. A null
    text has no words; repeated rows come back as often. Empty tables give empty results.

    Documents stay where they are: nothing is shuffled. The benchmark is broadcast in blocks of
    about `most` windows; each block is one pass over the documents, written in between.
    """
    spark: SparkSession = docs.sparkSession
    shape = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    kind = shape.schema["row"].dataType.simpleString()
    now = shape.select("row", "text", *[F.lit(None).cast(t).alias(n) for n, t in (c.split(" ", 1) for c in FOUND.split(", "))])
    blocks = phrases_of(items, window, most)
    block = next(blocks, None) or Phrases([], np.zeros((0, window), np.int32), np.zeros(0, np.int64), [], np.zeros(1, np.int64), np.zeros(0, np.int64))
    while block is not None:
        before, after = now, next(blocks, None)
        now = now.mapInArrow(_search(spark.sparkContext.broadcast(block)), f"row {kind}, text string, {FOUND}")
        if after is not None:
            now = stored(now, "leaks")
            if hasattr(before, "_written_at"):
                forget(before)
        block = after
    return now


def hit_words() -> Column:
    """Number of words in the spans of find_leaks."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.word_end - s.word)


def remove_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = WINDOWS) -> DataFrame:
    """docs with the spans that occur in the items cut out of their texts; what stood around a span stays. See find_leaks."""
    found = find_leaks(docs, items, window, most)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s.char_end))
    ends = F.concat(F.transform("spans", lambda s: s.char), F.array(F.lit(None).cast("long")))
    cut = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.substring(F.col("text"), (s.a + 1).cast("int"), F.coalesce(s.b - s.a, F.length("text")).cast("int")))
    text = F.when(F.size("spans") > 0, F.array_join(cut, "")).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*[(F.col("text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op11_leaks(spark, sf_dir: str) -> DataFrame:
    """Benchmark words and items in all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    hit = hit_words()
    return find_leaks(docs, items).select(
        "row.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


QUERIES = {"op11_leaks": op11_leaks}
ORACLES = {
    "op11_leaks": f"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i : i + 9] AS p FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM documents),
ng AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS p FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT len(p) AS n FROM win))),
o AS MATERIALIZED (SELECT ng.r, ng.i, ng.n, win.item_id FROM ng JOIN win ON ng.p = array_to_string(win.p, ' ')),
h AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM o) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT r, item_id FROM o) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)"""
}
