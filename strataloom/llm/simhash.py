"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. Two fingerprints that differ in at most 3 bits differ in at most 1 bit
in one of their 32-bit halves. In each half the anchors are the words of the perfect Hamming code
on bits 0 to 30 with bit 31 free: a covering code of radius 1. A half within 1 bit of another is
within 1 + 1 = 2 bits of the other's nearest anchor, so each fingerprint goes to every anchor
within 2 bits (17 at most) and marks its nearest one as home; pairs with one side at home are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import connected_components, row_hash, stored

#: Members of an anchor that one task compares at once; larger anchors go to pairs of chunks of this size.
CHUNK = 16_384
#: Seed of XXH64.
SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as an unsigned 64-bit number; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: len(words) - shingle].tolist()]
        parts = [joined[a:b] for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(p, SEED) for p in parts), dtype="<u8", count=len(parts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        ones += np.unpackbits(h[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the long columns named in `more`: one row per document; fp holds the 64 bits as a signed long. No shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column("text").to_pylist()), np.uint64, len(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64)), *[b.column(c) for c in more]], ["doc_id", "fp", *more])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more).mapInArrow(work, ", ".join(["doc_id long, fp long", *[f"{c} long" for c in more]]))


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, home) of all anchors near each fingerprint; key names the half and the anchor."""
    fp = fp.view(np.uint64)
    n, keys, rows, homes = len(fp), [], [], []
    column = np.arange(1, 32, dtype=np.uint64)
    bit = np.uint64(1) << np.arange(31, dtype=np.uint64)
    for half in range(2):
        part = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        syndrome = np.zeros(n, np.uint64)
        for i in range(31):
            syndrome ^= np.where((part >> np.uint64(i)) & np.uint64(1), column[i], np.uint64(0))
        off = syndrome != 0
        home = part.copy()
        home[off] ^= bit[syndrome[off].astype(int) - 1]
        tag = np.uint64(half) << np.uint64(32)
        for at, own in ((home, True), (home ^ np.uint64(1 << 31), False)):
            keys.append(at | tag)
            rows.append(np.arange(n))
            homes.append(np.full(n, own))
        # codewords at distance 2: flip columns i < j with i xor j = syndrome
        who = np.flatnonzero(off)
        for i in range(1, 32):
            j = syndrome[who] ^ np.uint64(i)
            ok = j > i
            w = who[ok]
            keys.append((part[w] ^ bit[i - 1] ^ bit[j[ok].astype(int) - 1]) | tag)
            rows.append(w)
            homes.append(np.zeros(len(w), bool))
    return np.concatenate(keys).view(np.int64), np.concatenate(rows), np.concatenate(homes)


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reduce edges to a star per connected component, so that a large group doesn't emit all its pairs."""
    if not len(a):
        return a, b
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[: len(a)], idx[len(a) :]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        m = np.minimum(label[x], label[y])
        np.minimum.at(label, x, m)
        np.minimum.at(label, y, m)
        np.minimum.at(label, old[x], m)
        np.minimum.at(label, old[y], m)
        label = label[label]
        if (label == old).all():
            break
    keep = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[keep]], nodes[keep]


def compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Star edges within each anchor. Rows are sorted by key, those at home first, so a pair's first row is at home.

    side: chunk of each row; with it, only pairs across two chunks count.
    """
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, len(key)])
    rest = np.repeat(first + size, size) - np.arange(len(key))  # rows of the anchor from this one on
    out_a, out_b, held = [fp[:0]], [fp[:0]], 0
    small = np.repeat(size <= 64, size)
    at, k = np.flatnonzero(small & home & (rest > 1)), 1
    while len(at):
        ok = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= bits] if side is None else at[(np.bitwise_count(fp[at] ^ fp[at + k]) <= bits) & (side[at] != side[at + k])]
        out_a.append(fp[ok])
        out_b.append(fp[ok + k])
        k += 1
        at = at[rest[at] > k]
    for r in np.flatnonzero(~small & home & (rest > 1)):
        j = slice(r + 1, r + rest[r])
        near = np.bitwise_count(fp[j] ^ fp[r]) <= bits
        if side is not None:
            near &= side[j] != side[r]
        found = fp[j][near]
        out_a.append(np.full(len(found), fp[r]))
        out_b.append(found)
        held += len(found)
        if held > 1_000_000:
            a, b = star_edges(np.concatenate(out_a), np.concatenate(out_b))
            out_a, out_b, held = [a], [b], 0
    return star_edges(np.concatenate(out_a), np.concatenate(out_b))


PAIRS = "deferred boolean, a long, b long, home boolean, chunk int"


def _frame(deferred: bool, a: np.ndarray, b: np.ndarray, home: np.ndarray | bool = False, chunk: int = 0) -> pd.DataFrame:
    return pd.DataFrame({"deferred": deferred, "a": a.view(np.int64), "b": b.view(np.int64), "home": home, "chunk": np.int32(chunk)})


def _within(bits: int, most: int):
    """Compares whole anchors of a sorted partition. The rows of an anchor over `most` come out again, numbered by chunk."""

    def work(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry, open_key, chunk = None, None, 0

        def edges(part: pd.DataFrame) -> pd.DataFrame:
            a, b = compare(part["key"].to_numpy(), part["fp"].to_numpy().view(np.uint64), part["home"].to_numpy(), bits)
            return _frame(False, a, b)

        def defer(part: pd.DataFrame) -> pd.DataFrame:
            return _frame(True, part["key"].to_numpy(), part["fp"].to_numpy(), part["home"].to_numpy(), chunk)

        for pdf in pdfs:
            if open_key is not None:
                n = int((pdf["key"] == open_key).sum())
                if n:
                    yield defer(pdf.iloc[:n])
                    chunk += 1
                if n == len(pdf):
                    continue
                pdf, open_key = pdf.iloc[n:], None
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            cut = int(np.searchsorted(pdf["key"].to_numpy(), pdf["key"].iloc[-1]))
            if cut:
                yield edges(pdf.iloc[:cut])
            carry = pdf.iloc[cut:]
            if len(carry) > most:
                open_key, chunk = carry["key"].iloc[0], 0
                yield defer(carry)
                carry, chunk = None, 1
        if carry is not None and len(carry):
            yield edges(carry)

    return work


def _across(bits: int):
    """Compares the two chunks of one large anchor (or one chunk with itself)."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("home", ascending=False)
        side = None if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf["chunk"].to_numpy()
        a, b = compare(pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(), bits, side)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return work


def near_pairs(fps: DataFrame, bits: int = 3, most: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within `bits` (3 at most) of each other; fps: distinct `fp`.

    Within an anchor only a star per connected set comes out, so edges grow with rows, not pairs.
    An anchor of over `most` rows is cut into chunks that are compared pair by pair in tasks of their own.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3: anchors cover one differing bit in a half")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 4096):
                part = fp[i : i + 4096]
                key, row, home = anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[row]), pa.array(home)], ["key", "fp", "home"])

    rows = fps.select("fp").mapInArrow(spread, "key long, fp long, home boolean")
    found = stored(rows.repartition("key").sortWithinPartitions("key", F.desc("home")).mapInPandas(_within(bits, most), PAIRS), "anchors")
    rest = found.where("deferred").select(F.col("a").alias("key"), F.col("b").alias("fp"), "home", "chunk")
    last = rest.groupBy("key").agg(F.max("chunk").alias("last"))
    other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    pairs = rest.join(last, "key").select("*", other).select("key", "fp", "home", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    large = pairs.groupBy("key", "i", "j").applyInPandas(_across(bits), "a long, b long")
    return found.where("not deferred").select("a", "b").union(large)


def _classes(rows: DataFrame, bits: int) -> DataFrame:
    """(fp, first, root), stored, of stored fingerprints: the smallest doc_id of each fp, and what names its class."""
    firsts = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    linked = connected_components(near_pairs(firsts, bits))
    return stored(firsts.join(linked, firsts.fp == linked.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root")), "classes")


def simhash_classes(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) per document: component_id is the smallest doc_id reachable over links.

    A null or empty text has fingerprint zero and links like any other; a null doc_id never
    names a component unless no other member has an id. Repeated rows keep one output row each.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    classes = _classes(rows, bits)
    heads = stored(classes.groupBy("root").agg(F.min("first").alias("component_id")), "heads")
    ids = stored(classes.join(heads, "root").select("fp", "component_id"), "ids")
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One row of docs per class: the one with the smallest doc_id, of those the one with the smallest hashes of text and row.

    A row without a doc_id stands for a class only if no row of the class has one. A null or empty
    text has fingerprint zero and is of one class with the like. All columns come back as they are,
    whatever their names and types. An empty table gives an empty one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("h1"), row_hash(docs, 7).alias("h2"))
    rows = stored(fingerprints(marked.select(F.col("id").alias("doc_id"), "text", "h1", "h2"), shingle, ("h1", "h2")), "fingerprints")
    # per fp first, so that a large group of copies is not joined row by row
    best = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "h1", "h2")).alias("best"))
    heads = _classes(rows, bits).join(best, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.*")
    heads = stored(heads.select(F.col("id").alias("i"), F.col("h1").alias("a"), F.col("h2").alias("b")), "kept")
    met = marked.select("row", "id", "h1", "h2").join(heads, F.col("id").eqNullSafe(F.col("i")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left_semi")
    return met.groupBy("id", "h1", "h2").agg(F.first("row").alias("row")).select("row.*")  # equal rows stand for each other


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: doc_id, fingerprint (16 hex digits), component_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLES: dict[str, str] = {}
