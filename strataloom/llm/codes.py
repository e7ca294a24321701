"""Compression of vectors to one byte a part, with codebooks fitted by delta-maintained Lloyd rounds.

Each round writes the parts' entries beside those of the round before. Counts and sums of the
entries are kept as whole numbers; what a round shuffles is only what parts that moved add to
their new entry and take from their old one.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.clusters import finite
from strataloom.llm.common import forget, stored
from strataloom.llm.nearest import LONG, Book, digits, sums, undigits, whole

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Components that a task holds as doubles at a time; labels that may be broadcast.
HELD, FEW = 1 << 20, 100_000


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of HELD components at most, or of one row."""
    rows = max(1, HELD // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _padded(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Whole numbers of the rows' components; shorter rows are filled up with zeros."""
    out = np.zeros((len(column), width))
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(row)) - start[row]] = column.flatten().to_numpy(zero_copy_only=False)
    return whole(out, scale)


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    """Entries of each row's parts; -1 where the row has no code."""
    out = np.full((len(column), parts), -1, np.int64)
    out[column.is_valid().to_numpy(zero_copy_only=False)] = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint8).reshape(-1, parts)
    return out


def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(x, parts, axis=1)]


def _bytes(entry: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in entry.astype(np.uint8)], pa.binary())


def _round(books: list[Book], width: int, scale: int):
    """Reads vectors with the codes of the round before; gives them with old and new codes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, width):
            x = _padded(b.column("x"), width, scale)
            new = np.stack([book.nearest(p) for book, p in zip(books, _parts(x, len(books)), strict=True)], axis=1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("vec_id", "label", "x", "code")), _bytes(new)], ["vec_id", "label", "x", "old", "code"])

    return work


def _moved(parts: int, entries: int, width: int, scale: int):
    """Reads vectors with old and new codes; what the parts that moved add and take: (part, entry, at, digit, total), numbers of rows at -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list[int]] = {}
        for b in _slices(batches, width):
            old, new = _codes(b.column("old"), parts), _codes(b.column("code"), parts)
            for p, x in enumerate(_parts(_padded(b.column("x"), width, scale), parts)):
                moved = np.flatnonzero(old[:, p] != new[:, p])
                left = moved[old[moved, p] >= 0]
                rows, entry = np.r_[moved, left], np.r_[new[moved, p], old[left, p]]
                sign = np.r_[np.ones(len(moved), np.int64), -np.ones(len(left), np.int64)]
                for e, (n, s) in sums(x[rows], entry, entries, sign).items():
                    now = [n, *s]
                    total[p, e] = [a + c for a, c in zip(total[p, e], now, strict=True)] if (p, e) in total else now
        rows = [(p, e, at, k, d) for (p, e), v in total.items() for at, t in enumerate(v, -1) for k, d in enumerate(digits(t)) if d]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "entry", "at", "digit", "total"])

    return work


def _final(books: list[Book], width: int, scale: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, width):
            parts = _parts(_padded(b.column("x"), width, scale), len(books))
            code = np.stack([book.nearest(p) for book, p in zip(books, parts, strict=True)], axis=1)
            error = sum(book.distances(p, code[:, i]).astype(object) for i, (book, p) in enumerate(zip(books, parts, strict=True)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), _bytes(code), pa.array([min(LONG, int(e)) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return work


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[list[list[int]]]]:
    """(vec_id, label, code, error) of each kept vector, and the codebooks by part and entry.

    vectors: vec_id, embedding, label; other columns are ignored. Vectors that are null or hold
    null or non-finite components are dropped. A component x counts as floor(scale * x) (products
    that a double can't hold as the largest double). All vectors are cut into as many equal parts
    as the longest one needs, shorter ones filled up with zeros, so an empty vector is all zeros.
    Codebooks start as the parts of the `entries` (256 at most) smallest vec_ids, ascending, null
    ones last, repeated ids by their vectors; with fewer vectors they are shorter. Ties go to the
    smaller entry; entries without parts stay. code holds one byte a part; error is the squared
    distance over all parts, the largest 64-bit number if it doesn't fit. Repeated rows count as
    often as they come. An empty table gives an empty one and no codebooks.

    What reaches the driver is as large as the codebooks: entries * width sums a round.
    """
    rows = vectors.where(finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("x"))
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    if longest is None:
        return rows.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), []
    width = -(-longest // parts) * parts
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).select("x").collect()
    start = _padded(pa.array([list(r.x) for r in first], pa.list_(pa.float64())), width, scale)
    books = [[[int(v) for v in e] for e in p] for p in _parts(start, parts)]
    running = [[[0] * (1 + width // parts) for _ in first] for _ in range(parts)]
    now = rows.withColumn("code", F.lit(None).cast("binary"))
    for _ in range(rounds):
        before, shape = now, f"vec_id long, label {kind['label']}, x {kind['x']}, old binary, code binary"
        now = stored(now.select("vec_id", "label", "x", "code").mapInArrow(_round([Book(b) for b in books], width, scale), shape), "codes")
        if before is not None and hasattr(before, "_written_at"):
            forget(before)
        moved = now.where("old IS NULL OR old <> code").select("x", "old", "code").mapInArrow(_moved(parts, len(first), width, scale), "part int, entry int, at int, digit int, total long")
        change: dict[tuple[int, int, int], dict[int, int]] = defaultdict(dict)
        for r in moved.groupBy("part", "entry", "at", "digit").agg(F.sum("total").alias("total")).collect():
            change[r.part, r.entry, r["at"]][r.digit] = r.total
        for (p, e, at), v in change.items():
            running[p][e][at + 1] += undigits(v)
        for p, own in enumerate(running):
            books[p] = [[v // n for v in s] if n else books[p][e] for e, (n, *s) in enumerate(own)]
    out = stored(now.select("vec_id", "label", "x").mapInArrow(_final([Book(b) for b in books], width, scale), f"vec_id long, label {kind['label']}, code binary, error long"), "coded")
    if hasattr(now, "_written_at"):
        forget(now)
    return out, books


def decompress(coded: DataFrame, books: list[list[list[int]]], scale: int = SCALE) -> DataFrame:
    """coded with a column approx: the entries that each code names, as components again (the middle of a step of 1 / scale). A null code gives null."""
    middle = lambda v: (v + 0.5) / scale
    book = F.lit([[[middle(v) for v in e] for e in p] for p in books]).cast("array<array<array<double>>>") if books else F.lit(None).cast("array<array<array<double>>>")
    at = lambda i: F.conv(F.substring(F.hex("code"), F.lit(2) * i + 1, F.lit(2)), 16, 10).cast("int")
    return coded.withColumn("approx", F.when(F.col("code").isNotNull(), F.flatten(F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), lambda i: F.get(F.get(book, i), at(i))))) if books else F.lit(None).cast("array<double>"))


def op13_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of all vectors and how far they are off."""
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    by_label = stored(coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error")), "by-label")
    by_label = by_label.withColumnRenamed("label", "of")
    if by_label.count() <= FEW:
        by_label = F.broadcast(by_label)
    mark = hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(mark).alias("codebooks_sha256"))


def _oracle() -> str:
    steps = [
        """
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT vec_id, label, i, e[i * (len(e) // 16) + 1 : (i + 1) * (len(e) // 16)] AS v FROM kept, range(16) r(i)),
b0 AS MATERIALIZED (
  SELECT p.i, f.k, p.v AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept ORDER BY vec_id LIMIT 64) f ON p.vec_id = f.vec_id)"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, label, i, k, v, d FROM (
    SELECT p.vec_id, p.label, p.i, p.v, b.k, list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.c) + list_inner_product(b.c, b.c) AS d FROM p JOIN b{r} b ON p.i = b.i)
  QUALIFY row_number() OVER (PARTITION BY vec_id, i ORDER BY d, k) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
b{r + 1} AS MATERIALIZED (
  SELECT o.i, o.k, coalesce(n.c, o.c) AS c FROM b{r} o LEFT JOIN (
    SELECT i, k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS c FROM (
      SELECT i, k, j, CAST(sum(CAST(x AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM (SELECT i, k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{r}) GROUP BY i, k, j) GROUP BY i, k) n
  ON o.i = n.i AND o.k = n.k)""")
    return (
        ",".join(steps)
        + f""",
m AS (SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN c], ','), ',' ORDER BY i, k)) AS mark FROM b{ROUNDS}),
o AS (SELECT vec_id, label, string_agg(lower(printf('%02x', k)), '' ORDER BY i) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, mark AS codebooks_sha256 FROM o, m"""
    )


QUERIES = {"op13_codes": op13_codes}
ORACLES = {"op13_codes": _oracle()}
