"""Centroid clustering: Lloyd's rounds over whole numbers with exact assignments and exact means.

A task finds the nearest centroids of its vectors by float32 matrix products whose rounding error
is bounded; where the intervals of several centroids overlap, these are compared in exact
integers. What is shuffled are sums per task and centroid, as digits, so that they are exact at any size.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import forget, stored
from strataloom.llm.nearest import LONG, Book, digits, sums, undigits, whole

SCALE, WIDTH, CENTROIDS, ROUNDS = 256, 64, 40, 5


def finite(v: Column) -> Column:
    """True if the array holds no null and no non-finite component; null arrays are false."""
    return F.coalesce(F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Arrays of that many components as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _partial(book: Book, scale: int):
    """Reads vectors; sums per centroid over the whole task: (entry, at, digit, total), the number of rows at -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = defaultdict(int)
        total: dict[int, list[int]] = {}
        for batch in batches:
            x = whole(matrix(batch.column("x"), book.width), scale)
            for e, (n, s) in sums(x, book.nearest(x), book.size).items():
                count[e] += n
                total[e] = [a + b for a, b in zip(total[e], s, strict=True)] if e in total else s
        rows = [(e, at, k, d) for e in total for at, v in enumerate([count[e], *total[e]], -1) for k, d in enumerate(digits(v)) if d]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["entry", "at", "digit", "total"])

    return work


def _assigned(book: Book, scale: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column("x"), book.width), scale)
            entry = book.nearest(x)
            d = [min(LONG, int(v)) for v in book.distances(x, entry)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(entry.astype(np.int32)), pa.array(d, pa.int64())], ["vec_id", "cluster", "distance"])

    return work


def means(rows: list, old: list[list[int]], name=lambda r: r["entry"]) -> list[list[int]]:
    """Entries replaced by floor(sum / count) of their rows; those without rows stay."""
    parts: dict[int, dict[int, dict[int, int]]] = defaultdict(lambda: defaultdict(dict))
    for r in rows:
        parts[name(r)][r["at"]][r["digit"]] = r["total"]
    out = [list(c) for c in old]
    for e, by in parts.items():
        n = undigits(by.get(-1, {}))
        if n:
            out[e] = [undigits(by.get(i, {})) // n for i in range(len(old[e]))]
    return out


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = 2) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each kept vector, and the final centroids.

    vectors: vec_id, embedding; other columns are ignored. Kept are vectors of exactly `width`
    components, none null or non-finite; a component x counts as floor(scale * x) (products that
    a double can't hold as the largest double). Centroids start as the k vectors with the smallest
    sha256 of "seed:vec_id", ascending, a null vec_id last, repeated ids by their vectors; with
    fewer vectors there are fewer centroids. Each round assigns every vector to the nearest centroid,
    ties to the smaller number, and takes componentwise floor(sum / count); a centroid without
    vectors stays. Repeated rows count as often as they come. A squared distance beyond 64 bits
    is given as the largest 64-bit number. An empty table gives an empty one and no centroids.
    What reaches the driver are k * width sums a round, whatever the number of rows.
    """
    rows = vectors.where(finite(F.col("embedding")) & (F.size("embedding") == width)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("x"))
    rows = stored(rows, "points")
    first = rows.select("x", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h")).orderBy(F.asc_nulls_last("h"), "x").limit(k).select("x").collect()
    book = [[int(v) for v in whole(np.array(r.x, np.float64), scale)] for r in first]
    if not book:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        part = rows.select("x").mapInArrow(_partial(Book(book), scale), "entry int, at int, digit int, total long")
        book = means(part.groupBy("entry", "at", "digit").agg(F.sum("total").alias("total")).collect(), book)
    out = stored(rows.mapInArrow(_assigned(Book(book), scale), "vec_id long, cluster int, distance long"), "clusters")
    forget(rows)
    return out, book


def op12_clusters(spark, sf_dir: str) -> DataFrame:
    """Clusters of all vectors with 64 components, and how tight they are."""
    found, book = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    tight = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    cut = lambda v: min(LONG, int(v))
    marks = [(i, cut(tight.get(i, 0)), cut(sum(tight.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(book)]
    marks = spark.createDataFrame(marks, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(marks), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # one row per centroid


def _oracle() -> str:
    """The rounds one after another, each an assignment and the new centroids."""
    steps = [
        """
WITH kept AS MATERIALIZED (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, e FROM (SELECT sha256('2:' || vec_id) AS h, e FROM kept ORDER BY h LIMIT 40))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, e, c, d FROM (
    SELECT k.vec_id, k.e, b.c, list_inner_product(k.e, k.e) - 2 * list_inner_product(k.e, b.e) + list_inner_product(b.e, b.e) AS d FROM kept k, c{r} b)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.e, o.e) AS e FROM c{r} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS e FROM (
      SELECT c, i, CAST(sum(CAST(x AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c) n ON o.c = n.c)""")
    return (
        ",".join(steps)
        + f"""
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string([CAST(x AS BIGINT) FOR x IN b.e], ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} b ON a.c = b.c"""
    )


QUERIES = {"op12_clusters": op12_clusters}
ORACLES = {"op12_clusters": _oracle()}
