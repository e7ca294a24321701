"""Exact top-k by inner product with block-at-a-time pruning.

Every component of a vector is a term. Documents stand in ranges of like vectors, cut into blocks
of ROWS; a block keeps the highest and lowest value of each term, so that the sum of the better
product per term bounds every score in it. A query visits the blocks of a chunk by falling bound,
scores their rows from the block's forward index, and stops when the bound falls below its kth score.
Chunks have such bounds too: a query searches its own chunk first, then those that can still matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataloom.llm.common import forget, stored

#: Rows of a block, blocks scored at a time, rows of a chunk (about), queries of a group (about).
ROWS, STEP, CHUNK, GROUP = 64, 8, 8192, 1024
#: Products are summed in floating point only where every sum is exact: below this.
EXACT = float(1 << 52)
#: The largest 64-bit number; stands for a null vec_id, which so comes last.
TOP = (1 << 63) - 1


def search(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, names: np.ndarray | None = None, floor: np.ndarray | None = None) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, scores, ids) of each query's k best rows but its own, ties to smaller names, then ids. Matrices of whole numbers of one width.

    names: what ties are settled by, the ids if None. floor: a score below which each query needs no rows.
    """
    names = ids if names is None else names
    size = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    exact = size < EXACT
    q, d = (queries.astype(np.float64), rows.astype(np.float64)) if exact else (_whole(queries), _whole(rows))
    starts = np.arange(0, len(rows), ROWS)
    high, low = np.maximum.reduceat(d, starts, axis=0), np.minimum.reduceat(d, starts, axis=0)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    out = []
    for i in range(len(q)):
        order = np.argsort(-bounds[i], kind="stable")
        score, best_of = np.zeros(0, d.dtype), np.zeros(0, np.int64)
        least = None if floor is None or floor[i] == -np.inf else float(floor[i]) if exact else int(floor[i] - abs(floor[i]) * 1e-9)
        for at in range(0, len(order), STEP):
            most = bounds[i][order[at]]
            if len(score) == k and most < score[-1] or least is not None and most < least:
                break
            at = np.concatenate([np.arange(starts[b], min(starts[b] + ROWS, len(rows))) for b in order[at : at + STEP]])
            at = at[ids[at] != own[i]]
            s, n = np.append(score, d[at] @ q[i]), np.append(best_of, at)
            best = np.lexsort((ids[n], names[n], -s))[:k]
            score, best_of = s[best], n[best]
        out.append((i, score, ids[best_of]))
    return out


def _whole(x: np.ndarray) -> np.ndarray:
    """Python's whole numbers, for sums beyond what a double holds."""
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _matrix(arrays: list, width: int) -> np.ndarray:
    out = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    return out


def _tiles(k: int, width: int):
    """Reads tiles from a sorted partition: the queries of a tile come before its rows. Scores beyond 64 bits are cut to them; `size` orders them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held)
            asks = whole.column("is_row").to_numpy() == 0
            if asks.all() or not asks.any():
                return
            ids, names, vec = whole.column("row").to_numpy(), whole.column("name").to_numpy(), _matrix(whole.column("vec").to_numpy(), width)
            floor = whole.column("floor").to_numpy()[asks]
            name_of = dict(zip(ids[~asks].tolist(), names[~asks].tolist(), strict=True))
            for i, score, found in search(vec[asks], ids[asks], ids[~asks], vec[~asks], k, names[~asks], floor):
                n, cut = len(found), [max(-TOP - 1, min(TOP, int(x))) for x in score]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, ids[asks][i])), pa.array(np.full(n, names[asks][i])), pa.array([name_of[x] for x in found.tolist()], pa.int64()), pa.array(found), pa.array(cut, pa.int64()), pa.array([float(x) for x in score], pa.float64())], ["ask", "query_id", "name", "row", "score", "size"])

        for whole in batches:
            pairs = np.stack([whole.column(c).to_numpy() for c in ("chunk", "part")], axis=1)
            cuts = np.flatnonzero((pairs[1:] != pairs[:-1]).any(axis=1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(pairs)], strict=True):
                if lo == hi:
                    continue
                if key is not None and tuple(pairs[lo]) != key:
                    yield from done()
                    held = []
                key = tuple(pairs[lo])
                held.append(whole.slice(lo, hi - lo))
        if held:
            yield from done()

    return work


def _reach(width: int):
    """Reads tiles of queries and of chunks' highest and lowest terms; which chunks can hold a row of each query's k best."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for whole in batches:
            part, asks = whole.column("part").to_numpy(), whole.column("is_row").to_numpy() == 0
            for p in np.unique(part):
                if p not in held:
                    held = {p: []}
                own = (part == p) & ~asks
                if own.any():
                    mine = whole.filter(pa.array(own))
                    held[p].append((mine.column("row").to_numpy(), _matrix(mine.column("vec").to_numpy(zero_copy_only=False), width), _matrix(mine.column("low").to_numpy(zero_copy_only=False), width)))
                own = (part == p) & asks
                if not own.any():
                    continue
                mine = whole.filter(pa.array(own))
                q, home, floor = _matrix(mine.column("vec").to_numpy(zero_copy_only=False), width), mine.column("chunk").to_numpy(), mine.column("floor").to_numpy()
                for chunk, high, low in held[p]:
                    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
                    # a bound may lose what a double can't hold
                    can = (bounds + np.abs(bounds) * 1e-9 >= floor[:, None]) & (chunk[None, :] != home[:, None])
                    a, b = np.nonzero(can)
                    yield pa.RecordBatch.from_arrays([pa.array(mine.column("row").to_numpy()[a]), pa.array(chunk[b].astype(np.int32))], ["row", "chunk"])

    return work


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest integer inner product with each query.

    vectors: vec_id, embedding; other columns are only read by is_query. A component x counts as
    floor(scale * x). Queries are the rows where is_query holds, candidates all other rows, repeated
    ones too: a repeated query comes out as often, and its copies are candidates. Ties go to the
    smaller vec_id, a null one last. Vectors that are null or hold null or non-finite components take no part; a shorter vector counts
    as filled up with zeros. A score beyond 64 bits is cut to them, but ranks as it is, to a double's
    precision. An empty table gives an empty one.

    Rows of like vectors stand in chunks. Each query searches its own chunk first; its kth score
    there decides to which other chunks, by their highest and lowest terms, it is sent.
    """
    v = F.col("embedding")
    finite = F.coalesce(F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)), F.lit(False))
    floor = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  larger doubles are whole
    vec = F.transform(v, lambda x: floor(x.cast("double") * scale))
    rows = vectors.where(finite).select(F.coalesce(F.col("vec_id").cast("long"), F.lit(TOP)).alias("name"), F.coalesce(is_query, F.lit(False)).alias("asks"), vec.alias("vec"))
    # like vectors stand together: by the term of the largest magnitude, its sign, and the vector itself
    size = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    rows = rows.withColumn("term", F.coalesce(F.array_position(F.transform("vec", lambda x: F.abs(x)), size) * F.when(F.array_contains("vec", size), 1).otherwise(-1), F.lit(0)))
    rows = stored(rows, "rows")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, 1)
    placed = rows.repartitionByRange(max(1, -(-n // chunk)), "term", "vec", "name").withColumn("chunk", F.spark_partition_id())
    placed = stored(placed.sortWithinPartitions("term", "vec", "name").withColumn("row", F.monotonically_increasing_id()), "placed")
    forget(rows)
    asked = placed.where("asks").count()
    groups = max(1, -(-asked // group))
    tile = ["chunk", "part", "is_row", "floor", "row", "name", "vec"]
    asks = placed.where("asks").select("chunk", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"), F.lit(0).alias("is_row"), F.lit(float("-inf")).alias("floor"), "row", "name", "vec")
    shape = "ask long, query_id long, name long, row long, score long, size double"

    def searched(some: DataFrame, them: DataFrame) -> DataFrame:
        tiles = some.select(*tile).union(them.select(*tile)).repartition("chunk", "part").sortWithinPartitions("chunk", "part", "is_row", "row")
        return tiles.mapInArrow(_tiles(k, width), shape)

    # a chunk's own queries are part 0 of it
    at_home = stored(searched(asks.withColumn("part", F.lit(0)), placed.select("chunk", F.lit(0).alias("part"), F.lit(1).alias("is_row"), F.lit(0.0).alias("floor"), "row", "name", "vec")), "at-home")
    kth = at_home.groupBy("ask").agg(F.when(F.count("*") >= k, F.min("size")).alias("kth"))
    asks = stored(asks.drop("floor").join(kth, F.col("row") == F.col("ask"), "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth", "ask"), "asks")
    ends = placed.select("chunk", F.posexplode("vec").alias("at", "x")).groupBy("chunk", "at").agg(F.max("x").alias("hi"), F.min("x").alias("lo"), F.count("*").alias("many"))
    sizes = placed.groupBy("chunk").agg(F.count("*").alias("all"))
    # a term that some row of the chunk lacks is 0 there
    ends = ends.join(sizes, "chunk").select("chunk", "at", *[F.when(F.col("many") < F.col("all"), f(c, F.lit(0.0))).otherwise(F.col(c)).alias(c) for c, f in (("hi", F.greatest), ("lo", F.least))])
    ends = ends.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "hi", "lo"))).alias("e"))
    ends = stored(sizes.join(ends, "chunk", "left").select("chunk", *[F.coalesce(F.col(f"e.{c}"), F.array().cast("array<double>")).alias(a) for c, a in (("hi", "vec"), ("lo", "low"))]), "ends")
    many = max(1, -(-asked // (8 * group)))  # bounds are cheap, so more queries meet at once
    every = F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("part")
    left = asks.select(F.pmod(F.xxhash64("row"), F.lit(many)).cast("int").alias("part"), F.lit(0).alias("is_row"), "chunk", "floor", "row", "vec", F.lit(None).cast("array<double>").alias("low"))
    over = ends.select(every, F.lit(1).alias("is_row"), F.lit(-1).alias("chunk"), F.lit(0.0).alias("floor"), F.col("chunk").cast("long").alias("row"), "vec", "low")
    pairs = left.union(over).repartition("part").sortWithinPartitions("part", F.desc("is_row")).mapInArrow(_reach(width), "row long, chunk int")
    sent = stored(asks.drop("chunk").join(pairs, "row"), "sent")
    wanted = sent.select("chunk", "part").distinct()
    them = placed.select("chunk", F.lit(1).alias("is_row"), F.lit(0.0).alias("floor"), "row", "name", "vec").join(wanted, "chunk")
    best = at_home.union(searched(sent, them))
    order = Window.partitionBy("ask").orderBy(F.desc("size"), F.desc("score"), "name", "row")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select(*[F.when(F.col(c) != TOP, F.col(c)).alias(a) if a != "rank" else F.col("rank") for c, a in (("query_id", "query_id"), ("rank", "rank"), ("name", "vec_id"))], "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 best rows for every vector whose vec_id is divisible by 50."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


QUERIES = {"op8_topk": op8_topk}
ORACLES = {
    "op8_topk": """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e::DOUBLE[], d.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
}
