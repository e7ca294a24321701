"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank.

A coarse quantiser deals unit vectors to lists; what is left of a vector beyond its list's
centroid is coded by the nearest word of a codebook in each of SPACES subspaces. A query adds up
table entries, one per subspace, for every code in its nearest lists. Each code keeps the length
of its own error, so a sum can't miss a near vector of a probed list; what passes is compared
exactly. Lists are cut into blocks and their queries into chunks, so no list is too large for a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import connected_components, stored
from strataloom.llm.simhash import star_edges

#: Subspaces of the residual code, and words of each codebook.
SPACES, CODEWORDS = 16, 256
#: Vectors that the quantiser is fitted on at most, lists at most, and vectors a list should hold.
MAX_SAMPLE, MAX_LISTS, PER_LIST = 16_384, 1024, 256
#: Lists that a query looks into.
PROBES = 24
#: Entries of a list that one tile holds, and queries that it meets.
BLOCK, CHUNK = 4096, 32_768


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k centroids of the rows of x, by Lloyd's rounds from a random start; empty ones keep their place."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (c * c).sum(1) / 2
    for i in range(0, len(x), 4096):
        out[i : i + 4096] = (half - x[i : i + 4096] @ c.T).argmin(1)
    return out


@dataclass
class Quantiser:
    """Coarse centroids (lists, width) and codebooks (SPACES, CODEWORDS, width / SPACES); width is a multiple of SPACES."""

    coarse: np.ndarray
    books: np.ndarray

    @classmethod
    def fit(cls, units: np.ndarray, lists: int) -> Quantiser:
        coarse = kmeans(units, lists)
        left = units - coarse[nearest(units, coarse)]
        part = left.reshape(len(left), SPACES, -1)
        books = np.zeros((SPACES, CODEWORDS, part.shape[2]))
        for m in range(SPACES):
            got = kmeans(part[:, m], CODEWORDS, 5)
            books[m, : len(got)] = got
            books[m, len(got) :] = got[0]
        return cls(coarse, books)

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, code, error) of each vector; error is the length of what the code misses."""
        home = nearest(units, self.coarse)
        part = (units - self.coarse[home]).reshape(len(units), SPACES, -1)
        code = np.stack([nearest(part[:, m], self.books[m]) for m in range(SPACES)], axis=1).astype(np.uint8) if len(units) else np.zeros((0, SPACES), np.uint8)
        said = np.stack([self.books[m][code[:, m]] for m in range(SPACES)], axis=1)
        return home, code, np.sqrt(((part - said) ** 2).sum((1, 2)))

    def probes(self, units: np.ndarray, n: int) -> np.ndarray:
        """The n lists nearest to each vector."""
        n = min(n, len(self.coarse))
        far = (self.coarse**2).sum(1) / 2 - units @ self.coarse.T
        return np.argpartition(far, n - 1, axis=1)[:, :n]

    def tables(self, units: np.ndarray) -> np.ndarray:
        """Inner products of each query's parts with all codewords: (queries, SPACES, CODEWORDS)."""
        return np.einsum("qmd,mkd->qmk", units.reshape(len(units), SPACES, -1), self.books)


def unit_rows(arrays: list, width: int) -> np.ndarray:
    """Unit vectors in double precision, filled up to width with zeros."""
    out = np.zeros((len(arrays), width))
    for i, a in enumerate(arrays):
        out[i, : len(a)] = a
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that no square is lost or infinite
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def search_tile(q: Quantiser, at: int, codes: np.ndarray, errors: np.ndarray, units: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, entry row) of the pairs with a cosine of least or more between queries and the entries of list `at`."""
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(queries), 256):
        part = queries[i : i + 256]
        table = q.tables(part)
        bound = (part @ q.coarse[at])[:, None] + errors[None, :]
        for m in range(SPACES):
            bound += table[:, m][:, codes[:, m]]
        a, b = np.nonzero(bound >= least - 1e-9)
        for j in range(0, len(a), 65_536):
            x, y = a[j : j + 65_536], b[j : j + 65_536]
            ok = np.einsum("ij,ij->i", part[x], units[y]) >= least
            rows.append(x[ok] + i)
            cols.append(y[ok])
    return np.concatenate(rows), np.concatenate(cols)


def _search(shared, width: int, least: float):
    """Reads tiles from a sorted partition: the entries of a tile first, then its queries, which stream by."""
    where = ["kind", "list", "block", "chunk"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, key, held, entries = shared.value, None, [], None

        def table(node, n, a, b) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(a), pa.array(b)], ["node", "n", "a", "b"])

        def prepared():
            code = np.frombuffer(b"".join(x for h in held for x in h.column("code").to_pylist()), np.uint8).reshape(-1, SPACES)
            errors, nodes, copies = (np.concatenate([h.column(c).to_numpy(zero_copy_only=False) for h in held]) for c in ("error", "node", "copies"))
            return code, errors, unit_rows([v for h in held for v in h.column("vec").to_numpy(zero_copy_only=False)], width), nodes, copies

        for whole in batches:
            frame = whole.select([*where, "is_query"]).to_pandas()
            ids = frame.ne(frame.shift()).any(axis=1).to_numpy()
            edges = np.append(np.flatnonzero(ids), len(frame))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part, r = whole.slice(lo, hi - lo), frame.iloc[lo]
                own = tuple(r[where])
                if own != key:
                    key, held, entries = own, [], None
                if not r["is_query"]:
                    held.append(part)
                    continue
                if not held:
                    continue
                entries = entries or prepared()
                code, errors, units, nodes, copies = entries
                asked = part.column("node").to_numpy(zero_copy_only=False)
                x, y = search_tile(q, int(key[1]), code, errors, units, unit_rows(list(part.column("vec").to_numpy(zero_copy_only=False)), width), least)
                other = asked[x] != nodes[y]
                x, y = x[other], y[other]
                found = np.bincount(x, weights=copies[y], minlength=len(asked)).astype(np.int64)
                some = np.flatnonzero(found)
                a, b = star_edges(asked[x].view(np.uint64), nodes[y].view(np.uint64))
                yield table(asked[some], found[some], np.full(len(some), -1), np.full(len(some), -1))
                yield table(np.full(len(a), -1), np.zeros(len(a), np.int64), a.view(np.int64), b.view(np.int64))

    return work


def _usable(c: str):
    """Whether a vector has a direction: neither null nor zero, all components finite."""
    v = F.col(c)
    return F.coalesce(F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0), F.lit(False))


def vector_classes(vectors: DataFrame, least: float = 0.93, probes: int = PROBES, per_list: int = PER_LIST, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of vectors (vec_id, embedding, label).

    Rows link when their labels are equal and their cosine is `least` or more. Rows whose label is
    null or whose vector has no direction link with nothing. Equal vectors of a label are one node
    with copies. Vectors of different lengths don't link. A null vec_id links like any other and
    names a component only if no other member has an id; repeated rows come out repeated and link
    with each other. An empty table gives an empty one; other columns are ignored.
    The quantiser is fitted on about MAX_SAMPLE nodes with the smallest hashes; all are indexed.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"), F.col("label"))
    rows = rows.withColumn("kind", F.when(F.col("label").isNotNull() & _usable("vec"), F.concat_ws(":", F.size("vec"), F.col("label").cast("string"))))
    rows = rows.withColumns({"h1": F.xxhash64("kind", "vec"), "h2": F.xxhash64(F.lit(7), "kind", "vec")})
    rows = stored(rows.select("vec_id", "kind", "h1", "h2", F.when(F.col("kind").isNotNull(), F.col("vec")).alias("vec")), "vectors")
    nodes = rows.where("kind is not null").groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("kind").alias("kind"), F.any_value("vec").alias("vec"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    width = -(-width // SPACES) * SPACES
    rate = min(1.0, MAX_SAMPLE / max(n, 1))
    sample = nodes.where(F.xxhash64("h1", "h2").bitwiseAND(0xFFFFFF) < rate * float(1 << 24)).orderBy("h1", "h2").select("vec").toPandas()["vec"]
    if n and not len(sample):
        sample = nodes.orderBy("h1", "h2").limit(1).select("vec").toPandas()["vec"]
    units = unit_rows(list(sample), width) if len(sample) else np.eye(1, width)
    shared = nodes.sparkSession.sparkContext.broadcast(Quantiser.fit(units, int(np.clip(n // per_list, 1, min(MAX_LISTS, len(units))))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for b in batches:
            u = unit_rows(list(b.column("vec").to_numpy(zero_copy_only=False)), width)
            home, codes, error = q.encode(u)
            near = q.probes(u, probes) if len(u) else np.zeros((0, 1))
            more = [pa.array(home.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, "list", "code", "error", "near"])

    coded = nodes.select("node", "copies", "kind", "vec").mapInArrow(code, "node long, copies long, kind string, vec array<double>, list int, code binary, error double, near array<int>")
    coded = stored(coded, "coded")
    asked = coded.select("node", "kind", F.explode("near").alias("list"), "vec")
    sizes = coded.groupBy("kind", "list").agg(F.ceil(F.count("*") / block).alias("blocks")).join(asked.groupBy("kind", "list").agg(F.ceil(F.count("*") / chunk).alias("chunks")), ["kind", "list"])
    sizes = stored(sizes, "sizes")

    def upto(c: str):
        return F.explode(F.sequence(F.lit(0), (F.col(c) - 1).cast("int")))

    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    entries = coded.join(sizes, ["kind", "list"]).select("kind", "list", own("blocks").alias("block"), upto("chunks").alias("chunk"), F.lit(False).alias("is_query"), "node", "copies", "code", "error", "vec")
    queries = asked.join(sizes, ["kind", "list"]).select("kind", "list", upto("blocks").alias("block"), own("chunks").alias("chunk"), F.lit(True).alias("is_query"), "node", F.lit(0).cast("long").alias("copies"), F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("error"), "vec")
    tile = ["kind", "list", "block", "chunk"]
    found = entries.union(queries).repartition(*tile).sortWithinPartitions(*tile, "is_query").mapInArrow(_search(shared, width, least), "node long, n long, a long, b long")
    found = stored(found, "found")
    counts = found.where("node >= 0").groupBy("node").agg(F.sum("n").alias("n"))
    linked = connected_components(found.where("a >= 0").select("a", "b")).withColumnRenamed("node", "_node")
    whole = nodes.select("node", "h1", "h2", "first", "copies").join(counts, "node", "left").join(linked, F.col("node") == F.col("_node"), "left")
    whole = stored(whole.select("h1", "h2", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("root")), "linked")
    heads = whole.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(whole.join(heads, "root").select("h1", "h2", "n_links", "component_id"), "classes")
    out = rows.where("kind is not null").join(classes, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("kind is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_vectors(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings: vec_id, n_links, component_id, kept."""
    return vector_classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_PAIRS = """
WITH v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93)"""

QUERIES = {"op1_vectors": op1_vectors}
ORACLES = {
    "op1_vectors": _PAIRS.replace("WITH v", "WITH RECURSIVE v", 1)
    + """,
r AS (SELECT a AS node, b AS reach FROM p UNION SELECT r.node, p.b FROM r JOIN p ON r.reach = p.a)
SELECT vec_id, (SELECT count(*) FROM p WHERE p.a = e.vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(reach) FROM r WHERE r.node = e.vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(reach) FROM r WHERE r.node = e.vec_id), vec_id)) AS kept
FROM embeddings e""",
}
