import hashlib
import math
import random

import duckdb
from pyspark.sql import functions as F

from strataloom.llm import clusters

LONG = (1 << 63) - 1
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, rounds, width, seed=2):
    ok = lambda v: v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, v, [math.floor(256 * x) for x in v]) for i, v, *_ in rows if ok(v)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    book = [list(r[2]) for r in sorted(kept, key=name)[:k]]

    def near(x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [near(x)[0] for _, _, x in kept]
        for c in range(len(book)):
            mine = [x for (_, _, x), o in zip(kept, own, strict=True) if o == c]
            if mine:
                book[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return sorted((-1 if i is None else i, c, min(LONG, d)) for i, _, x in kept for c, d in [near(x)]), book


def held(spark, rows, **more):
    found, book = clusters.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in found.collect()), book


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.3, 0.0, 0.25, rng.gauss(0, 0.4)]) for _ in range(4)], i % 3) for i in range(150)]
    rows += rows[:20]
    more = {"k": 7, "rounds": 4, "width": 4}
    assert held(spark, rows, **more) == brute(rows, **more)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [1.0, inf], 0), (5, [nan, 1.0], 0), (6, [1.0, 2.0, 3.0], 0), (None, [0.5, 0.5], None), (None, [0.25, 0.5], 1), (8, [1e300, -1e300], 0), (9, [3e37, 1.0], 0), (10, [-0.001, 0.0], 1), (10, [-0.001, 0.0], 1)]
    for k in (1, 3, 40):
        assert held(spark, rows, k=k, rounds=3, width=2) == brute(rows, k, 3, 2)
    assert held(spark, rows[:6], k=3, width=2) == ([], [])
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("a")).withColumn("h", F.lit(1)).withColumn("cluster", F.lit(-1)).withColumn("distance", F.lit(None))
    assert clusters.cluster(clash, k=3, width=2)[0].count() == 6


def test_query_matches_sql_at_another_size(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = con.sql(clusters.ORACLES["op12_clusters"]).fetchall()
    got = clusters.op12_clusters(spark, d)
    assert sorted(map(tuple, got.collect())) == sorted(want) and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_query_of_extreme_vectors(spark, tmp_path):
    rows = [(i, [float(i % 5)] * 63 + [1e38 if i % 9 == 0 else 0.0], 0) for i in range(90)] + [(100, [0.0] * 63, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = clusters.op12_clusters(spark, str(tmp_path)).collect()
    want, book = brute([(i, [float(x) for x in v]) for i, v in spark.read.parquet(str(tmp_path / "embeddings.parquet")).select("vec_id", "embedding").collect()], 40, 5, 64)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == want
    assert {(r.cluster, r.centroid_sha256) for r in got} <= {(c, hashlib.sha256(",".join(map(str, b)).encode()).hexdigest()) for c, b in enumerate(book)}
