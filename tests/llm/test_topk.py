import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import topk


def brute(rows, k=5, every=7):
    """(query_id, rank, vec_id, score) of rows (vec_id, vector), each pair multiplied in whole numbers; copies count."""
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(good):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0) for p, (j, w) in enumerate(good) if p != q]
        out += [(i, r, None if none else j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, none, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows_of(seed, n=300, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    return [(i, (centres[i % 9] + 0.2 * rng.normal(size=width)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("chunk", "group"), [(8192, 1024), (40, 3), (16, 1)])
def test_repeated_rows_nulls_and_ragged_vectors(spark, chunk, group):
    rows = rows_of(1) + [(7, [0.5] * 6), (7, [0.5] * 6), (14, None), (21, [1.0, None]), (28, [float("nan")]), (35, [float("inf")]), (None, [3.0] * 6), (None, [3.0] * 6), (42, []), (49, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"row": F.lit(1), "score": F.lit(2), "chunk": F.lit(3)}).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 7 == 0, chunk=chunk, group=group).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_chunks_that_cannot_matter_get_no_queries(spark):
    """Clusters far apart: a query is sent to few chunks besides its own."""
    rows = [(i, [10.0 if j == i % 8 else 0.01 * ((i * 7 + j) % 5) for j in range(8)]) for i in range(800)]
    sent = []
    keep = topk.stored

    def seen(df, name):
        out = keep(df, name)
        if name == "sent":
            sent.append(out.count())
        return out

    topk.stored = seen
    try:
        got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 7 == 0, chunk=50).collect()
    finally:
        topk.stored = keep
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert sent[0] < 0.4 * 115 * 16


def test_large_values(spark):
    rows = [(i, [1e12 * (1 + i % 3), -3e38 if i == 8 else 1.0, -1e-20]) for i in range(30)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 7 == 0, chunk=8).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").where("false"), F.col("vec_id") % 7 == 0).count() == 0
