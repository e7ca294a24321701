import numpy as np
from pyspark.sql import functions as F

from strataloom.llm import quantised, topk
from tests.llm.brute import components

SCHEMA = "vec_id long, embedding array<float>, label int, kind string"


def made(n=400, seed=5, width=24):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 4, width))
    rows = [(i, (base[i % len(base)] + (0.25 if i >= len(base) else 0) * rng.standard_normal(width)).astype(np.float32).tolist(), int(i % len(base)) % 3, "x") for i in range(n)]
    bad = [None, [], [0.0] * width, [float("nan")] * width, [1.0, None], [float("inf")] * width]
    rows += [(n + i, v, 1, None) for i, v in enumerate(bad)]
    return rows + [(n + 10, rows[0][1], rows[0][2], "x"), (n + 11, rows[0][1], None, "x"), (n + 12, [float(x) * 3 for x in rows[0][1]], rows[0][2], "x")]


def brute(rows, least=0.93):
    links = []
    ok = [(i, np.array(v, float), label) for i, v, label, _ in rows if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for a in range(len(ok)):
        for b in range(a):
            x, y = ok[a][1], ok[b][1]
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links.append((ok[a][0], ok[b][0]))
    return links


def test_links_and_classes_match_brute_force(spark):
    rows = made()
    links = brute(rows)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components([r[0] for r in rows], links)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for options in ({}, {"per_list": 40, "block": 16, "chunk": 50}):
        got = {r.vec_id: r for r in quantised.vector_classes(df, **options).collect()}
        assert {i: r.n_links for i, r in got.items()} == n
        assert {i: r.component_id for i, r in got.items()} == comp
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert quantised.vector_classes(df.where("false")).count() == 0


def test_table_sums_never_miss(spark):
    rng = np.random.default_rng(1)
    u = rng.standard_normal((3000, 32))
    u[1500:] = u[:1500] + 0.1 * rng.standard_normal((1500, 32))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    q = quantised.Quantiser.fit(u[:800], 8)
    home, codes, errors = q.encode(u)
    at = np.flatnonzero(home == 3)
    x, y = quantised.search_tile(q, 3, codes[at], errors[at], u[at], u, 0.93)
    assert len(x) == ((u @ u[at].T) >= 0.93).sum()


def test_top_k_matches_brute_force(spark):
    rows = made(300, 8, 9)
    ok = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    pad = lambda v: v + [0] * (9 - len(v))
    for i, q in ok:
        if i % 7 == 0:
            best = sorted(((-sum(a * b for a, b in zip(pad(q), pad(v))), j) for j, v in ok if j != i))[:5]
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    df = spark.createDataFrame(rows, SCHEMA)
    for options in ({}, {"chunk": 40, "group": 5}):
        got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 7 == 0, **options).collect()]
        assert sorted(got) == sorted(want)
    assert topk.top_k(df.where("false"), F.col("vec_id") % 7 == 0).count() == 0


def test_top_k_of_few_and_large_values():
    q = np.array([[2**40, 1]])
    d = np.array([[2**40, 3], [2**40, 2], [-(2**40), 9]])
    (_, score, name), = topk.search(q, np.array([9]), np.array([1, 2, 3]), d, 5)
    assert name.tolist() == [1, 2, 3] and score[0] == 2**80 + 3


def test_recall_where_few_lists_are_probed(spark):
    """300 lists, 24 of them probed: nine tenths of the links, at least, that all pairs give."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((1000, 32))
    v = np.concatenate([base, base + 0.25 * rng.standard_normal(base.shape), base + 0.3 * rng.standard_normal(base.shape)]).astype(np.float32)
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    want = int((u @ u.T >= 0.93).sum()) - len(u)
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int")
    got = quantised.vector_classes(df, per_list=10).agg(F.sum("n_links")).first()[0]
    assert 0.9 * want <= got <= want and want > 1000


def test_null_ids_and_extreme_components(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (6, [1e200, 1e190], 1), (7, [1e-200, 0.0], 1), (None, [0.0, 1.0], 2)]
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id) for r in quantised.vector_classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()), key=str)
    assert got == sorted([(-1, 4, 5), (-1, 4, 5), (5, 4, 5), (6, 4, 5), (7, 4, 5), (-1, 0, None)], key=str)
