import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strataloom.llm import codes

LONG = (1 << 63) - 1
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    w = -(-max(len(v) for _, v, _ in kept) // parts)
    vec = [[math.floor(256 * x) for x in v] + [0] * (w * parts - len(v)) for _, v, _ in kept]
    cut = [[v[p * w : p * w + w] for p in range(parts)] for v in vec]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[cut[r][p] for r in order] for p in range(parts)]

    def near(x, book):
        d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        own = [[near(c[p], books[p])[0] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own, strict=True) if o[p] == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    out = []
    for (i, _, lab), c in zip(kept, cut, strict=True):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((-1 if i is None else i, -1 if lab is None else lab, bytes(e for e, _ in found), min(LONG, sum(d for _, d in found))))
    return sorted(out), books


def held(spark, rows, **more):
    coded, books = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    return sorted((-1 if r.vec_id is None else r.vec_id, -1 if r.label is None else r.label, bytes(r.code), r.error) for r in coded.collect()), books


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.3, 0.0, 0.25, rng.gauss(0, 0.4)]) for _ in range(6)], i % 3) for i in range(150)]
    rows += rows[:20]
    for rounds in (0, 1, 4):
        more = {"parts": 3, "entries": 5, "rounds": rounds}
        assert held(spark, rows, **more) == brute(rows, **more)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0), (2, [], None), (3, [1.0, None], 0), (4, [1.0, inf], 0), (5, [nan, 1.0], 0), (6, [1.0, 2.0, 3.0], 0), (None, [0.5, 0.5], None), (None, [0.25, 0.5], 1), (8, [1e300, -1e300], 0), (9, [3e37, 1.0], 0), (10, [-0.001, 0.0], 1), (10, [-0.001, 0.0], 1)]
    for entries in (1, 3, 64):
        assert held(spark, rows, parts=2, entries=entries, rounds=3) == brute(rows, 2, entries, 3)
    assert held(spark, [rows[1]], parts=2, entries=3, rounds=2) == ([(2, -1, b"\0\0", 0)], [[[]], [[]]])
    assert held(spark, rows[2:5]) == ([], [])
    clash = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("a") for c in ("x", "code", "old", "error", "of", "label_error")})
    assert codes.compress(clash, parts=2)[0].count() == 8


def test_only_what_moved_is_shuffled():
    x = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], pa.list_(pa.float64()))
    old, new = (pa.array(c, pa.binary()) for c in ([b"\0\1", b"\0\0", None], [b"\0\1", b"\2\0", b"\1\1"]))
    got = pa.Table.from_batches(codes._moved(2, 3, 2, 1)([pa.RecordBatch.from_arrays([x, old, new], ["x", "old", "code"])])).to_pylist()
    assert {(r["part"], r["entry"], r["at"], r["total"]) for r in got} == {(0, 2, -1, 1), (0, 2, 0, 3), (0, 0, -1, -1), (0, 0, 0, -3), (0, 1, -1, 1), (0, 1, 0, 5), (1, 1, -1, 1), (1, 1, 0, 6)}


def test_query_matches_sql_at_another_size(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    got = codes.op13_codes(spark, d)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(codes.ORACLES["op13_codes"]).fetchall()) and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_query_of_null_labels(spark, tmp_path):
    rows = [(i, [float(i % 7), float(i % 3)] * 8, [None, 0, 1][i % 3]) for i in range(100)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = codes.op13_codes(spark, str(tmp_path)).collect()
    want, books = brute(rows, 16, 64, 2)
    total = {lab: sum(e for _, x, _, e in want if x == lab) for lab in (-1, 0, 1)}
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == [(i, c.hex(), e, total[lab]) for i, lab, c, e in want]
    assert {r.codebooks_sha256 for r in got} == {hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()}


def test_decompress(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.integers(0, 3, 4)], 0) for i in range(40)] + [(99, [], 0)]
    coded, books = codes.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=40)
    back = {r.vec_id: r for r in codes.decompress(coded, books).collect()}
    for i, v, _ in rows:
        v = v or [0.0] * 4
        off = sum((math.floor(256 * a) - math.floor(256 * b)) ** 2 for a, b in zip(v, back[i].approx, strict=True))
        assert off == back[i].error
