import random

import pytest
from pyspark.sql import functions as F

from strataloom.functions.rng import uniform
from strataloom.operators import draws as D
from strataloom.operators import paths as P
from strataloom.operators import sampler as M


def table(counts, by, wishes, diversity, cutoff):
    """(code, cum) of a group in plain Python; None if nothing is left."""
    rows = sorted((c, n ** (1 / diversity)) for (b, c), n in counts.items() if b == by)
    if cutoff < 1:
        whole, ahead, kept = sum(p for _, p in rows), 0.0, []
        for c, p in sorted(rows, key=lambda r: (-r[1], r[0])):
            if ahead < cutoff * whole - 1e-12:
                kept.append((c, p))
            ahead += p
        rows = sorted(kept)
    if wishes and rows:
        codes = dict(rows) | {c: 0.0 for c, v in wishes.items() if v > 0 and c not in dict(rows)}
        free, left = sum(p for c, p in codes.items() if c not in wishes), max(0.0, 1 - sum(wishes.values()))
        own = [(c, wishes[c] if c in wishes else p / free * left if free else 0.0) for c, p in sorted(codes.items())]
        rows = own if sum(p for _, p in own) > 0 else rows if by == D.ANY else []
    whole, upto, out = sum(p for _, p in rows), 0.0, []
    for c, p in rows:
        upto += p
        if p > 0:
            out.append((c, upto / whole))
    return out


def draw(counts, by, u, *shape):
    rows = table(counts, by, *shape) or table(counts, D.ANY, *shape)
    return next((c for c, cum in rows if cum > u), rows[-1][0] if rows else 0)


@pytest.mark.parametrize("many", [6, 300])
@pytest.mark.parametrize("shape", [({}, 1.0, 1.0), ({0: 0.0, 3: 0.5}, 1.0, 1.0), ({1: 0.0}, 0.5, 0.7), ({2: 0.0, 4: 0.3, 1: 0.9}, 2.0, 1.0)])
def test_draws_follow_the_shares(spark, many, shape):
    rng = random.Random(many)
    counts = {(b, c): int(rng.paretovariate(0.7)) for b in range(5) for c in range(many) if rng.random() < 0.7}
    counts |= {(7, 2): 3, (8, 0): 4}  # groups of which wishes may leave nothing
    for (b, c), n in list(counts.items()):
        counts[D.ANY, c] = counts.get((D.ANY, c), 0) + n
    df = spark.createDataFrame([(b, c, n) for (b, c), n in counts.items()], "by int, code int, n long")
    rows = spark.range(600).select("id", (F.col("id") % 10).cast("int").alias("g"))
    got = D.drawn(rows, "x", uniform(3, "id"), df, D.Shape.of(*shape), many, F.col("g"), 10).withColumn("u", uniform(3, "id")).collect()
    assert len(got) == 600 and all(r.x == draw(counts, r.g, r.u, *shape) for r in got)
    alone = D.drawn(rows, "g", uniform(4, "id"), df.where(F.col("by") == D.ANY), D.Shape.of(*shape), many).withColumn("u", uniform(4, "id")).collect()
    assert all(r.g == draw(counts, D.ANY, r.u, *shape) for r in alone)


def test_edges_of_draws(spark):
    none = spark.createDataFrame([], "by int, code int, n long")
    only = spark.createDataFrame([(D.ANY, 1, 5)], "by int, code int, n long")
    rows = spark.range(3)
    assert [r.x for r in D.drawn(rows, "x", uniform(1, "id"), none, D.Shape(), 9).collect()] == [0] * 3
    assert [r.x for r in D.drawn(rows, "x", uniform(1, "id"), only, D.Shape.of({1: 0.0}), 9).collect()] == [1] * 3
    for codes in (9, 900):
        assert [r.x for r in D.drawn(rows, "x", uniform(1, "id"), only, D.Shape(), codes, F.col("id").cast("int"), 9).collect()] == [1] * 3


def test_table_size_is_linear_in_the_codes(spark):
    for many in (1000, 8000):
        counts = spark.range(many).select(F.lit(D.ANY).alias("by"), F.col("id").cast("int").alias("code"), (F.lit(many) / (F.col("id") + 1)).cast("long").alias("n")).where("n > 0")
        slots = D._slots(D.shares(counts, D.Shape.of({0: 0.0}))).agg(F.sum(F.size("slots")), F.max("buckets")).first()
        assert slots[0] <= 1.3 * many and slots[1] >= many // 10


def _steps(spark):
    """Steps of three columns: b follows a of its step, a follows itself, c follows the parent."""
    rng = random.Random(5)
    parents, rows = [(i, "xyz"[i % 3]) for i in range(300)], []
    for i, p in parents:
        a = "m"
        for t in range(rng.randrange(1, 6)):
            a = a if t and rng.random() < 0.9 else rng.choice("mnop")
            b = a.upper() if rng.random() < 0.95 else "Q"
            rows.append((i, t, a, b, p if rng.random() < 0.9 else "w"))
    return spark.createDataFrame(parents, "id long, p string"), spark.createDataFrame(rows, "id long, t int, a string, b string, c string")


def test_steps_depend_on_what_says_most(spark):
    parents, rows = _steps(spark)
    model = M.fit(rows, {"privacy": {"threshold": 1}}, "id", ["t"], parents, "id", ["p"])
    order = ["a__cat", "b__cat", "c__cat"]
    chosen = P.sources(model.steps, order)
    assert chosen[False, "a__cat"] == "<a__cat" and chosen[True, "b__cat"] == chosen[False, "b__cat"] == "=a__cat"
    assert chosen[True, "c__cat"] == chosen[False, "c__cat"] == "^parent:p__cat"
    assert P.sources(model.steps, order[::-1])[False, "a__cat"] == "=b__cat"  # whichever is drawn first
    made = M.generate_sequences(spark, model, parents, "id", seed=3).join(parents, "id").collect()
    later = [r for r in made if r.step > 1]
    assert later and sum(r.b == r.a.upper() for r in made) > 0.9 * len(made) and sum(r.c == r.p for r in later) > 0.8 * len(later)
    paths = {(r.id, r.step): r.a for r in made}
    kept = [paths[i, s - 1] == a for (i, s), a in paths.items() if s]
    assert sum(kept) > 0.85 * len(kept)


def test_paths_by_joins_are_those_of_tasks(spark):
    parents, rows = _steps(spark)
    model = M.fit(rows, {"privacy": {"threshold": 1}}, "id", ["t"], parents, "id", ["p"])
    shapes = {c: D.Shape.of({0: 0.0}) for c in model.columns}
    cards = model.profile.cardinalities | {f"parent:{c}": n for c, n in model.parents.cardinalities.items()}
    own = spark.range(40).select("id", (F.col("id") % 5).cast("int").alias("_n"), (F.col("id") % 4).cast("int").alias("parent:p__cat"), F.array(F.lit(-1), (F.col("id") % 3).cast("int")).alias("_fb__cat"))
    order = ["b__cat", "a__cat", "c__cat"]
    here, far = (sorted(P.paths(own, "id", ["id"], model.steps, order, shapes, cards, 7, ["b__cat"], ["parent:p__cat"], sent=s).collect()) for s in (None, 0))
    assert here == far and len(here) == sum(i % 5 for i in range(40))
    assert all(r["b__cat"] == r.id % 3 for r in here if r.step == 1)
    assert P.paths(own.where("_n = 0"), "id", ["id"], model.steps, order, shapes, cards, 7, [], ["parent:p__cat"], sent=0).count() == 0


@pytest.mark.parametrize("kind", ["categorical", "numeric_digit", "numeric_binned"])
def test_imputation_always_fills(spark, kind):
    """x is null exactly where g is b: the group of the null holds nothing else."""
    cell = F.when(F.col("id") % 2 == 0, (F.col("id") % 7).cast("double"))
    rows = spark.range(400).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), cell.alias("x"))
    rows = rows.withColumn("x", F.col("x").cast("string")) if kind == "categorical" else rows
    model = M.fit(rows.drop("row_id"), {"privacy": {"threshold": 1}, "encoding_types": {"x": kind}})
    out = M.impute(spark, model, rows, trials=1, seed=2)
    assert out.where("x is null").count() == 0 and out.where("row_id % 2 = 1").select("x").distinct().count() > 3


def test_nulls_count_as_draws_when_fitting(spark):
    rows = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.lit(70.0) + F.col("id") % 3).alias("x"))
    model = M.fit(rows, {"privacy": {"threshold": 1}, "encoding_types": {"x": "numeric_digit"}, "seed": 4})
    tens = model.columns.index("x__E1")
    low = model.profile.columns["x"].low["E1"]
    got = {r.a + low: r.n for r in model.pairs.where((F.col("i") == tens) & (F.col("j") == tens)).collect()}
    assert got == {7: 2000}


def test_bias_keeps_what_is_admissible(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        s, x = rng.choice("fm"), rng.choice("123")
        proxy = s if rng.random() < 0.95 else "-"
        t = "y" if rng.random() < {"1": 0.1, "2": 0.5, "3": 0.9}[x] * (1.0 if s == "m" else 0.6) else "n"
        rows.append((s, proxy, x, t))
    model = M.fit(spark.createDataFrame(rows, "s string, proxy string, x string, t string"), {"privacy": {"threshold": 1}})
    from strataloom import Bias

    made = M.generate(spark, model, 6000, bias=Bias("t", ("s",)), seed=5)
    share = lambda c: {r[c]: r.p for r in made.groupBy(c).agg(F.avg((F.col("t") == "y").cast("int")).alias("p")).collect()}
    for c in ("s", "proxy"):
        p = share(c)
        assert max(p.values()) - min(p.values()) < 0.09
    x = share("x")
    assert x["3"] - x["1"] > 0.4
    assert made.where("proxy <> s and proxy <> '-'").count() < 60
