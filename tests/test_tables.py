import random

import pytest
from pyspark.sql import functions as F

from strataloom import InvalidRequestError, Table
from strataloom.config import ModelConfig, resolve_config
from strataloom.operators import embedding as E
from strataloom.operators import sequences as S
from strataloom.operators import tables as T
from strataloom.operators.profile import profile_table

OPEN = {"privacy": {"threshold": 1}}


@pytest.fixture(scope="module")
def chain(spark):
    """Regions, shops that follow their region, and visits that follow their shop."""
    rng = random.Random(2)
    regions = [(i, "north" if i % 4 else "south") for i in range(40)]
    shops, visits = [], []
    for i in range(800):
        r = rng.randrange(40)
        kind = {"north": "ski", "south": "surf"}[regions[r][1]] if rng.random() < 0.95 else "book"
        shops.append((i, r, kind))
        visits += [(i, t, kind + ("!" if rng.random() < 0.9 else "?")) for t in range(rng.randrange(1, 5))]
    make = spark.createDataFrame
    return {
        "region": Table(make(regions, "r_id long, r_side string"), "r_id"),
        "shop": Table(make(shops, "s_id long, s_region long, s_kind string"), "s_id", {"s_region": "region"}),
        "visit": Table(make([(k, *v) for k, v in enumerate(visits)], "v_id long, v_shop long, v_t int, v_what string"), "v_id", {"v_shop": "shop"}, True, order=("v_t",)),
    }


def test_what_grandchildren_are_follows_their_grandparents(spark, chain):
    new = T.synthesize_tables(spark, chain, config=OPEN, seed=3)
    region, shop, visit = (new[k] for k in ("region", "shop", "visit"))
    assert T.orphans(shop, "s_region", region, "r_id").count() == 0 and T.orphans(visit, "v_shop", shop, "s_id").count() == 0
    assert shop.select("s_id").distinct().count() == shop.count() == 800
    met = shop.join(region, F.col("s_region") == F.col("r_id"))
    rows = visit.join(met, F.col("v_shop") == F.col("s_id")).groupBy("r_side").agg(F.avg(F.col("v_what").startswith("ski").cast("int")).alias("ski"), F.avg(F.col("v_what").startswith("surf").cast("int")).alias("surf")).collect()
    side = {r.r_side: r for r in rows}
    assert side["north"].ski > 0.8 and side["north"].surf < 0.1 and side["south"].surf > 0.8 and side["south"].ski < 0.1
    own = visit.join(shop, F.col("v_shop") == F.col("s_id"))
    assert own.where(F.col("v_what").startswith(F.col("s_kind"))).count() > 0.85 * own.count()


def test_keys_without_strata_and_without_parents(spark):
    rng = random.Random(4)
    parents = spark.createDataFrame([(10 * i, rng.choice("xy")) for i in range(50)], "p long, side string")
    children = spark.createDataFrame([(i, 10 * rng.randrange(50), rng.choice("ab")) for i in range(600)], "row_id long, fk long, c string")
    p = profile_table(children.select("c"), privacy=resolve_config(OPEN).privacy)
    strata = T.fit_strata(children, "fk", p, parents, "p", ["side"], resolve_config(OPEN))
    got = T.matched_keys(children, "fk", p, strata, parents, "p", 1).collect()
    assert len(got) == 600 and len({r.fk for r in got}) == 50 and all(r.fk % 10 == 0 for r in got)
    assert {r.fk for r in T.matched_keys(children, "fk", p, strata, parents.where("false"), "p", 1).collect()} == {None}
    assert T.fit_strata(children, "fk", p, parents, "p", [], resolve_config(OPEN)).counts is None


def test_a_stratum_without_new_parents_takes_any(spark):
    parents = spark.createDataFrame([(i, "xy"[i % 2]) for i in range(40)], "p long, side string")
    children = spark.createDataFrame([(i, i % 40, "ab"[i % 2]) for i in range(400)], "row_id long, fk long, c string")
    p = profile_table(children.select("c"), privacy=resolve_config(OPEN).privacy)
    strata = T.fit_strata(children, "fk", p, parents, "p", ["side"], resolve_config(OPEN))
    got = T.matched_keys(children.drop("fk"), "fk", p, strata, parents, "p", 1).collect()
    assert all((r.c == "a") == (r.fk % 2 == 0) for r in got)
    only = T.matched_keys(children.drop("fk"), "fk", p, strata, parents.where("side = 'x'"), "p", 1).collect()
    assert len(only) == 400 and all(r.fk % 2 == 0 for r in only)


def test_sequence_by_needs_a_sequential_table(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    with pytest.raises(InvalidRequestError):
        Table(df, "c", {"a": "x"}, sequence_by="a")


def test_settings_reach_the_encoder_and_the_split(spark):
    for bad in ({"model_size": "huge"}, {"val_split": 0}, {"val_split": 1.0}, {"val_split": True}):
        with pytest.raises(InvalidRequestError):
            ModelConfig(**bad)
    config = ModelConfig(model_size="small", embedding_dim=8, val_split=0.25, seed=3)
    assert E.encoder_of(config) == E.RandomEncoder(8, 3, "small") and E.width(10_000, "small") < E.width(10_000, "large")
    assert S.split_for(spark.range(400), ["id"], config).where("part = 'val'").count() == 100


def test_base62_of_numbers_next_to_powers(spark):
    """Halves of which a quotient is within a millionth of the next number."""
    halves = [62**k * m + d for k in range(11) for m in (1, 5) for d in (-1, 0, 1)] + [0, 2**64 - 1]
    want = ["".join(T.BASE62[n // 62**k % 62] for k in range(10, -1, -1)) for n in halves]
    rows = spark.createDataFrame([(i, f"{n:016x}{m:016x}") for i, (n, m) in enumerate(zip(halves, reversed(halves), strict=True))], "i int, h string")
    got = [r.t for r in rows.select("i", T.base62(F.col("h")).alias("t")).orderBy("i").collect()]
    assert got == [a + b for a, b in zip(want, reversed(want), strict=True)]
