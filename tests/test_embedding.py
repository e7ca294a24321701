import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.errors import InvalidRequestError
from strataloom.operators import embedding as E
from strataloom.operators.profile import ColumnProfile, Profile
from strataloom.sources.files import read_weights, write_weights

SIZES = {"a__cat": 5, "b__cat": 4, "c__cat": 6}


@pytest.fixture(scope="module")
def coded(spark):
    """Codes of which b repeats a and c is by itself."""
    rng = random.Random(1)
    rows = []
    for i in range(900):
        a = rng.choice([0, 0, 0, 1, 1, 2, 3, 4])
        rows.append((i, a, min(a, 3) if rng.random() < 0.9 else rng.randrange(4), rng.randrange(6)))
    profile = Profile({k: ColumnProfile(k, "categorical", "string", {"cat": SIZES[f"{k}__cat"]}) for k in "abc"})
    return spark.createDataFrame(rows, "row_id long, a__cat int, b__cat int, c__cat int").repartition(3), profile


def one_hot(codes):
    rows = codes.orderBy("row_id").collect()
    return np.array([np.concatenate([np.eye(n)[r[c]] for c, n in SIZES.items()]) for r in rows])


def test_fitted_directions_are_the_principal_ones(coded):
    codes, profile = coded
    state = E.LinearEncoder(3, rounds=40).fit(codes, profile)
    x = one_hot(codes)
    x = x - x.mean(axis=0)
    _, _, v = np.linalg.svd(x, full_matrices=False)
    found = np.concatenate([state[f"emb:{c}"] for c in SIZES])
    assert np.allclose(found.T @ found, np.eye(3), atol=1e-9)
    assert np.allclose(np.abs(found.T @ v[:3].T), np.eye(3), atol=1e-3)
    got = np.array([r.embedding for r in E.embed(codes, profile, E.LinearEncoder(3), state).orderBy("row_id").collect()])
    assert np.allclose(got, x @ found, atol=1e-5)


def test_fitted_vectors_tell_more_of_rows_held_out(coded):
    codes, profile = coded
    seen, held = codes.where("row_id % 3 > 0"), codes.where("row_id % 3 = 0")
    fitted = E.LinearEncoder(3, seed=2).fit(seen, profile)
    drawn = E.LinearEncoder(3, rounds=0, seed=2).fit(seen, profile)
    got = [E.reconstruction_error(held, profile, s) for s in (fitted, drawn)]
    x, share = one_hot(held), fitted["share"][0]
    v = np.concatenate([fitted[f"emb:{c}"] for c in SIZES])
    y = x - share
    assert np.isclose(got[0], ((y - y @ v @ v.T) ** 2).sum(axis=1).mean())
    assert got[0] < 0.8 * got[1]


def test_edges_of_fitting(spark, coded):
    codes, profile = coded
    none = E.LinearEncoder(4).fit(codes.where("false"), profile)
    assert E.embed(codes, profile, E.LinearEncoder(4), none).where(F.exists("embedding", lambda x: x != 0)).count() == 0
    wide = E.LinearEncoder(40, rounds=1)
    assert {len(r.embedding) for r in E.embed(codes, profile, wide, wide.fit(codes, profile)).collect()} == {40}
    assert E.embed(codes.where("false"), profile, wide, wide.fit(codes, profile)).count() == 0
    with pytest.raises(InvalidRequestError):
        E.LinearEncoder(3).fit(codes, Profile({"a": ColumnProfile("a", "categorical", "string", {"cat": E.MAX_NUMBERS})}))


class CountEncoder:
    """An encoder of one's own: how rare each code is."""

    dim = 3

    def fit(self, codes, profile):
        n = codes.count()
        return {c: np.array([[r["n"] / n] for r in codes.sparkSession.range(k).join(codes.groupBy(F.col(c).cast("long").alias("id")).agg(F.count("*").alias("n")), "id", "left").fillna(0).orderBy("id").collect()]) for c, k in profile.cardinalities.items()}

    def encode(self, state, profile, codes):
        return np.concatenate([state[c][codes[c]] for c in profile.cardinalities], axis=1)


def test_an_encoder_of_ones_own_runs_from_its_stored_state(spark, coded, tmp_path):
    codes, profile = coded
    encoder = CountEncoder()
    write_weights(spark, encoder.fit(codes, profile), str(tmp_path / "state"))
    state = read_weights(spark, str(tmp_path / "state"))
    got = {r.row_id: r.v for r in E.embed(codes, profile, encoder, state, name="v").collect()}
    rows = {r.row_id: r for r in codes.collect()}
    share = lambda c, x: sum(r[c] == x for r in rows.values()) / len(rows)
    assert all(np.allclose(got[i], [share(c, rows[i][c]) for c in SIZES], atol=1e-6) for i in list(rows)[::97])


def test_vectors_of_parents(spark, coded):
    codes, profile = coded
    encoder = E.LinearEncoder(2)
    vectors = E.context_vectors(codes.where("row_id < 10"), "row_id", profile, encoder, encoder.fit(codes, profile))
    children = spark.createDataFrame([(1, 3), (2, 3), (3, None), (4, 77), (5, 9)], "id int, fk long").withColumn("context", F.lit("mine")).drop("context")
    got = {r.id: r.context for r in E.with_context_vectors(children, "fk", vectors, "row_id").collect()}
    assert got[1] == got[2] and got[3] is None and got[4] is None and len(got[5]) == 2 and vectors.count() == 10
