"""Vectors of code rows: encoders that are fitted on Spark and run within tasks, and vectors of parents for their children.

An encoder turns codes to vectors by a state, a dict of weight tables, which is fitted once, sent to
the tasks, and can be stored with sources.files.write_weights. Any class with the methods of
Encoder will do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.config import ModelConfig
from strataloom.errors import InvalidRequestError
from strataloom.functions.rng import normal, uniform
from strataloom.operators.profile import Profile, code_name

State = dict[str, np.ndarray]
# Factor and exponent of the width of an embedding by model size.
WIDTHS = {"small": (2, 0.15), "medium": (3, 0.25), "large": (4, 0.33)}
#: Numbers that a state may hold: what a broadcast and a task's sums are bounded by.
MAX_NUMBERS = 32_000_000


class Encoder(Protocol):
    """What an encoder has to offer."""

    dim: int

    def fit(self, codes: DataFrame, profile: Profile) -> State:
        """The state learned from rows of codes."""

    def encode(self, state: State, profile: Profile, codes: dict[str, np.ndarray]) -> np.ndarray:
        """Vectors of a batch: a row for each, `dim` columns. codes: by code column."""


def width(cardinality: int, size: str = "medium") -> int:
    """Width of the embedding of a sub-column."""
    f, e = WIDTHS[size]
    return min(cardinality, max(10, int(f * math.ceil(cardinality**e))))


def weights(profile: Profile, dim: int, seed: int, size: str = "medium") -> State:
    """Random weights by name: a table per code column, a compression per wide column, and the head's two layers."""
    rng = np.random.default_rng(seed)
    layer = lambda i, o: rng.uniform(-1, 1, (i, o)) / math.sqrt(max(i, 1))
    cards = profile.cardinalities
    out = {f"emb:{c}": rng.standard_normal((n, width(n, size))) for c, n in cards.items()}
    total = 0
    for p in profile.columns.values():
        own = sum(width(n, size) for n in p.subs.values())
        if len(cards) > 50 and len(p.subs) > 2:
            out[f"col:{p.name}"] = layer(own, max(10, own // 2))
            own = max(10, own // 2)
        total += own
    hidden = max(dim, total // 2)
    return out | {"head:1": layer(total, hidden), "head:2": layer(hidden, dim)}


@dataclass(frozen=True)
class RandomEncoder:
    """Tables of random weights, a compression per wide column, and a head of two layers; nothing is learned."""

    dim: int = 64
    seed: int = 0
    size: str = "medium"

    def fit(self, codes: DataFrame, profile: Profile) -> State:
        return weights(profile, self.dim, self.seed, self.size)

    def encode(self, state: State, profile: Profile, codes: dict[str, np.ndarray]) -> np.ndarray:
        parts = []
        for p in profile.columns.values():
            x = np.concatenate([state[f"emb:{code_name(p.name, s)}"][codes[code_name(p.name, s)]] for s in p.subs], axis=1)
            parts.append(x @ state[f"col:{p.name}"] if f"col:{p.name}" in state else x)
        return np.maximum(np.maximum(np.concatenate(parts, axis=1) @ state["head:1"], 0) @ state["head:2"], 0)


def summed(state: State, codes: dict[str, np.ndarray]) -> np.ndarray:
    """The sum of each row's weights over its code columns, less the mean if the state holds one."""
    total = sum(state[f"emb:{c}"][codes[c]] for c in sorted(codes))
    return total - state["mean"] if "mean" in state else total


@dataclass(frozen=True)
class LinearEncoder:
    """The principal directions of rows of codes, each code being a dimension: the vectors from which rows can best be told again.

    Fitted by block power iteration: each round is one pass in which a task multiplies its rows
    with the present directions and adds the products up by code; the sums of tasks are added on
    Spark. State: a table of weights per code column, the mean that is taken off, and the shares of codes.
    """

    dim: int = 64
    rounds: int = 4
    seed: int = 0

    def fit(self, codes: DataFrame, profile: Profile) -> State:
        cards = profile.cardinalities
        names, sizes = list(cards), np.array(list(cards.values()), np.int64)
        size, first = int(sizes.sum()), np.cumsum(sizes) - sizes
        dim = min(self.dim, size)
        if size * dim > MAX_NUMBERS:
            raise InvalidRequestError(f"{size} codes times {dim} are over {MAX_NUMBERS} weights", "embedding_dim")
        rows = codes.select(*[F.col(f"`{c}`").cast("int").alias(f"_{j}") for j, c in enumerate(names)])
        n, mean = _code_counts(rows, first, size)
        if not n:
            return {f"emb:{c}": np.zeros((cards[c], self.dim)) for c in names} | {"mean": np.zeros((1, self.dim)), "share": np.zeros((1, size))}
        basis = np.linalg.qr(np.random.default_rng(self.seed).standard_normal((size, dim)))[0]
        for _ in range(self.rounds):
            basis = np.linalg.qr(_turned(rows, first, basis, mean))[0]
        # the largest entry of each direction is positive, so that reruns agree
        basis *= np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(dim)])
        basis = np.pad(basis, ((0, 0), (0, self.dim - dim)))
        return {f"emb:{c}": basis[a : a + k] for c, a, k in zip(names, first, sizes, strict=True)} | {"mean": (mean @ basis)[None], "share": mean[None]}

    def encode(self, state: State, profile: Profile, codes: dict[str, np.ndarray]) -> np.ndarray:
        return summed(state, codes)


@dataclass(frozen=True)
class TableEncoder:
    """Weight tables that are given, summed up: for weights from elsewhere."""

    tables: State
    dim: int

    def fit(self, codes: DataFrame, profile: Profile) -> State:
        return self.tables

    def encode(self, state: State, profile: Profile, codes: dict[str, np.ndarray]) -> np.ndarray:
        return summed(state, codes)


def _flat(batch: pa.RecordBatch, first: np.ndarray) -> np.ndarray:
    """Places of each row's codes among all codes of all columns."""
    return np.stack([batch.column(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in range(len(first))], axis=1) + first


def _code_counts(rows: DataFrame, first: np.ndarray, size: int) -> tuple[int, np.ndarray]:
    """How many rows there are, and the share of each code."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for b in batches:
            total[:-1] += np.bincount(_flat(b, first).ravel(), minlength=size)
            total[-1] += b.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(size + 1)
    for r in rows.mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r.n
    return int(out[-1]), out[:-1] / max(out[-1], 1)


def _turned(rows: DataFrame, first: np.ndarray, basis: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """X'X times the directions, X the rows with a dimension for each code, less the mean."""
    shared = rows.sparkSession.sparkContext.broadcast((basis, mean @ basis))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, off = shared.value
        total, seen, sums = np.zeros_like(v), np.zeros(len(v), bool), np.zeros(v.shape[1])
        for b in batches:
            at = _flat(b, first)
            y = sum(v[at[:, j]] for j in range(at.shape[1])) - off
            for j in range(at.shape[1]):
                np.add.at(total, at[:, j], y)
            seen[at.ravel()] = True
            sums += y.sum(axis=0)
        on = np.flatnonzero(seen)
        every = np.concatenate([total[on], sums[None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[on, -1]), pa.FixedSizeListArray.from_arrays(pa.array(every.ravel()), v.shape[1]).cast(pa.list_(pa.float64()))], ["at", "x"])

    k = basis.shape[1]
    parts = rows.mapInArrow(work, "at long, x array<double>").groupBy("at").agg(F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(k)]).alias("x"))
    out, off = np.zeros_like(basis), np.zeros(k)
    for r in parts.collect():  # as many rows as there are codes, by the profile
        if r["at"] < 0:
            off = np.array(r.x)
        else:
            out[r["at"]] = r.x
    shared.unpersist()
    return out - np.outer(mean, off)


def encoder_of(config: ModelConfig) -> RandomEncoder:
    """The default encoder, by a model's settings."""
    return RandomEncoder(config.embedding_dim, config.seed or 0, config.model_size)


def embed(codes: DataFrame, profile: Profile, encoder: Encoder, state: State, keep: tuple[str, ...] = ("row_id",), name: str = "embedding", noise: float = 0.0, seed: int = 0) -> DataFrame:
    """The columns to keep and the encoder's vector of each row, an array of float. noise: the deviation of normal noise, by the first column to keep."""
    if sum(w.size for w in state.values()) > MAX_NUMBERS:
        raise InvalidRequestError(f"the state holds over {MAX_NUMBERS} numbers", "state")
    shared = codes.sparkSession.sparkContext.broadcast(state)
    names = list(profile.cardinalities)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = encoder.encode(shared.value, profile, {c: b.column(f"_{j}").to_numpy(zero_copy_only=False) for j, c in enumerate(names)})
            x = np.asarray(x, np.float32).reshape(b.num_rows, encoder.dim)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * encoder.dim), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [values], [*keep, name])

    rows = codes.select(*[F.col(f"`{k}`") for k in keep], *[F.col(f"`{c}`").cast("int").alias(f"_{j}") for j, c in enumerate(names)])
    out = rows.mapInArrow(work, T.StructType([codes.schema[k] for k in keep] + [T.StructField(name, T.ArrayType(T.FloatType()))]))
    if noise:
        more = lambda x, i: (x + noise * normal(uniform(seed, F.lit("n1"), keep[0], i), uniform(seed, F.lit("n2"), keep[0], i))).cast("float")
        out = out.withColumn(name, F.transform(name, more))
    return out


def project(codes: DataFrame, profile: Profile, dim: int = 64, seed: int = 0, keep: tuple[str, ...] = ("row_id",), noise: float = 0.0, size: str = "medium", given: State | None = None) -> DataFrame:
    """keep and `embedding`, an array of float, per row of codes: by the weights given, else by random ones drawn by the seed."""
    encoder = RandomEncoder(dim, seed, size)
    return embed(codes, profile, encoder, given or encoder.fit(codes, profile), keep, noise=noise, seed=seed)


def reconstruction_error(codes: DataFrame, profile: Profile, state: State) -> float:
    """Mean squared distance of rows, a dimension for each code, to what their vectors by orthonormal tables tell of them."""
    names = list(profile.cardinalities)
    shared = codes.sparkSession.sparkContext.broadcast(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, n, total = shared.value, 0, 0.0
        share = s["share"][0]
        first = np.cumsum([0, *(len(s[f"emb:{c}"]) for c in names)])[:-1]
        for b in batches:
            own = {c: b.column(j).to_numpy(zero_copy_only=False).astype(np.int64) for j, c in enumerate(names)}
            z = summed(s, own)
            # |x - m|^2 less |z|^2, the part that orthonormal directions hold
            x = len(names) - 2 * sum(share[first[j] + own[c]] for j, c in enumerate(names)) + share @ share
            n, total = n + b.num_rows, total + float((x - (z * z).sum(axis=1)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], ["n", "total"])

    r = codes.select(*[F.col(f"`{c}`").cast("int").alias(f"_{j}") for j, c in enumerate(names)]).mapInArrow(work, "n long, total double").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return (r.total or 0.0) / max(r.n or 0, 1)


def told_codes(vectors: DataFrame, profile: Profile, state: State, keep: tuple[str, ...] = ("row_id",), name: str = "embedding") -> DataFrame:
    """keep and the code columns that each vector of a LinearEncoder tells of: of every column the code that stands out, ties to the smaller one."""
    shared = vectors.sparkSession.sparkContext.broadcast(state)
    names = list(profile.cardinalities)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        first = np.cumsum([0, *(len(s[f"emb:{c}"]) for c in names)])
        for b in batches:
            z = b.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1)
            told = [(z @ s[f"emb:{c}"].T + s["share"][:, first[j] : first[j + 1]]).argmax(axis=1) for j, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.array(t.astype(np.int32)) for t in told], [*keep, *names])

    shape = T.StructType([vectors.schema[k] for k in keep] + [T.StructField(c, T.IntegerType()) for c in names])
    return vectors.select(*[F.col(f"`{k}`") for k in keep], F.col(f"`{name}`")).mapInArrow(work, shape)


def context_vectors(parents: DataFrame, pk: str, profile: Profile, encoder: Encoder, state: State, name: str = "context") -> DataFrame:
    """(pk, context): one vector per parent, whatever the number of its children. parents: pk and code columns."""
    return embed(parents, profile, encoder, state, (pk,), name)


def with_context_vectors(children: DataFrame, fk: str, vectors: DataFrame, pk: str, name: str = "context") -> DataFrame:
    """children with the vector of their parent; null for unknown and null keys. A vector is made once per parent and joined."""
    own = vectors.select(F.col(pk).alias("_pk"), F.col(name).alias("_vector"))
    return children.join(own, F.col(f"`{fk}`") == F.col("_pk"), "left").drop("_pk").withColumnRenamed("_vector", name)
