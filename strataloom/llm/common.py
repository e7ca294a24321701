"""Shared pieces: tables in the shared scratch folder, hashes of rows, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.sources.scratch import dropped as forget
from strataloom.sources.scratch import scratch_dir
from strataloom.sources.scratch import written as stored

__all__ = ["WORD", "ascii_lower", "connected_components", "forget", "row_hash", "scratch_dir", "stored"]

#: Regular expression of one word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def row_hash(df: DataFrame, seed: int) -> Column:
    """A hash of all columns, of any type; maps count by their entries in the order that they have."""
    plain = lambda f: not any(k in f.dataType.simpleString() for k in ("map<", "variant"))
    return F.xxhash64(F.lit(seed), *[F.col(f"`{f.name}`") if plain(f) else F.to_json(F.struct(F.col(f"`{f.name}`").alias("x"))) for f in df.schema.fields])


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected graph with edges (a, b): one row (node, component) per node with an edge.

    component is the smallest node of the component. Alternates the large-star and small-star
    steps until the edge set, a forest of stars by then, no longer changes. Every step is a
    partial aggregate and a join of two plain exchanges, so AQE can split a hub's rows.
    """

    def links(df: DataFrame) -> DataFrame:
        return df.where("lo <> hi").distinct()

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first()
        return r[0], r[1]

    now = stored(links(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))), "edges")
    seen = mark(now)
    while seen[0]:
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("hi", "lo"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = stored(links(both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))), "large")
        below = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "below")
        small = large.join(below, "hi").select(F.explode(F.array(F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")), F.struct(F.col("m").alias("lo"), F.col("hi")))).alias("e")).select("e.lo", "e.hi")
        new = stored(links(small), "edges")
        for t in (now, least, large, below):
            forget(t)
        now, before, seen = new, seen, mark(new)
        if seen == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo").distinct())
