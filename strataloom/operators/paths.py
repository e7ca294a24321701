"""Sequences step by step: what each column of a step depends on, and drawing whole paths.

A column of a step is drawn given one other code: of a column of the same step drawn before it, of
its own step before, or of a column of the entity's parent, whichever says most about it (mutual
information), by itself for first steps and for later ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.functions.rng import uniform
from strataloom.operators.draws import ANY, Shape, drawn, shares
from strataloom.sources.scratch import written

#: Entries of all tables up to which they are sent to the tasks; beyond, each step is a join.
SENT = 2_000_000
#: Sources of a code: a column of the same step, of the step before, of the parent.
SAME, BEFORE, PARENT = "=", "<", "^"


def step_counts(codes: DataFrame, key: str, order: list[str], columns: list[str], parents: DataFrame | None = None, pk: str | None = None) -> DataFrame:
    """(first, source, column, by, code, n): steps by the code of each column and of each source; the source of all steps is "".

    parents: pk and code columns of the entities; steps of unknown entities count in what has no parent.
    """
    own = Window.partitionBy(key).orderBy(*order)
    rows = codes.select(key, *[F.col(f"`{c}`").cast("int").alias(f"_c{i}") for i, c in enumerate(columns)], *[F.lag(F.col(f"`{c}`").cast("int")).over(own).alias(f"_b{i}") for i, c in enumerate(columns)], (F.row_number().over(own) == 1).alias("_first"))
    theirs = [c for c in parents.columns if c != pk] if parents is not None else []
    if theirs:
        known = parents.select(F.col(pk).alias("_pk"), *[F.col(f"`{c}`").cast("int").alias(f"_p{i}") for i, c in enumerate(theirs)])
        rows = rows.join(known, F.col(key) == F.col("_pk"), "left")
    cell = lambda source, j, by: F.struct(F.col("_first").alias("first"), F.lit(source).alias("source"), F.lit(columns[j]).alias("column"), by.alias("by"), F.col(f"_c{j}").alias("code"))
    cells = []
    for j, c in enumerate(columns):
        cells += [cell("", j, F.lit(ANY)), cell(BEFORE + c, j, F.col(f"_b{j}"))]
        cells += [cell(SAME + columns[i], j, F.col(f"_c{i}")) for i in range(j)]
        cells += [cell(PARENT + p, j, F.col(f"_p{k}")) for k, p in enumerate(theirs)]
    return rows.select(F.explode(F.array(*cells)).alias("s")).select("s.*").where("by is not null").groupBy("first", "source", "column", "by", "code").agg(F.count("*").alias("n"))


def sources(counts: DataFrame, order: list[str]) -> dict[tuple[bool, str], str]:
    """By (first, column): the source with the highest mutual information, if any says something; columns in the order of drawing."""
    own = ["first", "source", "column"]
    n, total = F.col("n").cast("double"), F.sum("n").over(Window.partitionBy(*own))
    of_by, of_code = (F.sum("n").over(Window.partitionBy(*own, c)) for c in ("by", "code"))
    told = counts.where("source <> ''").withColumns({"t": total, "x": of_by, "y": of_code}).groupBy(*own).agg(F.sum(n / F.col("t") * F.log(n * F.col("t") / (F.col("x") * F.col("y")))).alias("mi")).collect()
    said = {(r.first, r.source, r.column): r.mi for r in told}
    out: dict[tuple[bool, str], str] = {}
    for first in (True, False):
        for at, c in enumerate(order):
            best = 0.0
            known = [(SAME + o, said.get((first, SAME + o, c), said.get((first, SAME + c, o), 0.0))) for o in order[:at]]
            known += [(s, said[k]) for k in sorted(said) for f, s, col in [k] if f == first and col == c and s[0] != SAME]
            for s, mi in known:
                if mi > 1e-9 and mi > best + 1e-12:
                    best, out[first, c] = mi, s
    return out


def counts_of(counts: DataFrame, first: bool, column: str, source: str | None) -> DataFrame:
    """(by, code, n) of a column given its source, and ANY: of first steps, or of later ones, or of all where there are no later ones."""
    alone = counts.where((F.col("source") == "") & (F.col("column") == column))
    if first:
        out = alone.where("first").select("by", "code", "n")
    else:
        both = alone.groupBy("by", "code").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(~F.col("first"), F.col("n"))), F.lit(0)).alias("later"))
        some = F.sum("later").over(Window.partitionBy("by")) > 0
        out = both.select("by", "code", F.when(some, F.col("later")).otherwise(F.col("n")).alias("n")).where("n > 0")
    if source is None:
        return out
    met = counts.where((F.col("first") == first) & (F.col("column") == column) & (F.col("source") == source))
    if source[0] == SAME:  # a pair of columns is counted once
        turned = counts.where((F.col("first") == first) & (F.col("column") == source[1:]) & (F.col("source") == SAME + column))
        met = met.select("by", "code", "n").union(turned.select("code", "by", "n"))
    return met.select("by", "code", "n").union(out)


def _tables(counts: DataFrame, order: list[str], chosen: dict, shapes: dict[str, Shape]) -> dict | None:
    """Shares of every column for tasks to search: groups, where each begins, cumulated shares and codes. None if there are too many."""
    if counts.count() > SENT:
        return None
    named = [shares(counts_of(counts, f, c, chosen.get((f, c))), shapes[c]).select(F.lit(f).alias("first"), F.lit(c).alias("column"), "by", "cum", "code") for f in (True, False) for c in order]
    every = named[0]
    for more in named[1:]:
        every = every.union(more)
    got = every.toPandas().sort_values(["by", "cum"], kind="stable")
    out = {}
    for (f, c), rows in got.groupby(["first", "column"]):
        by, start = np.unique(rows["by"].to_numpy(), return_index=True)
        out[bool(f), c] = (by, np.r_[start, len(rows)], rows["cum"].to_numpy(), rows["code"].to_numpy().astype(np.int32))
    return out


def _look(table: tuple | None, by: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The first code of each group whose cumulated share exceeds u, by halving."""
    if table is None:
        return np.zeros(len(u), np.int32)
    groups, start, cum, code = table
    at = np.searchsorted(groups, by)
    at = np.where(groups[np.minimum(at, len(groups) - 1)] == by, at, np.searchsorted(groups, ANY))
    low, high = start[at], start[at + 1] - 1
    while (low < high).any():
        mid = (low + high) // 2
        over = cum[mid] > u
        low, high = np.where(over, low, np.minimum(mid + 1, high)), np.where(over, mid, high)
    return code[low]


def _walk(shared, order: list[str], chosen: dict, fixed: list[str], theirs: list[str], keep: list[str]):
    """Reads entities: their lengths, and a uniform number for each step and column; gives their paths."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        for b in batches:
            n = b.column("_n").to_numpy().astype(np.int64)
            start = np.cumsum(n) - n
            u = [b.column(f"_u{j}").flatten().to_numpy() for j in range(len(order))]
            given = {c: b.column(f"_g{j}").flatten().to_numpy() for j, c in enumerate(order) if c in fixed}
            parent = {p: b.column(f"_p{k}").to_numpy(zero_copy_only=False) for k, p in enumerate(theirs)}
            path = {c: np.zeros(int(n.sum()), np.int32) for c in order}
            longest_first = np.argsort(-n, kind="stable")
            alive = np.searchsorted(-n[longest_first], -np.arange(int(n.max(initial=0))), side="left")
            for t, many in enumerate(alive):
                who = longest_first[:many]
                at = start[who] + t
                for j, c in enumerate(order):
                    s = chosen.get((t == 0, c), "")
                    kind, name = s[:1], s[1:]
                    by = path[name][at] if kind == SAME else path[name][at - 1] if kind == BEFORE else parent[name][who] if kind == PARENT else np.full(len(at), ANY)
                    code = _look(tables.get((t == 0, c)), by, u[j][at])
                    path[c][at] = np.where(given[c][at] >= 0, given[c][at], code) if c in fixed else code
            offsets = pa.array(np.r_[start, int(n.sum())].astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(k) for k in keep] + [pa.ListArray.from_arrays(offsets, pa.array(path[c])) for c in order], [*keep, *(f"_c{j}" for j in range(len(order)))])

    return work


def _each_step(value, kind: str = "double") -> Column:
    return F.when(F.col("_n") > 0, F.transform(F.sequence(F.lit(1), F.col("_n")), value)).otherwise(F.array().cast(f"array<{kind}>"))


def paths(rows: DataFrame, key: str, keys: list[str], counts: DataFrame, order: list[str], shapes: dict[str, Shape], cards: dict[str, int], seed: int | Column, fixed: list[str] = (), theirs: list[str] = (), sent: int | None = None) -> DataFrame:
    """(keys, step, columns): a code for each column of each of an entity's `_n` steps, steps from 0.

    rows: keys, _n, `_f<column>` (codes that are given by step; -1 or none where drawn), and the code
    columns of the parents, `theirs`. counts: what step_counts returns. Numbers are hashes of the
    seed, the column, the entity's key and the step. Within a task all entities take a step at a
    time; where the tables are too large to be sent, each step is a join for each column.
    """
    chosen = sources(counts, order)
    rows = rows.where("_n > 0")
    tables = _tables(counts, order, chosen, shapes) if sent is None or sent else None
    number = lambda c: lambda i: uniform(seed, F.lit(c), key, i)
    given = lambda c: lambda i: F.coalesce(F.get(F.col(f"`_f{c}`"), i - 1), F.lit(-1))
    if tables is not None:
        shared = rows.sparkSession.sparkContext.broadcast(tables)
        asked = rows.select(*keys, "_n", *[_each_step(number(c)).alias(f"_u{j}") for j, c in enumerate(order)], *[_each_step(given(c), "int").alias(f"_g{j}") for j, c in enumerate(order) if c in fixed], *[F.coalesce(F.col(f"`{p}`").cast("int"), F.lit(ANY)).alias(f"_p{k}") for k, p in enumerate(theirs)])
        shape = T.StructType([asked.schema[k] for k in keys] + [T.StructField(f"_c{j}", T.ArrayType(T.IntegerType())) for j in range(len(order))])
        done = asked.mapInArrow(_walk(shared, order, chosen, list(fixed), list(theirs), keys), shape)
        packed = F.arrays_zip(*[F.col(f"_c{j}") for j in range(len(order))])
        flat = done.select(*keys, F.posexplode(packed).alias("step", "_s"))
        return flat.select(*keys, "step", *[F.col(f"_s._c{j}").alias(c) for j, c in enumerate(order)])
    made, state = [], rows
    for t in range(1, (rows.agg(F.max("_n")).first()[0] or 0) + 1):
        state = state.where(F.col("_n") >= t)
        before = {c: f"_before:{c}" for c in order}
        if t > 1:
            state = state.withColumnsRenamed({c: b for c, b in before.items()})
        for c in order:
            s = chosen.get((t == 1, c))
            by = None if s is None else F.col(f"`{s[1:]}`") if s[0] == SAME else F.col(f"`{before[c]}`") if s[0] == BEFORE else F.coalesce(F.col(f"`{s[1:]}`").cast("int"), F.lit(ANY))
            state = drawn(state, c, number(c)(F.lit(t)), counts_of(counts, t == 1, c, s), shapes[c], cards[c], by, cards.get(s[1:], 1) if s else 1)
            if c in fixed:
                known = given(c)(F.lit(t))
                state = state.withColumn(c, F.when(known >= 0, known).otherwise(F.col(f"`{c}`")))
        state = written(state.drop(*before.values()), "step")
        made.append(state.select(*keys, F.lit(t - 1).alias("step"), *[F.col(f"`{c}`") for c in order]))
    if not made:
        return rows.select(*keys, F.lit(0).alias("step"), *[F.lit(0).alias(c) for c in order]).where("false")
    while len(made) > 1:
        made = [made[i].union(made[i + 1]) if i + 1 < len(made) else made[i] for i in range(0, len(made), 2)]
    return made[0]
