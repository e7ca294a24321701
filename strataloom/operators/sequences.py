"""Rows of a child table as sequences per entity. Every operator takes an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataloom.config import ModelConfig
from strataloom.operators.ranks import cumulated


def with_index(df: DataFrame, order: list[str], name: str = "index") -> DataFrame:
    """df with a dense row number from 0 in the given order."""
    return cumulated(df, order, F.lit(1), name).withColumn(name, F.col(name).cast("long"))


def zipped(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of two tables side by side in their orders; the tables must be of one length."""
    from strataloom.errors import InvalidRequestError

    a, b = with_index(left, left_order, "_i"), with_index(right, right_order, "_j")
    if left.count() != right.count():
        raise InvalidRequestError("parent and child differ in length", "parent")
    return a.join(b, a["_i"] == b["_j"]).drop("_i", "_j")


def length_stats(df: DataFrame, key: str) -> DataFrame:
    """One row: number of entities, and the max and the median (cut to a whole number) of their lengths."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("entities"), F.max("n").alias("longest"), F.floor(F.median("n")).cast("long").alias("median"))


def positions(df: DataFrame, key: str, order: list[str], features: list[str]) -> DataFrame:
    """key, sidx, slen, ridx and the features: each entity's rows and one row of zeros behind them, counted from both ends."""
    rows = df.select(key, F.lit(0).alias("last"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *features)
    ends = df.select(key).distinct().select(key, F.lit(1).alias("last"), *[F.lit(None).cast(df.schema[o].dataType).alias(f"_o{i}") for i, o in enumerate(order)], *[F.lit(0).cast(df.schema[f].dataType).alias(f) for f in features])
    return _numbered(rows.unionByName(ends), key, ["last", *[f"_o{i}" for i in range(len(order))]], features)


def _numbered(rows: DataFrame, key: str, order: list[str], features: list[str]) -> DataFrame:
    own = Window.partitionBy(key)
    sidx = (F.row_number().over(own.orderBy(*order)) - 1).cast("int")
    slen = (F.count("*").over(own) - 1).cast("int")
    return rows.withColumns({"sidx": sidx, "slen": slen}).withColumn("ridx", F.col("slen") - F.col("sidx")).select(key, "sidx", "slen", "ridx", *features)


def childless(parents: DataFrame, pk: str, children: DataFrame, fk: str) -> DataFrame:
    """Parents without children."""
    return parents.join(children.select(F.col(fk).alias("_fk")), parents[pk] == F.col("_fk"), "left_anti")


def with_empty_entities(rows: DataFrame, key: str, parents: DataFrame, pk: str, features: list[str]) -> DataFrame:
    """positions() with a single row of zeros for each parent without children."""
    none = childless(parents, pk, rows, key).select(F.col(pk).alias(key), *[F.lit(0).cast("int").alias(c) for c in ("sidx", "slen", "ridx")], *[F.lit(0).cast(rows.schema[f].dataType).alias(f) for f in features])
    return rows.unionByName(none)


def lists(df: DataFrame, key: str, order: list[str], features: list[str]) -> DataFrame:
    """One row per entity: each feature as the list of its values in order."""
    packed = F.sort_array(F.collect_list(F.struct(*order, *[F.col(f).alias(f"_f{i}") for i, f in enumerate(features)])))
    rows = df.groupBy(key).agg(packed.alias("_all"))
    return rows.select(key, *[F.col(f"_all._f{i}").alias(f) for i, f in enumerate(features)])


def padded(df: DataFrame, columns: list[str], fill: int = -1) -> DataFrame:
    """Lists filled up with `fill` to the length of the longest."""
    most = df.agg(F.coalesce(F.max(F.greatest(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])), F.lit(0))).first()[0]
    return df.withColumns({c: F.concat(c, F.array_repeat(F.lit(fill).cast(df.schema[c].dataType.elementType), F.lit(most) - F.size(c))) for c in columns})


def positional(values: Column, most: int, prefix: str) -> dict[str, Column]:
    """Codes of positions from 0 to `most`: one column below 100, from there on a column per decimal digit, the highest first."""
    if most < 100:
        return {f"{prefix}cat": values.cast("int")}
    digits = len(str(most))
    return {f"{prefix}E{e}": (F.floor(values / 10**e) % 10).cast("int") for e in reversed(range(digits))}


def lengths(ridx: Column) -> Column:
    """Length of an entity from its list of ridx: the first 0 ends it."""
    at = F.array_position(ridx, 0)
    return F.when(at > 0, at - 1).otherwise(F.size(ridx)).cast("int")


def flattened(df: DataFrame, key: str | list[str], length: Column, columns: list[str]) -> DataFrame:
    """One row per step of each entity's lists, step from 0, up to its length."""
    packed = F.arrays_zip(*[F.col(c) for c in columns])
    keys = [key] if isinstance(key, str) else key
    return df.select(*keys, F.posexplode(F.slice(packed, 1, length)).alias("step", "_s")).select(*keys, "step", *[F.col(f"_s.{c}") for c in columns])


def with_parent(children: DataFrame, fk: str, parents: DataFrame, pk: str, columns: list[str]) -> DataFrame:
    """Children with columns of their parents; an unknown parent is an error, a double one multiplies."""
    from strataloom.errors import InvalidRequestError

    lost = children.join(parents.select(F.col(pk).alias("_pk")), children[fk] == F.col("_pk"), "left_anti").limit(1).count()
    if lost:
        raise InvalidRequestError(f"{fk} holds keys that {pk} doesn't have", "foreign_key")
    own = parents.select(F.col(pk).alias("_pk"), *columns)
    return children.join(own, children[fk] == F.col("_pk")).drop("_pk")


def sequential_conditions(conditions: DataFrame, key: str, order: list[str], columns: list[str], entities: DataFrame, pk: str) -> DataFrame:
    """Code lists per entity, all entities included, filled up with -1."""
    rows = lists(conditions, key, order, columns)
    met = entities.select(F.col(pk).alias("_pk")).join(rows, F.col("_pk") == F.col(key), "left").drop(key).withColumnRenamed("_pk", key)
    return padded(met.select(key, *[F.coalesce(c, F.array().cast(rows.schema[c].dataType)).alias(c) for c in columns]), columns)


def restored(originals: DataFrame, generated: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Originals with their null cells filled from the generated row of the same keys."""
    made = generated.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_g{i}") for i, c in enumerate(columns)])
    on = [originals[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    fill = {c: f"_g{i}" for i, c in enumerate(columns)}
    met = originals.join(made, on, "left")
    return met.select(*[F.coalesce(F.col(f"`{c}`"), F.col(fill[c]).cast(originals.schema[c].dataType)).alias(c) if c in fill else F.col(f"`{c}`") for c in originals.columns])


def train_split(df: DataFrame, key: list[str], share: float, seed: int = 0) -> DataFrame:
    """df with `part`: "val" for max(1, round(share * n)) rows by the order of a hash, else "train".

    The cut is found from counts per range of the hash; only the rows of the range that holds it are sorted.
    """
    rows = df.withColumn("_h", F.xxhash64(F.lit(seed), *key))
    n = df.count()
    most = max(1, round(n * share)) if n > 1 else 0
    ranges = max(64, n // 10_000)
    width = (1 << 64) // ranges + 1
    at = F.floor((F.col("_h").cast("double") + float(1 << 63)) / float(width)).cast("long")  # never falls as _h grows
    counts = rows.groupBy(at.alias("at")).agg(F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = counts.withColumn("ahead", ahead).where((F.col("ahead") < most) & (F.col("ahead") + F.col("n") >= most)).first()
    if cut is None:
        return rows.withColumn("part", F.lit("train")).drop("_h")
    limit = rows.where(at == cut["at"]).select(F.struct("_h", *key).alias("k")).orderBy("k").limit(most - cut["ahead"]).agg(F.max("k")).first()[0]
    inside = F.struct("_h", *key) <= F.struct(*[F.lit(v).cast(t) for v, t in zip(limit, ["long", *[df.schema[k].dataType for k in key]], strict=True)])
    return rows.withColumn("part", F.when(inside, "val").otherwise("train")).drop("_h")


def split_for(df: DataFrame, key: list[str], config: ModelConfig) -> DataFrame:
    """train_split by a model's settings."""
    return train_split(df, key, config.val_split, config.seed or 0)
