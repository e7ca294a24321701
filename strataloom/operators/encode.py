"""Encoding of rows to integer codes by a profile: one projection for all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.functions import values as V
from strataloom.functions.rng import uniform
from strataloom.operators.profile import ColumnProfile, Profile, code_name, number_label, value_ranks
from strataloom.operators.ranks import at_ranks

#: Labels up to which a lookup is a literal map; longer vocabularies are joined.
MAP_LABELS = 2000


def _lookup(value: Column, labels: list[str], has_null: bool) -> Column:
    """The code of a label: 0 for unknown ones, the null code (or 0) for null."""
    known = {v: i for i, v in enumerate(labels) if v not in (V.RARE, V.NULL)}
    code = F.lit(0)
    if known:
        table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
        code = F.coalesce(F.try_element_at(table, value), F.lit(0))
    return F.when(value.isNull(), F.lit(1 if has_null else 0)).otherwise(code).cast("int")


def bin_code(v: Column, edges: list[float]) -> Column:
    """The left-closed bin of v, outer bins open; halves the edges at each step."""

    def within(lo: int, hi: int) -> Column:
        if hi - lo <= 1:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v < edges[mid], within(lo, mid)).otherwise(within(mid, hi))

    return within(0, max(len(edges) - 1, 1)).cast("int")


def fill_missing(df: DataFrame, column: str, row: str, seed: int = 0, name: str | None = None) -> DataFrame:
    """df with `name` (the column itself if None): its values, and for nulls values drawn from those of the other rows, as often as they have them.

    A row's draw is a hash of the seed, the column and its `row`: the rank of a value among all
    sorted ones. Without any values nulls stay.
    """
    name = name or column
    values, total = value_ranks(df, F.col(f"`{column}`"))
    if not total:
        return df.withColumn(name, F.col(f"`{column}`"))
    c = F.col(f"`{column}`")
    gone = c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()
    rank = F.least(F.floor(uniform(seed, F.lit(column), row) * total), F.lit(total - 1)).cast("long")
    made = at_ranks(values, df.where(gone).select(F.col(row).alias("_filled"), rank.alias("rank")).distinct(), total).select("_filled", F.col("x").alias("_drawn"))
    met = df.join(made, F.col(f"`{row}`") == F.col("_filled"), "left")
    return met.withColumn("_value", F.when(gone, F.col("_drawn")).otherwise(c)).drop("_filled", "_drawn", *([name] if name in df.columns else [])).withColumnRenamed("_value", name)


def column_codes(c: Column, p: ColumnProfile, gone: Column | None = None) -> dict[str, Column]:
    """The code of each sub-column of a value. gone: whether the value stands in for a null."""
    if p.encoding == "categorical":
        return {"cat": _lookup(V.escape_tokens(V.to_text(c, p.kind)), p.labels, p.has_null)}
    if p.encoding == "character":
        text = c.cast("string")
        out = {"nan": (text.isNull() if gone is None else gone).cast("int")} if "nan" in p.subs else {}
        for i, chars in enumerate(p.chars):
            table = F.array(*[F.lit(ch) for ch in chars])
            out[f"P{i}"] = F.greatest(F.array_position(table, V.char_at(text, i)) - 1, F.lit(0)).cast("int") if chars else F.lit(0)
        return {k: F.coalesce(v, F.lit(0)) for k, v in out.items()}
    if p.encoding == "datetime":
        t = V.to_datetime(c, p.day_first) if p.kind == "string" else c.cast("timestamp")
        out = {"nan": (t.isNull() if gone is None else gone).cast("int")} if "nan" in p.subs else {}
        if p.bounds:
            lo, hi = (F.timestamp_micros(F.lit(b)) for b in p.bounds)
            t = V.clamp(t, lo, hi)
        parts = V.datetime_parts(t)
        return out | {k: F.greatest(F.least(parts[k] - p.low[k], F.lit(n - 1)), F.lit(0)).cast("int") for k, n in p.subs.items() if k != "nan"}
    v = V.to_number(c, p.kind)
    if p.encoding == "numeric_discrete":
        return {"cat": _lookup(number_label(v, p.min_decimal), p.labels, p.has_null)}
    if p.encoding == "numeric_digit":
        out = {"nan": (v.isNull() if gone is None else gone).cast("int")} if "nan" in p.subs else {}
        if p.bounds:
            v = V.clamp(v, F.lit(p.bounds[0]), F.lit(p.bounds[1]))
        if "neg" in p.subs:
            out["neg"] = F.coalesce((v < 0).cast("int"), F.lit(0))
        return out | {k: F.greatest(F.least(V.digit(v, int(k[1:])) - p.low[k], F.lit(n - 1)), F.lit(0)).cast("int") for k, n in p.subs.items() if k[0] == "E"}
    at = {s: i for i, s in enumerate(p.specials)}
    code = F.lit(len(at)) + bin_code(v, p.edges) if len(p.edges) > 1 else F.lit(len(at) - 1)
    if p.bounds:
        code = F.when(v == p.bounds[0], at[V.MINIMUM]).when(v == p.bounds[1], at[V.MAXIMUM]).otherwise(code)
    return {"bin": F.when(v.isNull(), at.get(V.NULL, at[V.UNKNOWN])).otherwise(code).cast("int")}


def encode_columns(df: DataFrame, profile: Profile, keep: tuple[str, ...] = (), seed: int = 0, row: str | None = None) -> DataFrame:
    """df's columns in the profile as code columns, besides those to keep. Columns that the profile doesn't know are left out.

    row: a column that tells rows apart. With it, digits, dates and characters of a null are those
    of a value drawn from the other rows (fill_missing); without it they are those of nothing.
    """
    out = [F.col(f"`{k}`") for k in keep]
    long, gone = {}, {}
    for name, p in profile.columns.items():
        if row and name in df.columns and "nan" in p.subs:
            gone[name] = F.col(f"_gone:{name}")
            df = fill_missing(df.withColumn(f"_gone:{name}", F.col(f"`{name}`").isNull()), name, row, seed)
    for name, p in profile.columns.items():
        if name in df.columns:
            if p.encoding in ("categorical", "numeric_discrete") and (p.table is not None or len(p.labels) > MAP_LABELS):
                long[name] = p
                continue
            codes = column_codes(F.col(f"`{name}`"), p, gone.get(name))
            out += [codes[s].alias(code_name(name, s)) for s in p.subs]
    if not long:
        return df.select(*out)
    for name, p in long.items():
        c = F.col(f"`{name}`")
        text = V.escape_tokens(V.to_text(c, p.kind)) if p.encoding == "categorical" else number_label(V.to_number(c, p.kind), p.min_decimal)
        if p.table is not None:
            table = p.table.select(F.col("value").alias(f"_v{name}"), F.col("code").alias(f"_c{name}")).hint("merge")  # never sent whole
        else:
            table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(p.labels) if v not in (V.RARE, V.NULL)], f"`_v{name}` string, `_c{name}` int")
        df = df.join(table, text == F.col(f"`_v{name}`"), "left")
        out.append(F.when(text.isNull(), F.lit(1 if p.has_null else 0)).otherwise(F.coalesce(F.col(f"`_c{name}`"), F.lit(0))).cast("int").alias(code_name(name, "cat")))
    return df.select(*out)


def encode_by_join(df: DataFrame, column: str, vocabulary: DataFrame, has_null: bool) -> DataFrame:
    """df with `code`: of a value by a join with a vocabulary (value, code) of any size; 0 if unknown."""
    met = df.join(vocabulary.withColumnRenamed("value", "_value"), V.escape_tokens(F.col(column)) == F.col("_value"), "left").drop("_value")
    return met.withColumn("code", F.when(F.col(column).isNull(), F.lit(1 if has_null else 0)).otherwise(F.coalesce("code", F.lit(0))).cast("int"))


def fixed_values(conditions: DataFrame, profile: Profile, free: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Conditions as codes; -1 where a cell of a `free` column is null and so is to be filled."""
    codes = encode_columns(conditions.select(*[c for c in conditions.columns]), profile, tuple(conditions.columns))
    out = [F.col(f"`{k}`") for k in keep]
    for name, p in profile.columns.items():
        if name in conditions.columns:
            for s in p.subs:
                c = F.col(f"`{code_name(name, s)}`")
                out.append((F.when(F.col(f"`{name}`").isNull(), -1).otherwise(c) if name in free else c).alias(code_name(name, s)))
    return codes.select(*out)
