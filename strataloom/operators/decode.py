"""Decoding of codes to values by a profile: one projection for all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataloom.functions import values as V
from strataloom.functions.rng import uniform
from strataloom.operators.profile import ColumnProfile, Profile, code_name


#: Labels up to which they are a literal array; longer lists are joined, and sent to all tasks up to so many characters.
ARRAY_LABELS, BROADCAST = 2000, 4 << 20


def known_labels(p: ColumnProfile) -> int:
    """How many labels of values there are, without the tokens."""
    return max(0, p.n_labels - (2 if p.has_null else 1))


def label_code(code: Column, p: ColumnProfile, rare: str, seed: int, row: Column) -> Column:
    """The code whose label stands for this one: for that of rare values a drawn one, or the null code, or itself."""
    first, n = (2 if p.has_null else 1), known_labels(p)
    drawn = F.lit(first) + F.floor(uniform(seed, F.lit(p.name), F.lit("rare"), row) * n).cast("int")
    if p.encoding == "categorical":
        return F.when(code == 0, drawn).otherwise(code) if rare == "sample" else code
    return F.when(code == 0, F.lit(1) if p.has_null else drawn).otherwise(code)


def label_value(label: Column, p: ColumnProfile) -> Column:
    """The value of a label."""
    if p.encoding == "categorical":
        return F.when(label == V.NULL, None).when(label == V.RARE, label).otherwise(V.unescape_tokens(label))
    return F.when(label != V.NULL, label).try_cast("long" if p.min_decimal >= 0 else "double")


def decode_column(codes: dict[str, Column], p: ColumnProfile, rare: str, seed: int, row: Column) -> Column:
    """The value of the codes of one column. rare: "mask" writes a token for a rare value, "sample" a frequent value."""
    if p.encoding in ("categorical", "numeric_discrete"):
        if not known_labels(p):
            return F.lit(None).cast("string" if p.encoding == "categorical" else "double")
        return label_value(F.get(F.array(*[F.lit(x) for x in p.labels]), label_code(codes["cat"], p, rare, seed, row)), p)
    if p.encoding == "numeric_binned":
        at = {s: i for i, s in enumerate(p.specials)}
        edges = F.array(*[F.lit(float(e)) for e in p.edges])
        i = codes["bin"] - len(at)
        lo, hi = F.get(edges, i), F.get(edges, i + 1)
        v = lo + uniform(seed, F.lit(p.name), row) * (hi - lo)
        scale = float(10 ** max(0, -p.min_decimal))
        v = F.greatest(F.floor(v * scale) / scale, lo)
        if p.bounds:
            v = F.when(codes["bin"] == at[V.MINIMUM], F.lit(float(p.bounds[0]))).when(codes["bin"] == at[V.MAXIMUM], F.lit(float(p.bounds[1]))).otherwise(v)
        v = F.when(codes["bin"] >= len(at) - (2 if p.bounds else 0), v)
        return V.saturated(v) if p.min_decimal >= 0 else v
    gone = codes["nan"] == 1 if "nan" in codes else F.lit(False)
    if p.encoding == "character":
        chars = [F.get(F.array(*[F.lit(ch) for ch in cs]), codes[f"P{i}"]) for i, cs in enumerate(p.chars)]
        return F.when(~gone, V.assembled_chars(chars) if chars else F.lit(""))
    if p.encoding == "datetime":
        t = V.assembled_datetime({k: codes[k] + p.low[k] for k in p.low})
        if p.bounds:
            t = V.clamp(t, *[F.timestamp_micros(F.lit(b)) for b in p.bounds])
        return F.when(~gone, t)
    zero = F.lit(0).cast("decimal(38,8)")
    v = sum(((codes[k] + low) * F.lit(10.0 ** int(k[1:])).cast("decimal(28,8)") for k, low in p.low.items()), zero).cast("double")
    if "neg" in codes:
        v = F.when(codes["neg"] == 1, -v).otherwise(v)
    if not p.bounds:
        return F.when(F.lit("nan" not in codes), v) if "nan" not in codes else F.lit(None).cast("double")
    v = V.clamp(v, F.lit(float(p.bounds[0])), F.lit(float(p.bounds[1])))
    return F.when(~gone, V.half_even(v) if p.min_decimal >= 0 else v)


def decode_columns(codes: DataFrame, profile: Profile, rare: str = "sample", seed: int = 0, row: str = "row_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Code columns as values, in the order of the profile, besides the columns to keep. row: a column that tells rows apart."""
    out = [F.col(f"`{k}`") for k in keep]
    for at, (name, p) in enumerate(profile.columns.items()):
        if (p.table is not None or len(p.labels) > ARRAY_LABELS) and code_name(name, "cat") in codes.columns:
            table = codes.sparkSession.createDataFrame(list(enumerate(p.labels)), f"_k{at} int, _v{at} string")
            if p.table is not None:
                table = table.union(p.table.select("code", "value")).hint("merge")  # never sent whole
            else:
                table = F.broadcast(table) if sum(map(len, p.labels)) <= BROADCAST else table
            codes = codes.withColumn(f"_c{at}", label_code(F.col(f"`{code_name(name, 'cat')}`"), p, rare, seed, F.col(row))).join(table, F.col(f"_c{at}") == F.col(f"_k{at}"), "left")
            out.append(label_value(F.col(f"_v{at}"), p).alias(name))
        elif all(code_name(name, s) in codes.columns for s in p.subs):
            own = {s: F.col(f"`{code_name(name, s)}`") for s in p.subs}
            out.append(decode_column(own, p, rare, seed, F.col(row)).alias(name))
    return codes.select(*out)
