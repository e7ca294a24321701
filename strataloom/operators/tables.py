"""Related tables: keys, the order of tables, and generating all of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.config import ModelConfig, Synthetic, resolve_config
from strataloom.errors import InvalidRequestError
from strataloom.functions.rng import any_seed, uniform
from strataloom.operators import sampler
from strataloom.operators.draws import ANY, Shape, drawn
from strataloom.operators.encode import encode_columns
from strataloom.operators.profile import Profile, profile_table
from strataloom.operators.sequences import with_index
from strataloom.sources.scratch import written

KEY_TYPES = ("dxid", "uuid", "int")
# Fixed value: digits of a number of base 62.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@dataclass
class Table:
    """A table with its primary key and its foreign keys (column: name of the parent table).

    sequential: rows are sequences of the parent named by sequence_by, in the order of `order`.
    """

    data: DataFrame
    primary_key: str | None = None
    foreign_keys: dict[str, str] = field(default_factory=dict)
    sequential: bool = False
    sequence_by: str | None = None
    order: tuple[str, ...] = ()
    pk_type: str = "int"

    def __post_init__(self) -> None:
        def need(ok: bool, message: str, param: str) -> None:
            if not ok:
                raise InvalidRequestError(message, param)

        need(isinstance(self.data, DataFrame), "data must be a DataFrame", "data")
        need(self.primary_key is None or self.primary_key in self.data.columns, f"no column {self.primary_key!r}", "primary_key")
        for fk in self.foreign_keys:
            need(fk in self.data.columns, f"no column {fk!r}", "foreign_keys")
            need(fk != self.primary_key, f"{fk!r} can't be both keys", "foreign_keys")
        need(self.pk_type in KEY_TYPES, f"pk_type must be one of {KEY_TYPES}", "pk_type")
        need(not self.sequential or bool(self.foreign_keys), "a sequential table needs a foreign key", "sequential")
        need(not self.sequential or len(self.foreign_keys) == 1 or self.sequence_by is not None, "with several foreign keys, sequence_by must name one", "sequence_by")
        need(self.sequence_by is None or self.sequential, "sequence_by needs a sequential table", "sequence_by")
        need(self.sequence_by is None or self.sequence_by in self.foreign_keys, f"{self.sequence_by!r} is no foreign key", "sequence_by")
        need(not self.sequential or bool(self.order), "a sequential table needs an order", "order")
        need(all(c in self.data.columns for c in self.order), "order must name columns", "order")

    @property
    def context_key(self) -> str | None:
        """The foreign key whose parent gives the entities: sequence_by, or the only one."""
        return self.sequence_by or (next(iter(self.foreign_keys)) if len(self.foreign_keys) == 1 else None)


def check_tables(tables: dict[str, Table]) -> list[str]:
    """Names with parents first. Parents must exist, have a primary key, not be the table itself, and not form a cycle."""
    if not tables:
        raise InvalidRequestError("no tables", "tables")
    for name, t in tables.items():
        for fk, parent in t.foreign_keys.items():
            if parent not in tables:
                raise InvalidRequestError(f"{name}.{fk}: no table {parent!r}", "foreign_keys")
            if parent == name:
                raise InvalidRequestError(f"{name}.{fk} refers to its own table", "foreign_keys")
            if tables[parent].primary_key is None:
                raise InvalidRequestError(f"{parent!r} has no primary key", "primary_key")
    try:
        return list(TopologicalSorter({k: sorted(set(t.foreign_keys.values())) for k, t in tables.items()}).static_order())
    except CycleError as e:
        raise InvalidRequestError(f"tables refer to each other in a cycle: {e.args[1]}", "foreign_keys") from None


def orphans(children: DataFrame, fk: str, parents: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key no parent has; a null key is an orphan."""
    return children.join(parents.select(F.col(pk).cast(children.schema[fk].dataType).alias("_pk")).distinct(), children[fk] == F.col("_pk"), "left_anti")


def remap_orphans(children: DataFrame, fk: str, order: list[str], parents: DataFrame, pk: str) -> DataFrame:
    """children with each orphan's key replaced: orphan k (in order) gets parent k mod n (in the order of pk). order and pk are numbers."""
    kind = parents.schema[pk].dataType
    children = children.withColumn(fk, F.col(fk).try_cast(kind))
    keys = with_index(parents.select(F.col(pk).alias("_pk")).distinct(), ["_pk"], "_i")
    n = keys.count()
    if not n:
        return children.withColumn(fk, F.lit(None).cast(kind))
    lost = with_index(orphans(children, fk, parents, pk).select(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]), [f"_o{i}" for i in range(len(order))], "_k")
    lost = lost.join(keys, F.pmod(F.col("_k"), F.lit(n)) == F.col("_i")).select(*[f"_o{i}" for i in range(len(order))], "_pk")
    met = children.join(lost, [children[o].eqNullSafe(F.col(f"_o{i}")) for i, o in enumerate(order)], "left")
    return met.select(*[F.coalesce("_pk", fk).alias(c) if c == fk else F.col(f"`{c}`") for c in children.columns])


@dataclass
class Strata:
    """How keys of parents go with children: the code columns of both that say most about each other, and counts (by, code, n) of them."""

    profile: Profile  # of the parents' columns
    child: str | None = None
    parent: str | None = None
    counts: DataFrame | None = None
    cards: tuple[int, int] = (1, 1)


def fit_strata(children: DataFrame, fk: str, profile: Profile, parents: DataFrame, pk: str, columns: list[str], config: ModelConfig) -> Strata:
    """What the children's columns have to do with the `columns` of their parents: the pair of code columns with the highest mutual information, if they depend on each other at all.

    profile: of the children. Children without a known parent don't count.
    """
    out = Strata(profile_table(parents.select(*[F.col(f"`{c}`") for c in columns]), {k: v for k, v in config.parent_encoding_types.items() if k in columns}, config.privacy, config.seed))
    own = encode_columns(children, profile, (fk,)).withColumnRenamed(fk, "_fk")
    theirs = encode_columns(parents, out.profile, (pk,)).withColumnRenamed(pk, "_pk").withColumnsRenamed({c: f"parent:{c}" for c in out.profile.cardinalities})
    rows = own.join(theirs, F.col("_fk") == F.col("_pk"))
    cell = lambda c, p: F.struct(F.lit(c).alias("child"), F.lit(p).alias("parent"), F.col(f"`{c}`").cast("int").alias("by"), F.col(f"`parent:{p}`").cast("int").alias("code"))
    cells = [cell(c, p) for c in profile.cardinalities for p in out.profile.cardinalities]
    if not cells:
        return out
    counts = rows.select(F.explode(F.array(*cells)).alias("s")).select("s.*").groupBy("child", "parent", "by", "code").agg(F.count("*").alias("n"))
    counts = written(counts, "strata")
    n, pair = F.col("n").cast("double"), Window.partitionBy("child", "parent")
    total, x, y = F.sum("n").over(pair), F.sum("n").over(Window.partitionBy("child", "parent", "by")), F.sum("n").over(Window.partitionBy("child", "parent", "code"))
    told = counts.withColumns({"t": total, "x": x, "y": y}).groupBy("child", "parent").agg(F.sum(n / F.col("t") * F.log(n * F.col("t") / (F.col("x") * F.col("y")))).alias("mi"), F.count_distinct("by").alias("a"), F.count_distinct("code").alias("b"), F.max("t").alias("t")).collect()
    known = [r for r in told if sampler.dependent(r.mi, r.a, r.b, r.t)]
    if known:
        best = max(known, key=lambda r: (r.mi, r.child, r.parent))
        mine = counts.where((F.col("child") == best.child) & (F.col("parent") == best.parent)).select("by", "code", "n")
        alone = mine.groupBy("code").agg(F.sum("n").alias("n")).select(F.lit(ANY).alias("by"), "code", "n")
        out.child, out.parent, out.counts, out.cards = best.child, best.parent, mine.union(alone), (profile.cardinalities[best.child], out.profile.cardinalities[best.parent])
    return out


def matched_keys(children: DataFrame, fk: str, profile: Profile, strata: Strata, parents: DataFrame, pk: str, seed: int, row: str = "row_id") -> DataFrame:
    """children with fk: the key of a parent drawn for each, in two steps: a stratum given the child's code, then any parent of it.

    Numbers are hashes of the seed, fk and `row`. Parents stand in the order of their strata and
    keys; a stratum without parents stands for all of them. Without any parents keys are null.
    """
    kept = children.columns
    if strata.counts is None:
        placed, rows = parents.select(F.col(pk).alias("_pk")).withColumn("_stratum", F.lit(0)), children.withColumn("_drawn_stratum", F.lit(0))
    else:
        placed = encode_columns(parents, strata.profile, (pk,)).select(F.col(pk).alias("_pk"), F.col(f"`{strata.parent}`").cast("int").alias("_stratum"))
        coded = encode_columns(children, profile, tuple(kept)).select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{strata.child}`").alias("_child_code"))
        rows = drawn(coded, "_drawn_stratum", uniform(seed, F.lit(f"stratum:{fk}"), row), strata.counts, Shape(), strata.cards[1], F.col("_child_code"), strata.cards[0])
    keys = with_index(placed, ["_stratum", "_pk"], "_i")
    sizes = [(r["_stratum"], r.first, r.n) for r in keys.groupBy("_stratum").agg(F.min("_i").alias("first"), F.count("*").alias("n")).collect()]  # one row per code
    total = sum(n for _, _, n in sizes)
    table = F.broadcast(children.sparkSession.createDataFrame(sizes, "_of int, _first long, _size long"))
    rows = rows.join(table, F.col("_drawn_stratum") == F.col("_of"), "left")
    at = F.floor(uniform(seed, F.lit(f"key:{fk}"), row) * F.coalesce("_size", F.lit(total))).cast("long") + F.coalesce("_first", F.lit(0))
    met = rows.withColumn("_at", at).join(keys.select("_pk", "_i"), F.col("_at") == F.col("_i"), "left")
    return met.select(*[F.col(f"`{c}`") for c in kept if c != fk], F.col("_pk").alias(fk))


def base62(digest: Column) -> Column:
    """22 base-62 digits of a 128-bit number given as 32 hex digits, from two halves of 64 bits."""
    out = []
    for at in (1, 17):
        high = F.conv(F.substring(digest, at, 8), 16, 10).cast("decimal(20,0)")
        low = F.conv(F.substring(digest, at + 8, 8), 16, 10).cast("decimal(20,0)")
        n = (high * F.lit(4294967296).cast("decimal(11,0)") + low).cast("decimal(38,0)")
        for k in range(10, -1, -1):
            # only whole quotients are exact: others are rounded to six digits, up to the next number if they are near it
            power = F.lit(62**k).cast("decimal(20,0)")
            out.append(F.substring(F.lit(BASE62), F.pmod((n - n % power) / power, F.lit(62)).cast("int") + 1, F.lit(1)))
    return F.concat(*out)


def key_column(kind: str, index: Column, seed: int) -> Column:
    """A primary key for a dense row number from 0: 1, 2, ...; 22 base-62 digits of a hash of the seed; or a random UUID, which no seed fixes."""
    if kind == "int":
        return (index + 1).cast("long")
    if kind == "uuid":
        return F.uuid()
    return F.concat(F.lit("dxid_"), base62(F.md5(F.concat_ws("|", F.lit(str(seed)), index.cast("string")))))


def assign_key(df: DataFrame, pk: str, kind: str, row_id: str = "row_id", seed: int | None = None) -> DataFrame:
    """df with the primary key as the first column, from a dense row number."""
    return df.select(key_column(kind, F.col(row_id), any_seed(seed)).alias(pk), *[F.col(f"`{c}`") for c in df.columns if c not in (row_id, pk)])


def check_per_table(value: dict | None, tables: dict[str, Table], name: str, fits, hint: str) -> dict:
    """A setting by table: its tables exist and its values fit; an empty dict for None."""
    unknown = set(value or {}) - set(tables)
    if unknown:
        raise InvalidRequestError(f"{name}: no such tables: {sorted(unknown)}", name)
    for table, v in (value or {}).items():
        if not fits(v):
            raise InvalidRequestError(f"{name} of {table!r} must be {hint}", name)
    return value or {}


def _number(v: object) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def synthesize_tables(
    spark: SparkSession, tables: dict[str, Table], presets: dict[str, Synthetic] | None = None, config: ModelConfig | dict | None = None, seed: int | None = None,
    diversity: dict[str, float] | None = None, rare_cutoff: dict[str, float] | None = None,
) -> dict[str, DataFrame]:
    """New tables with valid keys. Models learn from the real parents; rows are made for the new ones.

    Steps of sequences depend on the columns of their parents. Other foreign keys, of flat tables
    too, are drawn among the new parents that go with the row (see matched_keys), so what a row has
    to do with its parents comes down to their children. diversity and rare_cutoff: by table.
    """
    names, seed, out = check_tables(tables), any_seed(seed), {}
    check_per_table(presets, tables, "presets", lambda v: isinstance(v, Synthetic), "a Synthetic")
    diversity = check_per_table(diversity, tables, "diversity", lambda v: _number(v) and v > 0, "above 0")
    rare_cutoff = check_per_table(rare_cutoff, tables, "rare_cutoff", lambda v: _number(v) and 0 < v <= 1, "above 0 and 1 at most")
    for k, name in enumerate(names):
        t, preset = tables[name], (presets or {}).get(name)
        own = {"seed": seed + k if preset is None or preset.seed is None else None} | {n: v[name] for n, v in (("diversity", diversity), ("rare_cutoff", rare_cutoff)) if name in v}
        keys = {t.primary_key, *t.foreign_keys} - {None}
        data = t.data.drop(*keys)
        if t.sequential:
            parent = tables[t.foreign_keys[t.context_key]]
            rows = t.data.select(t.context_key, *[c for c in t.data.columns if c not in keys or c in t.order])
            order = [c for c in t.order]
            model = sampler.fit(rows.select(t.context_key, *[F.col(o).alias(f"_order{i}") for i, o in enumerate(order)], *data.columns), config, t.context_key, [f"_order{i}" for i in range(len(order))], parent.data, parent.primary_key, [c for c in parent.data.columns if c not in {parent.primary_key, *parent.foreign_keys}])
            new_parent = out[t.foreign_keys[t.context_key]]
            made = sampler.generate_sequences(spark, model, new_parent, parent.primary_key, preset=preset, **own)
            made = _dense(made, t.context_key)
        else:
            model = sampler.fit(data, config)
            made = sampler.generate(spark, model, None if preset and preset.n else t.data.count(), preset, **own)
        # a row_id that is written keeps its row, however often what follows reads it
        made = written(made, "made")
        for fk, name_of in t.foreign_keys.items():
            if fk not in made.columns:
                of = tables[name_of]
                about = [c for c in of.data.columns if c not in {of.primary_key, *of.foreign_keys}]
                strata = fit_strata(t.data, fk, model.profile, of.data, of.primary_key, about, resolve_config(config))
                made = matched_keys(made, fk, model.profile, strata, out[name_of], of.primary_key, seed + k)
        columns = [c for c in t.data.columns if c != t.primary_key]
        made = made.select("row_id", *columns)
        out[name] = assign_key(made, t.primary_key, t.pk_type, seed=seed + k) if t.primary_key else made.drop("row_id")
    return out


def _dense(made: DataFrame, key: str) -> DataFrame:
    """Sequence rows with a dense row_id, in the order of a hash of the entity and the step."""
    return with_index(made.withColumn("_h", F.xxhash64(key).cast("double")), ["_h", key, "step"], "row_id").drop("_h", "step")
