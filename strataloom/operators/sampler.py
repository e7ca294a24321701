"""A model of coded rows and the sampling of new ones.

Code columns are drawn one after another, each given one earlier column: the one that tells most
about it (mutual information). A draw is a join with a table of cumulated shares (see draws) and a
search for a hashed uniform number. Cardinalities are bounded by the profile, so these tables are too.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.config import Bias, Distribution, ModelConfig, Synthetic, check_scalars, merged, resolve_config
from strataloom.errors import InvalidRequestError, NotReadyError
from strataloom.functions.rng import any_seed, uniform
from strataloom.operators import constraints as C
from strataloom.operators import paths as P
from strataloom.operators import sequences as S
from strataloom.operators.decode import decode_columns
from strataloom.operators.draws import ANY, Shape, drawn
from strataloom.operators.encode import encode_columns, fixed_values
from strataloom.operators.profile import Profile, code_name, null_columns, profile_table


def pair_counts(codes: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, a, b, n): rows by the codes of each pair of columns i < j. One pass; i = j holds single columns."""
    pairs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"`{columns[i]}`").alias("a"), F.col(f"`{columns[j]}`").alias("b")) for j in range(len(columns)) for i in range(j + 1)]
    return codes.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("i", "j", "a", "b").agg(F.count("*").alias("n"))


def informations(pairs: DataFrame) -> tuple[dict[tuple[int, int], tuple[float, int, int]], int]:
    """By (i, j) of columns i < j: mutual information in nats, and how many codes each of the two has; and the number of rows."""
    one = pairs.where("i = j").select(F.col("i").alias("c"), F.col("a").alias("v"), F.col("n").alias("m"))
    total = one.where("c = 0").agg(F.coalesce(F.sum("m"), F.lit(1))).first()[0]
    x = one.select(F.col("c").alias("i"), F.col("v").alias("a"), F.col("m").alias("na"))
    y = one.select(F.col("c").alias("j"), F.col("v").alias("b"), F.col("m").alias("nb"))
    n = F.col("n").cast("double")
    got = pairs.where("i < j").join(x, ["i", "a"]).join(y, ["j", "b"]).groupBy("i", "j").agg(F.sum(n / total * F.log(n * float(total) / (F.col("na") * F.col("nb")))).alias("mi"), F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b")).collect()
    return {(r.i, r.j): (r.mi, r.a, r.b) for r in got}, total


def best_parents(told: dict[tuple[int, int], tuple[float, int, int]], allowed: Callable[[int, int], bool] = lambda i, j: True) -> dict[int, int]:
    """For each column the earlier one, of those allowed, with the highest mutual information, if it says anything."""
    out: dict[int, tuple[float, int]] = {}
    for (i, j), (mi, _, _) in sorted(told.items(), key=lambda kv: (kv[0][1], kv[0][0])):
        if allowed(i, j) and mi > 1e-9 and mi > out.get(j, (0.0, 0))[0] + 1e-12:
            out[j] = (mi, i)
    return {j: i for j, (_, i) in out.items()}


def dependent(mi: float, a: int, b: int, n: int) -> bool:
    """Whether columns of a and b codes depend on each other: a likelihood-ratio test at one in a hundred, its limit by Wilson and Hilferty's formula."""
    free = (a - 1) * (b - 1)
    if free <= 0:
        return False
    limit = free * (1 - 2 / (9 * free) + 2.3263 * math.sqrt(2 / (9 * free))) ** 3
    return 2 * n * mi > limit


def proxies(told: dict[tuple[int, int], tuple[float, int, int]], n: int, features: list[str], sensitive: tuple[str, ...]) -> set[str]:
    """Features with a code column that depends on one of a sensitive feature. features: that of each code column, in order."""
    out = set()
    for (i, j), (mi, a, b) in told.items():
        if (features[i] in sensitive) != (features[j] in sensitive) and dependent(mi, a, b, n):
            out |= {features[i], features[j]} - set(sensitive)
    return out


@dataclass
class Model:
    """A fitted model: fit() makes it; generate() and impute() use it; close() ends it."""

    profile: Profile
    columns: list[str]  # code columns in the order of drawing
    pairs: DataFrame  # pair_counts of the training rows
    n: int
    config: ModelConfig
    status: str = "ready"
    key: str | None = None  # of sequences
    order: tuple[str, ...] = ()  # of their steps
    lengths: DataFrame | None = None  # (n, many): sequence lengths, 0 for childless parents
    steps: DataFrame | None = None  # step_counts of the training rows
    parents: Profile | None = None  # of the parents' columns that steps may depend on

    def close(self) -> None:
        for df in (self.pairs, self.lengths, self.steps):
            if df is not None:
                df.unpersist()
        self.status = "closed"

    def _ready(self) -> None:
        if self.status != "ready":
            raise NotReadyError(f"the model is {self.status}")


def fit(df: DataFrame, config: ModelConfig | dict | None = None, key: str | None = None, order: list[str] = (), parents: DataFrame | None = None, pk: str | None = None, context: list[str] = (), row: str | None = None) -> Model:
    """Profile and encode df, and count what sampling needs. key: the entity of sequential rows, in `order`; parents: all entities.

    context: columns of the parents, on which the steps of their sequences may depend. Digits, dates
    and characters of nulls count as those of values drawn from the other rows, by the column `row`
    that tells rows apart, or by a number that each row gets.
    """
    config = resolve_config(config)
    features = [c for c in df.columns if c not in {key, row, *(order if key else ())}]
    profile = profile_table(df.select(*[F.col(f"`{c}`") for c in features]), {k: v for k, v in config.encoding_types.items() if k in features}, config.privacy, config.seed)
    keep, rows = (key, *order) if key else (), df
    if row is None and any("nan" in p.subs for p in profile.columns.values()):
        rows, row = S.with_index(df.withColumn("_at", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), ["_at"], "_row").drop("_at"), "_row"
    codes = encode_columns(rows, profile, keep, config.seed or 0, row)
    columns = [code_name(p.name, s) for p in profile.columns.values() for s in p.subs]
    pairs = pair_counts(codes, columns).persist()
    out = Model(profile, columns, pairs, df.count(), config, key=key, order=tuple(order))
    if key:
        known = None
        if parents is not None and context:
            out.parents = profile_table(parents.select(*[F.col(f"`{c}`") for c in context]), {k: v for k, v in config.parent_encoding_types.items() if k in context}, config.privacy, config.seed)
            known = encode_columns(parents, out.parents, (pk,)).withColumnsRenamed({c: f"parent:{c}" for c in out.parents.cardinalities})
        out.steps = P.step_counts(codes, key, list(order), columns, known, pk).persist()
        sizes = df.groupBy(key).agg(F.count("*").alias("n"))
        if parents is not None:
            sizes = sizes.select("n").union(S.childless(parents, pk, df, key).select(F.lit(0).cast("long")))
        out.lengths = sizes.groupBy("n").agg(F.count("*").alias("many")).persist()
    return out


def _fixed_of(c: str, codes: DataFrame, draw: Column) -> Column:
    """A condition's code where there is one that isn't -1, else the draw."""
    return F.when(F.col(f"`_f{c}`") >= 0, F.col(f"`_f{c}`")).otherwise(draw) if f"_f{c}" in codes.columns else draw


def sample_codes(model: Model, rows: DataFrame, order: list[str], weights: C.Weights, seed: int | Column, diversity: float = 1.0, cutoff: float = 1.0, bias: Bias | None = None) -> DataFrame:
    """rows (row_id, and _f<column> for conditions) with a code for each column of the model, drawn in the order of features.

    With a bias, the columns that depend on a sensitive one, its proxies, are drawn by themselves
    and each other, and so are all the others, the target last among them. No draw leads from one
    part to the other, so the target keeps what it has to do with admissible columns and is
    independent of the sensitive ones and their proxies.
    """
    index, cards = {c: i for i, c in enumerate(model.columns)}, model.profile.cardinalities
    ordered = [code_name(f, s) for f in order for s in model.profile.columns[f].subs]
    told, n = informations(_in_order(model.pairs, [index[c] for c in ordered]))
    of = [f for f in order for _ in model.profile.columns[f].subs]
    apart = proxies(told, n, of, bias.sensitive) - {bias.target} | set(bias.sensitive) if bias else set()
    parents = best_parents(told, lambda i, j: (of[i] in apart) == (of[j] in apart))
    for at, c in enumerate(ordered):
        counts = model.pairs.where((F.col("i") == index[c]) & (F.col("j") == index[c])).select(F.lit(ANY).alias("by"), F.col("a").alias("code"), "n")
        p = parents.get(at)
        if p is not None:
            i, j = index[ordered[p]], index[c]
            a, b = ("a", "b") if i < j else ("b", "a")
            both = model.pairs.where((F.col("i") == min(i, j)) & (F.col("j") == max(i, j)))
            counts = both.select(F.col(a).alias("by"), F.col(b).alias("code"), "n").union(counts)
        by = (F.col(f"`{ordered[p]}`"), cards[ordered[p]]) if p is not None else (None, 1)
        rows = drawn(rows, c, uniform(seed, F.lit(c), "row_id"), counts, Shape.of(weights.get(c, {}), diversity, cutoff), cards[c], *by)
        rows = rows.withColumn(c, _fixed_of(c, rows, F.col(f"`{c}`")))
    return rows


def _in_order(pairs: DataFrame, at: list[int]) -> DataFrame:
    """pair_counts with columns numbered by their place in `at`."""
    place = F.create_map(*[F.lit(v) for i, c in enumerate(at) for v in (c, i)])
    rows = pairs.select(F.element_at(place, F.col("i")).alias("pi"), F.element_at(place, F.col("j")).alias("pj"), "a", "b", "n")
    turn = F.col("pi") > F.col("pj")
    return rows.select(F.least("pi", "pj").alias("i"), F.greatest("pi", "pj").alias("j"), F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"), "n")


def generate(spark: SparkSession, model: Model, n: int | None = None, preset: Synthetic | None = None, conditions: DataFrame | None = None, distribution: list[Distribution] | Distribution | None = None, bias: Bias | None = None, imputed: list[str] = (), trials: int | None = None, **given: object) -> DataFrame:
    """New flat rows. conditions: one row per row to make, with `row_id` from 0; its values come back as they are.

    trials: make every row so many times, told apart by `trial` from 0, which adds to the seed; all in one pass.
    given: seed, diversity, rare_cutoff, rare_strategy; they win over the preset.
    """
    model._ready()
    want = merged(preset, n=n, **given)
    wanted = [distribution] if isinstance(distribution, Distribution) else list(distribution or [])
    profile, seed = model.profile, any_seed(want.seed if want.seed is not None else model.config.seed)
    rare = want.rare_strategy or model.config.privacy.rare_strategy
    if bias:
        C.check_bias(profile, bias)
    named = [c for c in (conditions.columns if conditions is not None else ()) if c in profile.columns]
    order = C.column_order(list(profile.columns), named, [d.column for d in wanted], list(imputed), bias)
    weights = C.merged_weights(C.rare_weights(profile, rare), C.imputation_weights(profile, list(imputed)), C.distribution_weights(profile, wanted))
    if conditions is None:
        rows = spark.range(want.n or model.config.n or model.n).select(F.col("id").alias("row_id"))
    else:
        codes = fixed_values(conditions.select("row_id", *named), profile, tuple(imputed), ("row_id",))
        rows = codes.select("row_id", *[F.col(f"`{c}`").alias(f"_f{c}") for c in codes.columns if c != "row_id"])
    keys = ("row_id",)
    if trials is not None:
        rows, keys = rows.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))), ("row_id", "trial")
        seed = F.lit(seed) + F.col("trial")
    out = decode_columns(sample_codes(model, rows, order, weights, seed, want.diversity, want.rare_cutoff, bias), profile, rare, seed, "row_id", keys)
    if conditions is not None:
        given_cells = conditions.select(F.col("row_id").alias("_id"), *[F.col(f"`{c}`").alias(f"_c{c}") for c in named])
        met = out.join(given_cells, F.col("row_id") == F.col("_id"))
        out = met.select(*keys, *[F.coalesce(F.col(f"`_c{c}`").cast(out.schema[c].dataType), F.col(f"`{c}`")).alias(c) if c in named and c in imputed else (F.col(f"`_c{c}`").alias(c) if c in named else F.col(f"`{c}`")) for c in profile.columns])
    return out


def generate_sequences(
    spark: SparkSession, model: Model, parents: DataFrame | None = None, pk: str | None = None, n: int | None = None, preset: Synthetic | None = None,
    conditions: DataFrame | None = None, imputed: list[str] = (), trials: int | None = None, **given: object,
) -> DataFrame:
    """New rows per entity: a length drawn for each, then its steps.

    A column of a step is drawn given another one of the same step, itself in the step before, or a
    column of the parents, whichever says most about it (see paths). Entities are the parents, or n
    (100) numbered ones. conditions: rows of steps, by the model's key and order; what they hold is
    not drawn, but null cells of `imputed` columns are, and the other columns are drawn given it. An
    entity has at least as many steps as conditions, and with `trials` (see generate) just as many.
    """
    model._ready()
    if not model.key:
        raise InvalidRequestError("the model isn't sequential", "key")
    want = merged(preset, n=n, **given)
    seed = any_seed(want.seed if want.seed is not None else model.config.seed)
    rare = want.rare_strategy or model.config.privacy.rare_strategy
    weights = C.merged_weights(C.rare_weights(model.profile, rare), C.imputation_weights(model.profile, list(imputed)))
    keys = (model.key, "step")
    rows = parents.select(F.col(pk).alias(model.key)) if parents is not None else spark.range(want.n or model.config.n or 100).select(F.col("id").alias(model.key))
    fixed, order = [], model.columns
    if conditions is not None:
        named = [c for c in conditions.columns if c in model.profile.columns]
        codes = fixed_values(conditions.select(model.key, *model.order, *named), model.profile, tuple(imputed), (model.key, *model.order))
        fixed = [c for c in codes.columns if c in model.columns]
        order = [code_name(f, s) for f in C.column_order(list(model.profile.columns), named, [], list(imputed)) for s in model.profile.columns[f].subs]
        known = S.sequential_conditions(codes, model.key, list(model.order), fixed, rows, model.key)
        rows = known.select(model.key, *[F.col(f"`{c}`").alias(f"_f{c}") for c in fixed])
        many = conditions.groupBy(F.col(model.key).alias("_key")).agg(F.count("*").cast("int").alias("_many"))
        rows = rows.join(many, F.col(model.key) == F.col("_key"), "left").drop("_key").withColumn("_many", F.coalesce("_many", F.lit(0)))
    theirs = []
    if model.parents is not None:
        theirs = [f"parent:{c}" for c in model.parents.cardinalities]
        if parents is not None and set(model.parents.columns) <= set(parents.columns):
            own = encode_columns(parents, model.parents, (pk,)).withColumnsRenamed({c: f"parent:{c}" for c in model.parents.cardinalities}).withColumnRenamed(pk, "_pk")
            rows = rows.join(own, F.col(model.key) == F.col("_pk"), "left").drop("_pk")
        else:
            rows = rows.withColumns({c: F.lit(None).cast("int") for c in theirs})
    if trials is not None:
        rows, keys = rows.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1)))), (*keys, "trial")
        seed = F.lit(seed) + F.col("trial")
    sizes = model.lengths.select(F.lit(ANY).alias("by"), F.col("n").alias("code"), F.col("many").alias("n"))
    rows = drawn(rows, "_n", uniform(seed, F.lit("length"), model.key), sizes, Shape(), model.lengths.count())
    if conditions is not None:
        rows = rows.withColumn("_n", F.col("_many") if trials is not None else F.greatest("_n", "_many"))
    shapes = {c: Shape.of(weights.get(c, {}), want.diversity, want.rare_cutoff) for c in model.columns}
    cards = model.profile.cardinalities | {f"parent:{c}": n for c, n in (model.parents.cardinalities if model.parents else {}).items()}
    flat = P.paths(rows, model.key, [k for k in keys if k != "step"], model.steps, order, shapes, cards, seed, fixed, theirs)
    flat = flat.withColumn("row_id", F.concat_ws("|", F.col(model.key).cast("string"), "step"))
    return decode_columns(flat, model.profile, rare, seed, "row_id", keys)


def pick_cell(name: str | Callable[[Column], Column], values: Column) -> Column:
    """One value of many: the mode (ties to the smallest), mean or median, or what a callable makes of the array of them. Nulls don't count."""
    if callable(name):
        return name(F.array_sort(F.collect_list(values)))
    if name == "mode":
        return F.mode(values, True)
    if name == "mean":
        return F.avg(values)
    if name == "median":
        return F.median(values)
    raise InvalidRequestError(f"unknown pick {name!r}", "pick")


def impute(spark: SparkSession, model: Model, df: DataFrame, row_id: str = "row_id", trials: int = 1, pick: str | Callable[[Column], Column] = "mode", columns: list[str] | None = None, **given: object) -> DataFrame:
    """df with its null cells filled: `trials` draws per cell, of which `pick` takes one value; "all" gives one row per trial.

    A callable pick gets the sorted array of a cell's draws and returns a value. Of a sequential
    model, df's rows are steps of its entities, in the model's order.
    """
    if not isinstance(trials, int) or isinstance(trials, bool) or trials < 1:
        raise InvalidRequestError("trials must be 1 at least", "trials")
    if not callable(pick) and pick not in ("mode", "mean", "median", "all"):
        raise InvalidRequestError(f"unknown pick {pick!r}", "pick")
    names = [c for c in (columns or null_columns(df.drop(row_id))) if c in model.profile.columns]
    seed = any_seed(given.pop("seed", None))
    conditions = df.withColumnRenamed(row_id, "row_id")
    if model.key:
        made = _drawn_steps(spark, model, conditions, names, trials, seed, **given)
    else:
        made = generate(spark, model, conditions=conditions, imputed=names, seed=seed, trials=trials, **given).select("row_id", *names, "trial")
    if pick == "all":
        own = made.withColumnRenamed("row_id", "_id")
        met = conditions.join(own.select("_id", "trial", *[F.col(c).alias(f"_g{c}") for c in names]), conditions["row_id"] == F.col("_id"))
        return met.select("trial", *[F.coalesce(c, F.col(f"_g{c}").cast(df.schema[c].dataType)).alias(c) if c in names else F.col(c) for c in conditions.columns]).withColumnRenamed("row_id", row_id)
    best = made.groupBy("row_id").agg(*[pick_cell(pick if callable(pick) or pick == "mode" or isinstance(made.schema[c].dataType, _numbers()) else "mode", F.col(c)).alias(c) for c in names])
    return S.restored(conditions, best, ["row_id"], names).withColumnRenamed("row_id", row_id)


def _drawn_steps(spark: SparkSession, model: Model, rows: DataFrame, names: list[str], trials: int, seed: int, **given: object) -> DataFrame:
    """(row_id, names, trial): the steps of sequences drawn given what they hold, one for each row."""
    step = F.row_number().over(Window.partitionBy(model.key).orderBy(*model.order)) - 1
    placed = rows.withColumn("_step", step.cast("int"))
    made = generate_sequences(spark, model, rows.select(model.key).distinct(), model.key, conditions=rows, imputed=names, trials=trials, seed=seed, **given)
    own = placed.select("row_id", F.col(model.key).alias("_key"), "_step")
    return made.join(own, (F.col(model.key) == F.col("_key")) & (F.col("step") == F.col("_step"))).select("row_id", *names, "trial")


def _numbers() -> type:
    from pyspark.sql.types import NumericType

    return NumericType


def check_context(df: DataFrame, parent: DataFrame | None, parent_encoding_types: dict[str, str] | None = None, foreign_key: str | None = None, parent_key: str | None = None) -> str | None:
    """The parent's key for a foreign key: the given one, or the column of the same name. Raises if what is given doesn't fit together."""
    for name, value in (("parent_encoding_types", parent_encoding_types), ("parent_key", parent_key)):
        if value is not None and parent is None:
            raise InvalidRequestError(f"{name} needs a parent", name)
    if foreign_key is not None and foreign_key not in df.columns:
        raise InvalidRequestError(f"no column {foreign_key!r}", "foreign_key")
    if parent is None or foreign_key is None:
        return None
    if parent_key is None and foreign_key not in parent.columns:
        raise InvalidRequestError(f"the parent has no column {foreign_key!r}; name its key", "parent_key")
    if parent_key is not None and parent_key not in parent.columns:
        raise InvalidRequestError(f"the parent has no column {parent_key!r}", "parent_key")
    return parent_key or foreign_key


def with_context(df: DataFrame, parent: DataFrame, order: list[str], parent_order: list[str], foreign_key: str | None = None, parent_key: str | None = None) -> DataFrame:
    """df with the parent's columns as parent:<name>: of the row at the same place in the orders, or of the row with the foreign key."""
    pk = check_context(df, parent, None, foreign_key, parent_key)
    if foreign_key is None:
        renamed = parent.withColumnsRenamed({c: f"parent:{c}" for c in parent.columns})
        return S.zipped(df, renamed, order, [f"parent:{c}" for c in parent_order])
    own = parent.withColumnsRenamed({c: f"parent:{c}" for c in parent.columns if c != pk})
    return S.with_parent(df, foreign_key, own, pk, [f"parent:{c}" for c in parent.columns if c != pk])


def generate_with_context(spark: SparkSession, model: Model, parent: DataFrame, row_id: str, **given: object) -> DataFrame:
    """New rows of a model of with_context() rows, one for each row of the parent (row_id from 0, and its columns): child columns drawn given the parent's."""
    known = parent.select(F.col(row_id).alias("row_id"), *[F.col(f"`{c}`").alias(f"parent:{c}") for c in parent.columns if c != row_id])
    return generate(spark, model, conditions=known, **given).drop(*[c for c in known.columns if c != "row_id"])


def synthesize(spark: SparkSession, df: DataFrame, n: int | None = None, config: ModelConfig | dict | None = None, preset: Synthetic | None = None, **given: object) -> DataFrame:
    """Fit a model of df and generate rows from it; the scalars are checked before any work starts."""
    check_scalars(n, given.get("seed"), given.get("diversity", 1.0), given.get("rare_cutoff", 1.0), given.get("rare_strategy"))
    merged(preset, n=n)
    return generate(spark, fit(df, config), n, preset, **given)
