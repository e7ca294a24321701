import pytest
from pyspark.sql import functions as F

from strataloom import Bias, Distribution, InvalidRequestError, NotReadyError, Privacy, Synthetic, Table, fit, generate, generate_sequences, impute, synthesize
from strataloom.config import ModelConfig, merged, resolve_config
from strataloom.functions import values as V
from strataloom.operators import constraints as C
from strataloom.operators import decode as D
from strataloom.operators import draws
from strataloom.operators import encode as E
from strataloom.operators import profile as P
from strataloom.operators import ranks
from strataloom.operators import sampler as M
from strataloom.operators import sequences as S
from strataloom.operators import tables as T
from strataloom.operators.embedding import project
from strataloom.sources import files
from strataloom.sources.files import read_profile, read_table, write_profile, write_table
from strataloom.streaming.codes import encode_stream

PINNED = Privacy(threshold=5)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, "ABC"[i % 3] if i % 17 else None, 20 + i % 40, float(i % 50) / 4 - 3, f"ID{i % 90:03d}") for i in range(300)]
    return spark.createDataFrame(rows, "row_id long, city string, age int, score double, code string").withColumn("seen", F.timestamp_seconds(F.lit(1_600_000_000) + F.col("row_id") * 90_061))


def test_round_trip_of_all_encodings(people):
    for kinds in ({"score": "numeric_digit", "age": "numeric_discrete", "code": "character", "city": "categorical"}, {"score": "numeric_binned", "age": "numeric_binned"}):
        p = P.profile_table(people.drop("row_id"), kinds, Privacy(threshold=1))
        back = D.decode_columns(E.encode_columns(people, p, ("row_id",)), p, "mask", 1, "row_id", ("row_id",))
        met = people.join(back.toDF("row_id", "b_city", "b_age", "b_score", "b_code", "b_seen"), "row_id")
        assert met.where("not city <=> b_city").count() == 0 and met.where("code <> b_code").count() == 0
        assert met.where(F.abs(F.col("score") - F.col("b_score")) > (1e-9 if kinds["score"] == "numeric_digit" else 1.0)).count() == 0
        assert met.where("abs(age - b_age) > 1").count() == 0 and met.where("abs(unix_seconds(seen) - unix_seconds(b_seen)) > 0").count() == 0


def test_rare_values_are_protected(spark):
    df = spark.createDataFrame([(c,) for c in "ABCD" for _ in range(50)] + [("Z_rare",)] * 2, "cat string")
    p = P.profile_table(df, privacy=PINNED)
    assert "Z_rare" not in p.columns["cat"].labels and p.columns["cat"].rare == 1 and p.columns["cat"].labels[0] == V.RARE
    assert "Z_rare" in P.profile_table(df, privacy=Privacy(protect_rare=False)).columns["cat"].labels
    assert {P.threshold(Privacy(threshold=None), s, "cat") for s in range(40)} == {5, 6, 7}


def test_a_profile_reads_its_table_three_times_at_most(spark):
    rows = spark.createDataFrame([(i, float(i % 97), f"w{i % 110}", str(i % 7), f"0{1 + i % 9}/12/2020", i * 0.5) for i in range(400)], "a long, b double, c string, d string, created string, e double")
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    counted = rows.mapInArrow(seen, rows.schema)
    p = P.profile_table(counted, {"e": "numeric_digit", "a": "numeric_auto"}, PINNED)
    assert set(p.columns) == set(rows.columns) and read.value <= 3 * 400
    read.value = 0
    P.profile_table(counted, {c: e for c, e in zip(rows.columns, ("numeric_binned", "numeric_discrete", "categorical", "character", "datetime", "numeric_digit"), strict=True)}, Privacy(epsilon=9.0), 3)
    assert read.value <= 2 * 400
    assert P.profile_table(rows.select(), privacy=PINNED).columns == {}


def test_a_threshold_beyond_the_values_leaves_no_bounds(spark):
    few = P.profile_table(spark.createDataFrame([(float(i),) for i in range(30)], "x double"), {"x": "numeric_binned"}, Privacy(threshold=30)).columns["x"]
    assert few.bounds is None and few.edges == [0.0]


def test_fewer_than_twenty_values_have_no_bounds(spark):
    p = P.profile_table(spark.createDataFrame([(float(i),) for i in range(19)], "x double"), {"x": "numeric_binned"}, PINNED)
    assert p.columns["x"].bounds is None and p.columns["x"].edges == [0.0]
    codes = E.encode_columns(spark.createDataFrame([(3.0,), (None,)], "x double"), p)
    assert {r[0] for r in codes.collect()} == {0}


def test_config_checks():
    for bad in (lambda: Synthetic(n=0), lambda: Synthetic(n=True), lambda: Synthetic(diversity=0), lambda: Synthetic(rare_cutoff=1.5), lambda: Bias("a", ("a",)), lambda: Distribution("a", {"x": -1}), lambda: Distribution("a", {}), lambda: Privacy(threshold=0), lambda: ModelConfig(encoding_types={"a": "zip"}), lambda: resolve_config({"nope": 1})):
        with pytest.raises(InvalidRequestError):
            bad()
    assert merged(Synthetic(n=5, seed=1), seed=2) == Synthetic(n=5, seed=2)
    with pytest.raises(InvalidRequestError):
        merged(Synthetic(n=5), n=6)


def test_column_orders():
    f = list("abcdef")
    assert C.column_order(f, ["c"], ["e"]) == ["c", "e", "a", "b", "d", "f"]
    assert C.column_order(f, ["c", "d"], ["e"], ["c"]) == ["d", "e", "a", "b", "f", "c"]
    assert C.column_order(f, ["c"], [], ["d"], Bias("a", ("b", "d"))) == ["c", "b", "d", "e", "f", "a"]


def test_generation_depends_on_the_seed_only(spark, people):
    model = fit(people.drop("row_id"), {"privacy": PINNED})
    a, b, c = (sorted(map(str, generate(spark, model, 200, seed=s).collect())) for s in (1, 1, 2))
    assert a == b != c and len(a) == 200
    model.close()
    with pytest.raises(NotReadyError):
        generate(spark, model, 5)


def test_conditions_come_back_and_wishes_hold(spark, people):
    model = fit(people.select("city", "age"), {"privacy": PINNED})
    want = spark.createDataFrame([(i, "B", None if i % 2 else 25) for i in range(50)], "row_id long, city string, age int")
    got = generate(spark, model, conditions=want, imputed=["age"], seed=3).collect()
    assert {r.city for r in got} == {"B"} and all(r.age == 25 for r in got if r.row_id % 2 == 0) and all(r.age is not None for r in got)
    only = generate(spark, model, 100, distribution=Distribution("city", {"A": 1.0}), seed=1)
    assert [r.city for r in only.select("city").distinct().collect()] == ["A"]
    with pytest.raises(InvalidRequestError):
        generate(spark, model, 5, distribution=Distribution("nope", {"A": 1.0}))


def test_imputation_keeps_what_is_there(spark, people):
    model = fit(people.select("city", "age"), {"privacy": PINNED})
    for pick in ("mode", "mean", "median"):
        out = impute(spark, model, people.select("row_id", "city", "age"), trials=2, pick=pick, seed=1)
        met = out.join(people.select("row_id", F.col("city").alias("was")), "row_id")
        assert met.where("city is null").count() == 0 and met.where("was is not null and was <> city").count() == 0
    assert impute(spark, model, people.select("row_id", "city", "age"), trials=2, pick="all", seed=1).count() == 600
    with pytest.raises(InvalidRequestError):
        impute(spark, model, people, trials=0)


def test_sequences(spark):
    rows = [(a, t, "credit" if (a + t) % 3 else "debit", float(t * 10)) for a in range(30) for t in range(1 + a % 4)]
    df = spark.createDataFrame(rows, "account long, t int, kind string, amount double")
    parents = spark.range(35).withColumnRenamed("id", "pk")
    model = fit(df, {"privacy": PINNED}, "account", ["t"], parents, "pk")
    got = generate_sequences(spark, model, parents, "pk", seed=2).collect()
    lengths = {}
    for r in got:
        lengths[r.account] = lengths.get(r.account, 0) + 1
        assert r.kind in ("credit", "debit")
    assert lengths and max(lengths.values()) <= 4 and set(lengths) <= set(range(35))


def test_positions_of_known_sequences(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 1, 6.0), (1, 2, 7.0), (2, 0, 1.0), (2, 1, 2.0)], "a long, t int, x double")
    got = [tuple(r) for r in S.positions(df, "a", ["t"], ["x"]).orderBy("a", "sidx").collect()]
    assert got == [(1, 0, 3, 3, 5.0), (1, 1, 3, 2, 6.0), (1, 2, 3, 1, 7.0), (1, 3, 3, 0, 0.0), (2, 0, 2, 2, 1.0), (2, 1, 2, 1, 2.0), (2, 2, 2, 0, 0.0)]
    back = S.lists(S.positions(df, "a", ["t"], ["x"]), "a", ["sidx"], ["ridx", "x"])
    flat = S.flattened(back, "a", S.lengths(F.col("ridx")), ["x"]).orderBy("a", "step").collect()
    assert [r.x for r in flat] == [5.0, 6.0, 7.0, 1.0, 2.0]


def test_table_rules(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    for bad in (lambda: Table(df, "z"), lambda: Table(df, "a", {"a": "x"}), lambda: Table(df, "a", {"z": "x"}), lambda: Table(df, sequential=True), lambda: Table(df, None, {"a": "x", "b": "y"}, True, order=("c",)), lambda: Table(df, pk_type="no")):
        with pytest.raises(InvalidRequestError):
            bad()
    good = {"c": Table(df, "c", {"a": "a", "b": "b"}), "b": Table(df, "b", {"a": "a"}), "a": Table(df, "a")}
    assert T.check_tables(good) == ["a", "b", "c"]
    with pytest.raises(InvalidRequestError):
        T.check_tables({"a": Table(df, "a", {"b": "b"}), "b": Table(df, "b", {"a": "a"})})
    with pytest.raises(InvalidRequestError):
        T.check_tables({"a": Table(df, "a", {"b": "nope"})})


def test_orphans_are_dealt_in_turn(spark):
    child = spark.createDataFrame([(0, 1), (1, 999), (2, 888), (3, None)], "i long, fk long")
    got = T.remap_orphans(child, "fk", ["i"], spark.createDataFrame([(1,), (2,)], "pk long"), "pk").orderBy("i").collect()
    assert [r.fk for r in got] == [1, 1, 2, 1]


def test_keys(spark):
    df = spark.range(100).select(F.col("id").alias("row_id"), F.lit(1).alias("x"))
    assert [r.k for r in T.assign_key(df, "k", "int").orderBy("k").collect()] == list(range(1, 101))
    a, b = ([r.k for r in T.assign_key(df, "k", "dxid", seed=s).orderBy("k").collect()] for s in (1, 1))
    assert a == b and len(set(a)) == 100 and all(len(k) == 27 for k in a)
    assert T.assign_key(df, "k", "uuid").select("k").distinct().count() == 100 and T.assign_key(df, "k", "int").columns == ["k", "x"]


def test_embedding_files_and_streams(spark, people, tmp_path):
    p = P.profile_table(people.drop("row_id"), privacy=PINNED)
    codes = E.encode_columns(people, p, ("row_id",))
    a, b = (project(codes, p, 8, 1, noise=n).orderBy("row_id").collect() for n in (0.0, 0.1))
    assert all(len(r.embedding) == 8 for r in a) and a != b
    write_profile(spark, p, f"{tmp_path}/profile")
    assert read_profile(spark, f"{tmp_path}/profile") == p
    for fmt in ("parquet", "orc", "json", "csv"):
        write_table(people, f"{tmp_path}/{fmt}", fmt)
        assert read_table(spark, f"{tmp_path}/{fmt}", fmt, "row_id long, city string, age int, score double, code string, seen timestamp").count() == 300
    with pytest.raises(InvalidRequestError):
        read_table(spark, "x", "csv")
    stream = spark.readStream.schema(people.schema).parquet(f"{tmp_path}/parquet")
    q = encode_stream(stream, p, ("row_id",)).writeStream.format("memory").queryName("codes").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("codes").collect())) == sorted(map(str, codes.collect()))


def test_private_statistics(spark):
    df = spark.range(2000).select((F.col("id") % 100).cast("double").alias("x"), F.when(F.col("id") < 3, "few").otherwise("many").alias("c"))
    lo, hi = P.dp_bounds(df, F.col("x"), 2.0, 1)
    assert lo <= 0 and hi == 128.0
    assert [r.value for r in P.dp_counts(P.category_counts(df, F.col("c")), 5.0, 3).collect()] == ["many"]
    assert synthesize(spark, df, 20, {"privacy": Privacy(epsilon=5.0)}, seed=1).count() == 20


def test_ranks_do_not_gather_in_one_range(spark):
    """One outlier, a common prefix and many ties: no range holds more than a few times its share, and the sums are right."""
    rows = [(i, float(i) if i else 1e12, f"Customer#{i:06}", i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, x double, name string, tie int").repartition(7)
    for order, key in ((["x"], lambda r: r[1]), (["name"], lambda r: r[2]), (["tie", "id"], lambda r: (r[3], r[0]))):
        sizes = [r["count"] for r in ranks.in_ranges(df, order, 16).groupBy("_range").count().collect()]
        assert len(sizes) == 16 and max(sizes) < 4 * 4000 / 16
        got, total = ranks.ranked(df, order, F.lit(1), "before", 16)
        assert {r.id: r.before for r in got.collect()} == {r[0]: k for k, r in enumerate(sorted(rows, key=key))} and total == 4000
        got, total = ranks.ranked(df, order, F.col("id") / 2, "before", 5)
        halves = [r[0] / 2 for r in sorted(rows, key=key)]
        assert {r.id: r.before for r in got.collect()} == {r[0]: sum(halves[:k]) for k, r in enumerate(sorted(rows, key=key))} and total == sum(halves)
    nulls = spark.createDataFrame([(None, 1), (2, 2), (None, 3), (1, 4)], "x int, id int")
    assert {r.id: r.at for r in ranks.cumulated(nulls, ["x", "id"], F.lit(1), "at").collect()} == {1: 0, 3: 1, 4: 2, 2: 3}


def test_split_takes_the_smallest_hashes(spark):
    df = spark.range(1000)
    got = S.train_split(df, ["id"], 0.1, 3).withColumn("h", F.xxhash64(F.lit(3), "id")).collect()
    assert {r.id for r in got if r.part == "val"} == {r.id for r in sorted(got, key=lambda r: r.h)[:100]}
    assert S.train_split(df.where("id < 1"), ["id"], 0.1).first().part == "train"


def test_fill_takes_values_as_often_as_they_stand(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 8 == 0, "a").otherwise("b")).alias("x"))
    made = {r.x: r["count"] for r in E.fill_missing(df, "x", "id", 4).where("id % 2 = 1").groupBy("x").count().collect()}
    assert abs(made["a"] / 3000 - 0.25) < 0.04 and set(made) == {"a", "b"}
    none = E.fill_missing(df.withColumn("x", F.lit(None).cast("string")), "x", "id", 4)
    assert none.where("x is null").count() == 6000


def test_sequences_follow_conditions_and_parents(spark):
    parents = spark.range(60).select("id", F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"))
    rows = parents.select("id", "kind", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("at")).select("id", "at", F.when(F.col("at") > 1, "x").when(F.col("kind") == "even", "e").otherwise("o").alias("c"))
    model = M.fit(rows, {"privacy": {"threshold": 1}}, "id", ["at"], parents, "id", ["kind"])
    first = {(r.id % 2, r.c) for r in M.generate_sequences(spark, model, parents, "id", seed=3).where("step = 0").collect()}
    assert first == {(0, "e"), (1, "o")}
    holed = rows.withColumn("c", F.when(F.col("at") != 2, F.col("c"))).withColumn("row_id", F.concat_ws("-", "id", "at"))
    filled = M.impute(spark, model, holed, trials=2, seed=1).collect()
    was = {(r.id, r["at"]): r.c for r in rows.collect()}
    assert len(filled) == 240 and all(r.c == was[r.id, r["at"]] for r in filled)


def test_a_pick_may_be_a_callable(spark):
    rows = spark.createDataFrame([(i, "abc"[i % 3] if i < 30 else None) for i in range(40)], "row_id int, c string")
    model = M.fit(rows.select("c").where("c is not null"), {"privacy": {"threshold": 1}})
    every = M.impute(spark, model, rows, trials=4, pick="all", seed=5).where("row_id >= 30").groupBy("row_id").agg(F.max("c").alias("c")).collect()
    got = {r.row_id: r.c for r in M.impute(spark, model, rows, trials=4, pick=F.array_max, seed=5).collect()}
    assert {r.row_id: r.c for r in every} == {i: c for i, c in got.items() if i >= 30}


def test_context_is_checked(spark):
    child, parent = spark.createDataFrame([(1, 2)], "fk int, x int"), spark.createDataFrame([(1, 2)], "pk int, y int")
    assert M.check_context(child, parent, None, "fk", "pk") == "pk" and M.check_context(child, None) is None
    for given in ((None, {"y": "categorical"}, None, None), (None, None, None, "pk"), (parent, None, "no", None), (parent, None, "fk", None), (parent, None, "fk", "no")):
        with pytest.raises(InvalidRequestError):
            M.check_context(child, *given)


def test_positions_and_embeddings_as_codes(spark):
    df = spark.createDataFrame([(7,), (123,)], "p int")
    assert [tuple(r) for r in df.select(*[c.alias(k) for k, c in S.positional(F.col("p"), 250, "s").items()]).collect()] == [(0, 0, 7), (1, 2, 3)]
    assert [*S.positional(F.col("p"), 99, "s")] == ["scat"]
    v = spark.createDataFrame([([0.5, -1.25, 3.0],), (None,)], "v array<float>")
    assert [r.b for r in v.select(files.embedding_from_base64(files.embedding_to_base64(F.col("v"))).alias("b")).collect()] == [[0.5, -1.25, 3.0], None]


def test_weights_come_back_from_files(spark, people, tmp_path):
    from strataloom.operators.embedding import weights

    p = P.profile_table(people.select("city", "age"), privacy=Privacy(threshold=1))
    codes, w = E.encode_columns(people, p, ("row_id",)), weights(p, 8, 3)
    files.write_weights(spark, w, str(tmp_path / "w"))
    back = files.read_weights(spark, str(tmp_path / "w"))
    assert set(back) == set(w) and all((back[k] == w[k]).all() for k in w)
    assert project(codes, p, 8, 3).collect() == project(codes, p, 8, given=back).collect()


def test_settings_by_table_are_checked(spark):
    tables = {"a": Table(spark.range(3), "id")}
    for name, value in (("presets", {"b": Synthetic()}), ("presets", {"a": 1}), ("diversity", {"a": 0}), ("rare_cutoff", {"a": 1.5}), ("diversity", {"b": 1})):
        with pytest.raises(InvalidRequestError):
            T.synthesize_tables(spark, tables, **{name: value})


def test_types_are_exact_near_the_limits(spark):
    df = spark.range(4000).select(*[(F.col("id") % n).alias(f"i{n}") for n in (100, 101, 140)], *[(F.col("id") % n).cast("double").alias(f"d{n}") for n in (20, 21)], *[F.concat(F.lit("v"), F.col("id") % n).alias(f"s{n}") for n in (100, 101)])
    assert P.infer_types(df) == {"i100": "numeric_discrete", "i101": "numeric_binned", "i140": "numeric_binned", "d20": "categorical", "d21": "numeric_binned", "s100": "categorical", "s101": "character"}


def test_categories_that_a_profile_keeps_in_tables(spark, people, monkeypatch, tmp_path):
    """Columns with more categories than the driver may hold give what they give otherwise."""
    kinds = {"city": "categorical", "age": "numeric_discrete", "code": "categorical"}
    rows = people.select("city", "age", "code", "row_id")
    rows = rows.union(spark.createDataFrame([("once", None, None, 300)], rows.schema))
    held = P.profile_table(rows.drop("row_id"), kinds, Privacy(threshold=2))
    monkeypatch.setattr(P, "MAX_CATEGORIES", 5)
    kept = P.profile_table(rows.drop("row_id"), kinds, Privacy(threshold=2))
    write_profile(spark, kept, f"{tmp_path}/profile")
    for p in (kept, read_profile(spark, f"{tmp_path}/profile")):
        assert p.columns["city"] == held.columns["city"] and p.cardinalities == held.cardinalities
        for name in ("age", "code"):
            own, other = p.columns[name], held.columns[name]
            assert own.labels == other.labels[:2] and own.n_labels == len(other.labels) and own.rare == other.rare
            assert sorted((r.code, r.value) for r in own.table.collect()) == list(enumerate(other.labels))[2:]
    assert C.distribution_weights(kept, [Distribution("code", {"ID007": 0.5})]) == C.distribution_weights(held, [Distribution("code", {"ID007": 0.5})])
    assert C.rare_weights(kept, "mask") == C.rare_weights(held, "mask") and C.imputation_weights(kept, list(kinds)) == C.imputation_weights(held, list(kinds))


def test_rows_of_categories_in_tables(spark, people, monkeypatch):
    """Codes, decoded values and new rows of long vocabularies, and shares of long groups, are those of short ones."""
    kinds = {"city": "categorical", "age": "numeric_discrete", "code": "categorical"}
    config = {"privacy": Privacy(threshold=2), "encoding_types": kinds, "seed": 4}
    rows = people.select("row_id", *kinds)

    def made():
        model = fit(rows.drop("row_id"), config)
        codes = E.encode_columns(rows, model.profile, ("row_id",))
        back = D.decode_columns(codes, model.profile, keep=("row_id",))
        new = [generate(spark, model, 200, seed=5, **own) for own in ({}, {"distribution": Distribution("code", {"ID007": 0.5})}, {"rare_cutoff": 0.6})]
        return [sorted(map(str, df.collect())) for df in (codes, back, *new)]

    want = made()
    monkeypatch.setattr(P, "MAX_CATEGORIES", 5)
    monkeypatch.setattr(draws, "LONG", 5)
    monkeypatch.setattr(draws, "SHORT", 5)
    assert made() == want
