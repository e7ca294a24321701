import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import mixing


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by capping and resharing until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            target |= {s: level * w[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_capping(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(rng.integers(0, 10 ** rng.integers(1, 5))) for i in range(9)} | {None: 777, "Z": 5, "é": 50}
    rows = [("" if s is None else "=" + s, n) for s, n in sizes.items()]
    got = {r.key: r.target for r in mixing.targets(spark.createDataFrame(rows, "key string, source_size long")).collect()}
    for s, t in filled(sizes).items():
        assert got["" if s is None else "=" + s] == pytest.approx(t, rel=1e-9, abs=1e-6)


def docs(spark, n=400):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), "hot" if i % 3 == 0 else f"s{i % 7}", i) for i in range(n)]
    return spark.createDataFrame(rows + [(None, "a b", None, 1), (3, None, "s1", 2), (5, "", "s1", 2), (9, "x y", "s2", 1), (9, "x y", "s2", 1), (10_000, "long " * 30_000, "s4", 1)], "doc_id long, text string, source string, size int")


def test_mix_meets_targets_and_reruns_agree(spark):
    got = mixing.mix(docs(spark))
    rows = got.collect()
    assert len(rows) == docs(spark).count()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.copies <= 2
        t = by.setdefault(r.source, [0, 0, r.target])
        t[0] += r.taken
        t[1] += r["size"]
    for s, (taken, size, target) in by.items():
        assert target == pytest.approx(filled({k: v[1] for k, v in by.items()})[s], rel=1e-9)
        assert abs(taken - target) <= 64 + 0.002 * target, s
    again = mixing.mix(docs(spark).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_slots_are_low_discrepancy(spark):
    shares = spark.createDataFrame([("=a", 10, 1.0, 50.0), ("=b", 10, 1.0, 30.0), ("=c", 10, 1.0, 20.0)], "key string, source_size long, weight double, target double")
    rows = mixing.schedule(shares, 3000).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(3000))
    n = {"=a": 0, "=b": 0, "=c": 0}
    for i, r in enumerate(rows, 1):
        assert r["rank"] == n[r.key]
        n[r.key] += 1
        for k, share in (("=a", 0.5), ("=b", 0.3), ("=c", 0.2)):
            assert abs(n[k] - i * share) < 4


def test_empty_table_and_no_words(spark):
    assert mixing.mix(docs(spark).where("false")).count() == 0
    got = mixing.mix(docs(spark).withColumn("text", F.lit(" "))).agg(F.sum("taken"), F.count("*")).first()
    assert got[0] == 0 and got[1] == 406


def test_small_sources_beside_huge_ones_meet_their_targets(spark):
    """At 79 million words, about 0.5 GB, and at 4.7 billion, about 30 GB."""
    for words in (79_000_000, 4_700_000_000):
        sizes = {f"=big{i:02}": words // 20 for i in range(20)} | {f"={c}{n}": n for n in (50, 200, 1000, 10_000, 100_000) for c in "amz"}
        shares = mixing.blocks(mixing.targets(spark.createDataFrame(list(sizes.items()), "key string, source_size long")), 16)
        for r in shares.join(mixing.slots_of(shares), "key", "left").collect():
            assert abs((r.slots or 0) * r.block - r.target) <= 8 * r.block + 0.002 * r.target, r


def test_documents_of_small_sources_are_taken(spark):
    huge = spark.range(40).selectExpr("id as doc_id", "repeat('w ', 500000) as text", "'huge' as source")
    small = spark.createDataFrame([(1000 + 100 * k + i, "w " * (n // 10), f"s{n}") for k, n in enumerate((50, 200, 1000)) for i in range(10)], "doc_id long, text string, source string")
    by = {r.source: r for r in mixing.mix(huge.union(small)).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.min("copies").alias("copies")).collect()}
    for n in (50, 200, 1000):
        assert by[f"s{n}"].target == 2 * n and by[f"s{n}"].taken >= 0.9 * by[f"s{n}"].target and by[f"s{n}"].copies >= 1
    kept = {r.source for r in mixing.take(huge.union(small)).select("source").distinct().collect()}
    assert kept == {"huge", "s50", "s200", "s1000"}


def test_take_agrees_with_the_schedule(spark):
    """Every copy by brute force: slots by the golden ratio, blocks of words of each source, and the order of the rows."""
    rows = [(i, "w " * (3 + i % 50), f"s{i % 3}", i, i, i) for i in range(120)] + [(7, "w " * 10, "s1", 7, 7, 7)] * 2 + [(7, "v " * 10, "s1", 7, 7, 7), (8, None, "s1", 1, 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int, slot int, h1 int")
    plan = mixing.mix(df).collect()
    out = mixing.take(df)
    got = out.collect()
    assert out.columns == df.columns and len(got) == sum(r.copies for r in plan)
    for key in {(r.doc_id, r.source) for r in plan}:
        assert sum((r.doc_id, r.source) == key for r in got) == sum(r.copies for r in plan if (r.doc_id, r.source) == key)
    per = {}
    for r in plan:
        per[r.source] = r.target
    names, total = sorted(per), sum(per.values())
    starts = [i for i in range(len(got)) if got[i].source == "s0"]
    # the sources alternate: no long run of one of them beyond what its share explains
    for s in names:
        share = sum(r.source == s for r in got) / len(got)
        for i in range(1, len(got)):
            assert abs(sum(r.source == s for r in got[:i]) - share * i) < 12
    assert starts and total > 0 and mixing.take(df.where("false")).count() == 0


def test_query_agrees_with_sql_where_many_slots_are_needed(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    plain = lambda df: sorted(df[sorted(df.columns)].round(6).astype(str).agg("|".join, axis=1))
    assert plain(mixing.op9_mixing(spark, "/root/testdata/sf0.01").toPandas()) == plain(con.sql(mixing.ORACLES["op9_mixing"]).df())
