import random

from pyspark.sql import functions as F

from strataloom.llm import lines


def brute(rows, percent=80):
    """Kept lines of (doc_id, text) rows, in the order of doc_id, each pair of lines compared."""
    seen, out = [], {}
    for i, text in sorted(rows):
        kept = []
        for x in text.split("\n"):
            own = frozenset(x.lower().split())
            hit = bool(own) and any(len(own & o) * 100 >= len(own | o) * percent for o in seen)
            if own:
                seen.append(own)
            if not hit:
                kept.append(x)
        out[i] = "\n".join(kept)
    return out


def made(n=120, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    pool = [" ".join(rng.choices(words, k=rng.randint(1, 25))) for _ in range(60)]
    rows = []
    for i in range(n):
        own = []
        for _ in range(rng.randint(0, 6)):
            x = rng.choice(pool).split()
            for _ in range(rng.randint(0, 2)):
                x[rng.randrange(len(x))] = rng.choice(words).upper()
            own.append(" ".join(x))
        rows.append((i, "\n".join(own)))
    return rows


def test_matches_brute_force(spark):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_lines - r.n_removed == len(want[i].split("\n")) or not want[i] for i, r in got.items())


def test_frequent_words_are_dealt_out(spark, monkeypatch):
    rows = made(80, 2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, lines.later_matches(df).collect()))
    monkeypatch.setattr(lines, "FREQUENT", 1)
    monkeypatch.setattr(lines, "TURNS", 2)
    parts = sorted(map(tuple, lines.later_matches(df).collect()))
    assert whole == parts and len(whole) == sum(len(t.split("\n")) for _, t in rows if t) - sum(len(t.split("\n")) for t in brute(rows).values() if t)


def test_long_lines_and_near_copies_of_one_line(spark):
    """Lines of 60 to 120 words on both sides of SHORT, and a group of near copies that don't all match its first line."""
    rng = random.Random(4)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(90):
        x = base[: rng.choice((60, 75, 79, 80, 85, 120))]
        for _ in range(rng.randint(0, 9)):
            x[rng.randrange(len(x))] = f"u{rng.randrange(40)}"
        rng.shuffle(x)
        rows.append((i, " ".join(x)))
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and 0 < sum(v == "" for v in got.values()) < 90


def test_clashing_names(spark):
    rows = [(1, "a b c", 7, 8, 9), (2, "a b c\nx", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, marked int, gone int").withColumnsRenamed({"row": "_hash"}).withColumns({"row": F.lit(1), "b": F.lit(2), "th": F.lit(3), "lines": F.lit(4), "bits": F.lit(5), "bucket": F.lit(6), "id": F.lit(7), "n_lines": F.lit(8), "whole": F.lit(9)})
    got = {r.doc_id: r for r in lines.drop_repeated_lines(df).collect()}
    assert got[2].text == "x" and got[1].asDict() == {**df.where("doc_id = 1").first().asDict()} and got[2].n_lines == 8
    assert lines.dedup_lines(df).where("doc_id = 2").first().n_lines == 2


def test_edge_rows(spark):
    rows = [(1, "a b c\n\na b c", 1), (2, None, 2), (None, "a b c\nx y", 3), (3, "", 4), (4, "Q r s t u", 5), (4, "q r s t u", 6), (5, "long words " * 30_000 + "\na b c", 7), (6, "only one", 8), (6, "only one", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "", r.n_removed) for r in lines.dedup_lines(df).collect()))
    texts = [(g[1], g[3][:12], g[4]) for g in got]
    assert (1, "a b c\n", 1) in texts and (0, "x y", 1) in texts
    assert texts.count((6, "only one", 0)) == 2 and sum(t[2] for t in texts if t[0] == 4) == 1
    assert len(got) == len(rows) and lines.dedup_lines(df.where("false")).count() == 0
    left = lines.drop_repeated_lines(spark.createDataFrame([(1, "a b c", 5), (2, "a b c", 5), (3, "", 0), (4, "a b c\nz", 7)], "doc_id long, text string, n_chars long"))
    assert sorted(map(tuple, left.collect())) == [(1, "a b c", 5), (3, "", 0), (4, "z", 1)]


def test_near_copies_meet_other_sets_than_the_earliest(spark, monkeypatch):
    """1,000 near copies of one line: few are left for the join with all sets before, which gave 12,895 rows when sets met the earliest only."""
    rng = random.Random(8)
    rows = []
    for i in range(1000):
        x = [f"v{j}" for j in range(60)]
        for _ in range(rng.randint(1, 5)):
            x[rng.randrange(len(x))] = f"u{rng.randrange(200)}"
        rows.append((i, " ".join(x)))
    made, candidates = [], lines.all_candidates

    def counted(*args):
        out = candidates(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(lines, "all_candidates", counted)
    later = lines.later_matches(spark.createDataFrame(rows, "doc_id long, text string"))
    assert later.count() == sum(t == "" for t in brute(rows).values()) and sum(made) < 3000


def test_bits_of_the_table_of_marks_follow_its_keys(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text")
    some = lines.stored(docs.where("doc_id % 100 = 0").select(F.xxhash64("text").alias("th")), "some")
    rows = lines.marked(docs, F.xxhash64("text"), some)
    assert rows.where("marked and row.doc_id % 100 = 0").count() == 30 and rows.where("marked").count() < 300
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert str(lines.MARKS) not in plan and str(1 << 15) in plan
