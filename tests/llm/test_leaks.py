import random
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataloom.llm import leaks

SHORT = {"PIECE": 7, "SHARD": 40, "KEPT": 3, "READ": 24, "HELD": 300, "ROWS": 9, "PLACES": 5}


def words(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [(m.group(), m.start(), m.end()) for m in re.finditer(leaks.TOKEN, text)]


def brute(text, items, window):
    """n_words, spans and items of one text."""
    own = [w for w, _, _ in words(text)]
    hit, found = set(), set()
    for name, said in items:
        w = [x for x, _, _ in words(said)]
        for at in range(max(1, len(w) - window + 1) if w else 0):
            p = w[at : at + window]
            for i in range(len(own) - len(p) + 1):
                if own[i : i + len(p)] == p:
                    hit |= set(range(i, i + len(p)))
                    found.add("null" if name is None else str(name))
    spans = []
    for i in sorted(hit):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return len(own), [(a, b, words(text)[a][1], words(text)[b - 1][2]) for a, b in spans], sorted(found)


def texts(rng, n, most):
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(["a", "B", "a", "ÿ", "Z9", "z9", "語", "x" * 30, "q"]) + rng.choice([" ", "  ", "\n", "-", "_", "{", "\x00", "'"]) for _ in range(rng.randrange(most))))
    return out


def asked(phrases, docs):
    """The task's work without Spark, batch by batch."""
    out = []
    batches = [pa.RecordBatch.from_arrays([pa.array([{"id": i} for i, _ in part]), pa.array([t for _, t in part], pa.string()), pa.nulls(len(part), pa.list_(leaks._SPAN)), pa.nulls(len(part), pa.list_(pa.string()))], ["row", "text", "spans", "items"]) for k in range(0, len(docs), 13) for part in [list(enumerate(docs))[k : k + 13]]]
    for b in leaks._search(SimpleNamespace(value=phrases))(iter(batches)):
        out += b.to_pylist()
    return [(r["n_words"], [(s["word"], s["word_end"], s["char"], s["char_end"]) for s in r["spans"]], r["items"]) for r in sorted(out, key=lambda r: r["row"]["id"])]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_task_against_brute_force(spark, monkeypatch, seed, small):
    for k, v in SHORT.items() if small else ():
        monkeypatch.setattr(leaks, k, v)
    rng = random.Random(seed)
    items = [(i // 2, t) for i, t in enumerate(texts(rng, 12, 9) + ["", None, "a a a a a a a a", "never said"][: 4 if seed else 3])]
    docs = texts(rng, 40, 60) + [None, "", " ", "a " * 300, "a b " * 150, "x" * 100, "é" * 60 + " a"]
    window = 4
    found = leaks.phrases_of(spark.createDataFrame(items, "item_id long, text string"), window)
    assert asked(next(found), docs) == [brute(t, items, window) for t in docs]


def test_index_finds_all_places():
    rng = np.random.default_rng(2)
    for known in (1, 2, 5, 300):
        sizes = rng.integers(1, 40, 30)
        text = rng.integers(0, known, int(sizes.sum())) * 3
        starts = np.cumsum(sizes) - sizes
        index = leaks.Index(text, starts, sizes)
        for m in (1, 2, 5, 10):
            p = np.full((20, 12), -1)
            p[:, :m] = [text[s : s + m] if s + m <= len(text) else [1] * m for s in rng.integers(0, len(text), 20)]
            low, high = index.ranges(p, np.full(20, m))
            for row, a, b in zip(p, low, high, strict=True):
                want = [s + i for s, n in zip(starts, sizes, strict=True) for i in range(n - m + 1) if (text[s + i : s + i + m] == row[:m]).all()]
                assert sorted(index.source[index.places(np.arange(a, b))].tolist()) == want


def test_merge():
    s = np.array([[1, 5, 7, 50, 70], [0, 0, 3, 0, 9], [0, 3, 5, 9, 20], [1, 0, 9, 0, 90], [0, 7, 8, 30, 40]])
    assert leaks.merge(s).tolist() == [[0, 0, 5, 0, 20], [0, 7, 8, 30, 40], [1, 0, 9, 0, 90]]


def test_spark_blocks_edges_and_clashes(spark):
    rng = random.Random(9)
    items = [(None, "a b c"), (3, "B c"), (3, "q a q a q a"), (3, None), (4, ""), (5, "one"), (10, "c q"), (2, "c q")]
    docs = texts(rng, 30, 40) + [None, "", "One-two ONE", "a b c q a b", "a b c q a b"]
    rows = [(None if i == 3 else i // 2, t, "x") for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").withColumns({c: F.lit(7) for c in ("row", "items", "n_words")}).repartition(3)
    said = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(i), str(t), brute(t, items, 3)) for i, t, _ in rows)
    for most in (1000, 2):
        found = leaks.find_leaks(df, said, 3, most)
        got = sorted((str(r.row.doc_id), str(r.text), (r.n_words, [tuple(s) for s in r.spans], r["items"])) for r in found.collect())
        assert got == want
        assert found.select("row.*").columns == df.columns
    assert all(r.n_words >= 0 and not r.spans and not r["items"] for r in leaks.find_leaks(df, said.where("false")).collect())
    assert leaks.find_leaks(df.where("false"), said).count() == 0


def test_remove(spark):
    items = spark.createDataFrame([(1, "b c d"), (2, "é é")], "item_id long, text string")
    rows = [(1, "A, B-c d. e"), (2, "語 é é é! b c"), (3, None), (4, "b c d b c d"), (5, "none of it")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    got = leaks.remove_leaks(df, items)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "A, . e", 2: "語 ! b c", 3: None, 4: "", 5: "none of it"}


def test_query_finds_planted_passages(spark, tmp_path):
    said = " ".join(f"word{i}" for i in range(25))
    docs = [(1, said.upper()), (2, "x " * 50 + " ".join(said.split()[5:15]) + " y"), (3, " ".join(said.split()[:9])), (4, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(12, said), (9, said)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in leaks.op11_leaks(spark, str(tmp_path)).collect()}
    assert {i: (r.n_words, r.n_hit, r.n_items, r.contaminated) for i, r in got.items()} == {1: (25, 25, 2, True), 2: (61, 10, 2, True), 3: (9, 0, 0, False), 4: (0, 0, 0, False)}
    import hashlib

    assert got[1].items_sha256 == hashlib.sha256(b"12,9").hexdigest() and got[4].items_sha256 == hashlib.sha256(b"").hexdigest()
