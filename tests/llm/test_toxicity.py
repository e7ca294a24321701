import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataloom.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_terms_of_a_text():
    reader = toxicity.Reader(None)
    term, n = reader.counts("Idiot, idiotic IDIOT %%% don't")
    assert dict(zip([*reader.terms], n.tolist(), strict=True)) == {"idiot": 2, "idiotic": 1, "don": 1, "t": 1} and term.tolist() == [0, 1, 2, 3]
    assert len(reader.counts(None)[0]) == len(toxicity.Reader({}).counts("idiot")[0]) == 0


def random_model(rng, n=700, terms=60):
    counts = rng.integers(1, 9, (n, terms)) * (rng.random((n, terms)) < np.linspace(0.01, 0.4, terms))
    row, term = np.nonzero(counts)
    model = toxicity.Model({}, np.linspace(3, 1, terms), np.arange(n), (rng.random(n) < 0.5).astype(float), term, counts[row, term], (counts > 0).sum(1))
    m = np.zeros((n, terms))
    for i in range(n):
        t = np.flatnonzero(counts[i])
        m[i, t] = toxicity.weighed(t, counts[i, t], model.weights)
    return m, model


@pytest.mark.parametrize("postings", (1 << 21, 1000))
def test_pruned_search_finds_what_brute_force_finds(monkeypatch, postings):
    monkeypatch.setattr(toxicity, "POSTINGS", postings)
    rng = np.random.default_rng(3)
    m, model = random_model(rng)
    assert 0 < len(model.index.common) < 60
    texts = [(t, rng.integers(1, 9, len(t))) for t in (np.flatnonzero(rng.random(60) < 0.2) for _ in range(80))]
    cos, row = model.nearest(texts)
    for i, (t, n) in enumerate(texts):
        v = np.zeros(60)
        v[t] = toxicity.weighed(t, n, model.weights)
        whole = np.round(m @ v, 12)
        best = np.lexsort((np.arange(700), -whole))[: model.k]
        best = best[whole[best] > 0]
        assert row[i][row[i] >= 0].tolist() == best.tolist() and np.allclose(cos[i][: len(best)], whole[best])


def test_blocks_below_the_bound_are_not_read():
    """Of 80 blocks, each with a word of its own, a text of one block's word reads that block's postings only."""
    n = 80 * toxicity.BLOCK
    model = toxicity.Model({}, np.ones(81), np.arange(n), np.zeros(n), np.stack([np.arange(n) // toxicity.BLOCK, np.full(n, 80)], 1).ravel(), np.ones(2 * n, int), np.full(n, 2))
    index, read = model.index, []
    assert index.common.tolist() == [80] and len(index.most) == 80

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                read.extend(np.asarray(at).tolist())
            return np.asarray(self)[at]

    index.entry = index.entry.view(Watched)
    cos, row = model.nearest([(np.array([7, 80]), np.array([1, 1]))])
    assert np.allclose(cos, 1) and row[0].tolist() == [7 * toxicity.BLOCK + i for i in range(model.k)]
    assert set(index.row[read] // toxicity.BLOCK) == {7}


@pytest.mark.parametrize("wrong", (0.0, 0.02, 0.2))
def test_calibration_finds_the_lowest_loss(wrong):
    """Steep votes, some on the wrong side: no point of a fine grid around (slope, shift) has a lower loss, and it isn't the start."""
    rng = np.random.default_rng(4)
    labels = (rng.random(3000) < 0.1).astype(float)
    votes = np.abs(labels - rng.beta(0.05, 2, 3000))
    turned = rng.random(3000) < wrong
    votes[turned] = 1 - votes[turned]
    ones = labels.sum()
    aim, x = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (3000 - ones + 2)), toxicity.logit(votes)

    def loss(a, b):
        z = a * x + b
        return np.sum(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - aim * z) + toxicity.HELD / 2 * ((a - 1) ** 2 + b**2)

    a, b = toxicity.calibrated(votes, labels)
    assert (a, b) != (1.0, 0.0)
    assert all(loss(a, b) <= loss(a + d, b + e) + 1e-9 for d in (-0.1, -1e-3, 0, 1e-3, 0.1) for e in (-0.1, -1e-3, 0, 1e-3, 0.1))
    assert loss(a, b) < loss(1, 0)


def test_calibration_of_nothing():
    assert toxicity.calibrated(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def test_query_agrees_with_brute_force(spark):
    """Terms, weights, vectors, neighbours, votes and calibration of the query, by plain Python over all labelled texts."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts, labels = dict(docs), {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    terms = lambda x: Counter(re.findall(r"[^\W_]+", x.lower()))  # noqa: E731  the tables have no script without spaces
    df = Counter(t for _, x in docs for t in terms(x))
    same = {}
    for i in sorted(i for i, y in labels.items() if y is not None and zlib.crc32(str(i).encode()) % 5):
        same.setdefault((texts[i], labels[i]), i)
    ids, ys = [*same.values()], np.array([y for _, y in same])
    seen = [terms(texts[i]) for i in ids]

    def learned(some):
        """The vote of the examples in some on a text's terms, and the sum of its cosines, by weights that only they shape."""
        ones = sum(int(ys[k]) for k in some)
        zeros, p = len(some) - ones, (ones + 1) / (len(some) + 2)
        by = [Counter(t for k in some if ys[k] == y for t in seen[k]) for y in (0, 1)]
        known = {}
        for t in {t for c in seen for t in c}:
            a, c = by[1][t] + 2 * p, by[0][t] + 2 * (1 - p)
            z = math.log(a / (ones + 2) / (c / (zeros + 2))) / math.sqrt(1 / a + 1 / c)
            known[t] = (math.log((1 + len(docs)) / (1 + df[t])) + 1) * (0.3 + max(z, 0) ** 2)

        def vector(c):
            v = {t: (1 + math.log(n)) * known[t] for t, n in c.items() if t in known}
            size = math.sqrt(sum(x * x for x in v.values()))
            return {t: x / size for t, x in v.items()}

        vectors = {k: vector(seen[k]) for k in some}

        def vote(c):
            v = vector(c)
            cos = {k: sum(x * w.get(t, 0) for t, x in v.items()) for k, w in vectors.items()}
            near = sorted((k for k in some if cos[k] > 0), key=lambda k: -cos[k])[:15]
            w = [cos[k] ** 4 for k in near]
            prior = (ones + 0.1) / (len(some) + 2)
            return (sum(x * ys[k] for x, k in zip(w, near, strict=True)) + 1e-6 * prior) / (sum(w) + 1e-6), sum(cos[k] for k in near)

        return vote

    own = np.zeros(len(ids))
    for f in range(5):
        vote = learned([k for k, i in enumerate(ids) if i % 5 != f])
        for k in (k for k, i in enumerate(ids) if i % 5 == f):
            own[k] = vote(seen[k])[0]
    slope, shift = toxicity.calibrated(own, ys.astype(float))
    vote = learned(range(len(ids)))
    got = {r.doc_id: r for r in toxicity.score_documents(spark.read.parquet(f"{SF}/documents.parquet"), toxicity.fit_tables(spark.read.parquet(f"{SF}/documents.parquet"), SF)).collect()}
    for i, x in docs[::9]:
        v, total = vote(terms(x))
        v = min(max(v, 1e-4), 1 - 1e-4)
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-(slope * math.log(v / (1 - v)) + shift))), abs_tol=1e-6)
        assert math.isclose(sum(e.cosine for e in got[i].evidence), total, rel_tol=1e-6, abs_tol=1e-9)


def test_held_out_accuracy(spark):
    got = toxicity.op10_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got)
    assert len(got) > 50 and right / len(got) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda ls: sorted(map(str, toxicity.score_documents(docs, toxicity.fit(docs, ls.where(~toxicity.held_out()))).select("doc_id", "score").collect()))
    assert score(labels) == score(turned)


def test_edge_rows(spark):
    rows = [(i, "you idiot fool" if i % 2 else "fine words here", "x") for i in range(40)] + [(None, "idiot", "x"), (90, None, None), (91, "", None), (91, "", None), (92, "fine idiot " * 40_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (500, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[90].score == by[91].score < 0.5
    assert toxicity.score_documents(docs.where("false"), model).count() == 0
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    nothing = toxicity.fit(docs.where("false"), labels)
    assert toxicity.score_documents(docs, nothing).count() == len(rows)


def test_terms_are_whole_words():
    assert toxicity.runs_of("internet interest K1LL y0u_2") == ["internet", "interest", "k1ll", "y0u", "2"]
    assert toxicity.runs_of("你是一个人 abc日x 語") == ["你是", "是一", "一个", "个人", "abc", "日", "x", "語"]
    assert toxicity.runs_of("") == [] and toxicity.runs_of("Ünï ß") == ["ünï", "ß"]
