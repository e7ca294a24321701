import math
import pickle
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strataloom.llm import ngrams

SF = "/root/testdata/sf0.001"


def test_filter_holds_what_was_put_in(spark):
    rng = np.random.default_rng(2)
    key = rng.integers(0, 2**48, 5000)
    n = rng.integers(1, 3000, 5000)
    pairs = spark.createDataFrame(list(zip(key.tolist(), n.tolist())), "key long, n long")
    assert ngrams.entries(pairs) >= ngrams.levels_of(n).sum() - 5000
    f = ngrams.build_filter(pairs, 3)
    got = f.counts(key.view(np.uint64))
    assert (got > 0).all() and (np.maximum(got / n, n / got) <= ngrams.RATIO).mean() > 0.98
    other = rng.integers(0, 2**48, 20_000).view(np.uint64)
    assert (f.counts(other) > 0).mean() < 0.02


def test_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in ngrams.op4_ngrams(spark, SF).collect()}
    c = Counter()
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), b""] for r in docs.collect()}
    for i, ws in texts.items():
        if not rows[i].held_out:
            c.update(ws)
    n, v = sum(c.values()), len(c)
    for i, ws in texts.items():
        assert math.isclose(rows[i].base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert rows[i].n_tokens == len(ws) and rows[i].n_known == sum(c[w] > 0 for w in ws) and rows[i].train_tokens == n


def test_pairs_help_on_held_out_texts(spark):
    """From about a thousand texts on; with 200 the pairs say too little to make up for their share."""
    held = [r for r in ngrams.op4_ngrams(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_from_exact_counts(spark):
    """Each text's score by plain Python: pairs' exact counts read on the filter's scale, the shares of the model."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: [*(r.text or "").encode().lower().split(), b""] for r in docs.collect()}
    model, tables = ngrams.fit(docs)
    one, two = Counter(), Counter()
    for ws in texts.values():
        one.update(ws)
        two.update(zip([None, *ws], ws, strict=False))

    def exact(ws):
        out = 0.0
        for a, b in zip([None, *ws], ws, strict=False):
            first = len(texts) if a is None else one[a]
            n = min(ngrams.VALUES[ngrams.levels_of(np.array([two[a, b]]))[0]], one[b], first)
            share = model.share[int(math.log2(first))]
            out += math.log10(share * n / first + (1 - share) * (one[b] + 1) / (model.tokens + model.words + 1))
        return out

    got = {r.doc_id: r.score for r in ngrams.score_documents(docs, model, tables).collect()}
    # false positives can't raise counts that are there by more than a level or two
    assert all(math.isclose(got[i], exact(ws), rel_tol=0.01) for i, ws in texts.items())


def test_tables_that_are_not_broadcast_give_the_same_scores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    monkeypatch.setattr(ngrams, "WORDS_PART", 1000)
    monkeypatch.setattr(ngrams, "PART", 4)
    by = []
    for bits, most, slice_ in ((1 << 30, 10**6, 1), (0, 10**6, 50_000), (1 << 30, 0, 50_000), (0, 0, 2_000_000)):
        monkeypatch.setattr(ngrams, "SLICE", slice_)
        model, tables = ngrams.fit(docs, max_bits=bits, max_vocabulary=most)
        assert (model.filter is None) == (bits == 0) and (model.look is None) == (most == 0)
        by.append(ngrams.score_documents(docs, model, tables).orderBy("doc_id").toPandas())
    for other in by[1:]:
        assert np.allclose(by[0]["score"], other["score"]) and np.allclose(by[0]["base_score"], other["base_score"]) and (by[0]["n_known"] == other["n_known"]).all()


def test_edge_rows(spark):
    rows = [(1, "a b a b a b", "x"), (None, "a b", "x"), (2, None, None), (3, "", None), (3, "", None), (4, "a " * 100_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model, words = ngrams.fit(docs)
    got = ngrams.score_documents(docs, model, words).collect()
    assert len(got) == 6 and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1}
    for most in (10**6, -1):
        model, words = ngrams.fit(docs.where(F.lit(False)), max_bits=most, max_vocabulary=most)
        got = ngrams.score_documents(docs, model, words).collect()
        assert len(got) == 6 and all(r.n_known == 0 for r in got)
        assert ngrams.score_documents(docs.where(F.lit(False)), model, words).count() == 0


def test_pairs_that_occur_once_count(spark):
    rows = [(i, f"a{i} b{i}") for i in range(300)]
    model, counts = ngrams.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    model.share = np.full(64, 0.5)
    seen, mixed = (r.score for r in ngrams.score_documents(spark.createDataFrame([(1, "a1 b1"), (2, "a1 b2")], "doc_id long, text string"), model, counts).orderBy("doc_id").collect())
    assert seen > mixed + 2


def test_shares_come_from_all_texts(spark, monkeypatch):
    """The shares of 3,000 texts by plain Python, each pair's every occurrence among them."""
    rows = [(i, f"a{i % 7} b{i % 3 if i % 5 else i % 11} c") for i in range(3000)]
    read, prepared = [], ngrams._prepared
    monkeypatch.setattr(ngrams, "_prepared", lambda docs, tables: read.append(docs.count()) or prepared(docs, tables))
    model, _ = ngrams.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert read == [3000]
    texts = [[*t.encode().split(), b""] for _, t in rows]
    one, two = Counter(w for ws in texts for w in ws), Counter(p for ws in texts for p in zip([None, *ws], ws, strict=False))
    bins = Counter()
    for (a, b), n in two.items():
        first = (len(texts) if a is None else one[a]) - 1
        held = max(min(ngrams.VALUES[ngrams.levels_of(np.array([n]))[0]], one[b], first + 1) - 1, 0)
        ratio = max(held / max(first, 1), 1e-12) / (one[b] / (model.tokens + model.words + 1))
        bins[int(math.log2(max(first, 1))), min(max(round(8 * math.log2(ratio)), -400), 400)] += n
    share = [0.3] * 64
    for _ in range(30):
        total, own = [0.0] * 64, [0.0] * 64
        for (m, r), n in bins.items():
            total[m] += n
            own[m] += n * share[m] * 2 ** (r / 8) / (share[m] * 2 ** (r / 8) + 1 - share[m])
        share = [(x + 0.3) / (t + 1) for x, t in zip(own, total, strict=True)]
    assert np.allclose(model.share, np.clip(share, 0.001, 0.95), rtol=1e-4)


def test_training_texts_are_read_twice(spark, monkeypatch):
    """Once to count and once to look up; shares and scores come from what was looked up, equal to those of the texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned, read, prepared = ~ngrams.held_out(), [], ngrams._prepared
    model, tables = ngrams.fit(docs.where(learned))
    want = ngrams.score_documents(docs, model, tables).orderBy("doc_id").toPandas()
    monkeypatch.setattr(ngrams, "_prepared", lambda rows, tables: read.append(rows.count()) or prepared(rows, tables))
    got = ngrams.fit_and_score(docs, learned).orderBy("doc_id").toPandas()
    assert sorted(read) == sorted([docs.where(learned).count(), docs.where(~learned).count()])
    assert got.equals(want)


def test_slices_are_cut_by_words(spark, monkeypatch):
    """What is asked of the parts grows with the words, not with the number of texts; one row answers a slice for each part."""
    rows, stored = {}, ngrams.stored
    monkeypatch.setattr(ngrams, "stored", lambda df, name: rows.setdefault(name, stored(df, name)))
    docs = spark.createDataFrame([(i, f"a{i % 7} b{i % 11} c") for i in range(3000)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(ngrams, "forget", lambda df: None)
    model, _ = ngrams.fit(docs, max_bits=0, max_vocabulary=0)
    assert rows["slices"].count() == 1 and model.texts == 3000 and model.tokens == 12_000


def test_nothing_large_is_broadcast(spark, monkeypatch):
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(pickle.dumps(value))) or broadcast(self, value))
    assert ngrams.op4_ngrams(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sent and max(sent) < 10_000


def test_many_parts_and_slices(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    few = ngrams.fit_and_score(docs, ~ngrams.held_out()).orderBy("doc_id").toPandas()
    for name, size in (("PART", 1), ("WORDS_PART", 20_000), ("SLICE", 50_000), ("SOME", 1000)):
        monkeypatch.setattr(ngrams, name, size)
    many = ngrams.fit_and_score(docs, ~ngrams.held_out()).orderBy("doc_id").toPandas()
    assert few[["doc_id", "n_tokens", "n_known", "train_tokens"]].equals(many[["doc_id", "n_tokens", "n_known", "train_tokens"]])
    # other segments have other false positives
    assert np.allclose(few["base_score"], many["base_score"]) and np.allclose(few["score"], many["score"], rtol=0.01)


def test_a_part_is_probed_once_for_all_slices(monkeypatch):
    asked, probe = [], ngrams.probe
    monkeypatch.setattr(ngrams, "probe", lambda bits, segment, key, level=None: asked.append(len(key)) or probe(bits, segment, key, level))
    rng = np.random.default_rng(4)
    keys = [np.sort(rng.choice(2000, 500, False)) for _ in range(300)]
    all_keys = np.sort(rng.integers(0, 2**48, 2000).astype(np.uint64))
    rows = [ngrams._said(ngrams.PAIR, [0], ngrams.COUNTED, i, ngrams._blobs(ngrams._pack(all_keys[k]), np.array([0, 500])), ngrams._blobs(np.full(500, i % 3 + 1, np.uint32), np.array([0, 500]))) for i, k in enumerate(keys)]
    part = ngrams.Part(ngrams.PAIR, 0)
    table, answers = part.take(ngrams.COUNTED, rows)
    total = np.zeros(2000, np.int64)
    for i, k in enumerate(keys):
        total[k] += i % 3 + 1
    assert asked == [2000] and table.column("many").to_pylist() == [len(part.bits)]
    for k, blob in zip(keys, answers.column("key").to_pylist(), strict=True):
        got, want = np.frombuffer(blob, np.uint8), ngrams.levels_of(total[k])
        assert (got >= want).all() and (got == want).mean() > 0.9
