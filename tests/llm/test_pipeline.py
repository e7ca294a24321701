from collections import Counter

import corpus_pipeline
from strataloom.llm import mixing, simhash, toxicity
from tests.llm.brute import components
from tests.llm.test_lines import brute

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == columns
        docs = corpus_pipeline.stored(out, "t")
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] and counts[4] == counts[5] > 0
    assert docs.where("not round_trip").count() == 0


def test_run_gives_the_same_rows_twice(spark):
    key = lambda df: sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(corpus_pipeline.run(spark, SF))


def test_stages_keep_what_plain_python_keeps(spark):
    """Each stage's rows on its own input: toxicity by predictions, lines by all pairs, SimHash by all pairs, the mix by its plan."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    said = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, toxicity.fit_tables(docs, SF)).collect()}
    clean = corpus_pipeline.stored(corpus_pipeline.drop_toxic(spark, docs, SF), "t")
    assert {r.doc_id for r in clean.collect()} == {i for i, p in said.items() if not p}
    texts = {r.doc_id: r.text for r in clean.collect()}
    lines = corpus_pipeline.stored(corpus_pipeline.dedup_lines(spark, clean, SF), "t")
    want = {i: x for i, x in brute(texts.items()).items() if x == texts[i] or x.split()}
    assert {r.doc_id: r.text for r in lines.collect()} == want
    fp = {i: simhash.fingerprint(x) for i, x in want.items()}
    ids = sorted(fp)
    roots = components(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fp[a] ^ fp[b]).bit_count() <= 3])
    one = corpus_pipeline.stored(corpus_pipeline.dedup_documents(spark, lines, SF), "t")
    assert {r.doc_id: r.text for r in one.collect()} == {i: x for i, x in want.items() if roots[i] == i}
    plan = {r.doc_id: r.copies for r in mixing.mix(one).collect()}
    mixed = corpus_pipeline.stored(corpus_pipeline.mix_sources(spark, one, SF), "t")
    assert Counter(r.doc_id for r in mixed.collect()) == {i: n for i, n in plan.items() if n}


def test_nulls_empty_texts_and_clashing_names(spark):
    rows = [(None, None, None, None, 1), (1, "", "en", "a", 1), (2, "one two three " * 9, "en", None, 1), (2, "one two three " * 9, "en", None, 1), (2, "other words here", None, "a", 2), (3, " ", "en", "a", 1), (4, "w " * 40_000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # names that stages use inside, values that tell rows apart, and a map
    names = [*"row copies slot gone score id h1 h2 i a b n best root _id _h1 _h2 _i _a _b key rank slots part fp th line".split()]
    docs = docs.selectExpr("*", *[f"coalesce(doc_id, -1) * 100 + {k} as {c}" for k, c in enumerate(names)], "map('k', doc_id) as words")
    had = {tuple(str(v) for k, v in r.asDict().items() if k != "text") for r in docs.collect()}
    for frame in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.stored(stage(spark, frame, SF), "t")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
                assert {tuple(str(v) for k, v in r.asDict().items() if k != "text") for r in out.collect()} <= had
            frame = out
        assert frame.count() <= 2 * len(rows)


def test_tables_that_go_leave_no_garbage_on_the_driver(spark):
    """Each table deleted is a point at which the driver's heap is collected whole, and so shrinks."""
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())
    table = corpus_pipeline.stored(spark.range(10), "t")
    before = full()
    corpus_pipeline.forget(table)
    assert full() > before
