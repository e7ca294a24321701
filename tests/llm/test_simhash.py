import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataloom.llm import simhash
from strataloom.llm.common import connected_components
from tests.llm.brute import components

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(p, 42) >> bit & 1 for p in parts)
        out |= (2 * ones > len(parts)) << bit
    return out


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "a b", "a b c", "A b C d e f", "é ü \x0b x y\x0cz", "word " * 300])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_anchor_balls_cover_every_pair_within_three_bits():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(300)]
    near = []
    for x in base:
        for b in rng.sample(range(64), rng.randint(0, 3)):
            x ^= 1 << b
        near.append(x)
    fps = np.array(base + near, np.uint64)
    key, row, home = simhash.anchors(fps)
    at = [set() for _ in fps]
    homes = [set() for _ in fps]
    for k, r, h in zip(key, row, home):
        at[r].add(k)
        if h:
            homes[r].add(k)
    for i in range(300):
        assert (homes[i] & at[300 + i]) | (at[i] & homes[300 + i])


def brute_classes(rows):
    ids = [i for i, _ in rows]
    fps = np.array([f for _, f in rows], np.int64).view(np.uint64)
    links = []
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 3):
            links.append((ids[i], ids[i + 1 + int(j)]))
    return components(ids, links)


def test_classes_match_brute_force_on_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = simhash.simhash_classes(docs).collect()
    want = brute_classes([(r.doc_id, r.fp) for r in got])
    assert len(got) == docs.count()
    assert {r.doc_id: r.component_id for r in got} == want


def test_large_anchor_is_compared_in_chunks(spark):
    rng = random.Random(2)
    center = rng.getrandbits(63)
    fps = {center}
    for _ in range(400):
        x = center
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        fps.add(x)
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    for most in (20, 16_384):
        got = {r.node: r.component for r in connected_components(simhash.near_pairs(df, 3, most)).collect()}
        want = brute_classes([(x, x) for x in signed])
        assert {x: got.get(x, x) for x in signed} == want


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b c d", "x"), (4, "a b c d", "y"), (4, "a b c d", "y"), (7, "word " * 50_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash.simhash_classes(df).collect()))
    assert got == [(False, 1, 1), (False, 2, 1), (False, 4, 4), (False, 4, 4), (False, 7, 7), (True, 0, 4)]
    assert simhash.simhash_classes(df.where(F.lit(False))).count() == 0


def test_components_of_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == components({x for e in edges for x in e}, edges)


def test_one_row_of_each_class_stays(spark):
    """Also where classes share a doc_id, and where rows have none."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 40)) for _ in range(60)]
    rows = [(i // 2, x, i) for i, x in enumerate(texts)] + [(i, texts[i], 0) for i in range(20)] + [(None, texts[0], 1), (None, "no id", 2), (None, "no id", 2), (5, None, 3), (6, "", 4)]
    kept = [(r.doc_id, r.text) for r in simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)).collect()]
    by = {}
    for i, x, _ in rows:
        by.setdefault(simhash.fingerprint(x), []).append((i is None, i, x))
    fps = list(by)
    root = {a: a for a in fps}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 3:
                old, new = root[a], root[b]
                root = {k: new if v == old else v for k, v in root.items()}
    least = {}
    for f, members in by.items():
        for none, i, _ in members:
            least[root[f]] = min(least.get(root[f], (True, 0)), (none, i or 0))
    assert sorted(root[simhash.fingerprint(x)] for _, x in kept) == sorted(set(root.values()))
    assert all((i is None, i or 0) == least[root[simhash.fingerprint(x)]] for i, x in kept)
