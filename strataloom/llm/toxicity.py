"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A term is a whole word, digits included; scripts without spaces give pairs of characters. A term's weight in a text is its damped frequency times
its inverse document frequency over all documents, times how surely it goes with label 1 in the
labelled sample; no term is left out. The examples stand in blocks. Every term has its highest
entry of each block: terms that many examples hold beside a dense row of entries, the others
beside the postings of that block. A text sums these highest entries to a bound for each block,
then reads the entries only of blocks whose bound reaches its kth cosine so far. The nearest
examples vote by distance. Votes are calibrated on the examples in folds, each looked up among the
other folds with weights that its fold's labels haven't shaped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.common import forget, stored

#: A run of letters and digits, or a character of a script that is written without spaces (Han, kana, Thai, Lao, Khmer, Burmese).
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORDS = re.compile(rf"[{UNSPACED}]+|[^\W_{UNSPACED}]+")
IS_UNSPACED = re.compile(rf"[{UNSPACED}]")


def runs_of(text: str) -> list[str]:
    """The terms of a text: whole lower-case words, digits included; of scripts without spaces each pair of neighbours, or the single character."""
    text = text.lower()
    out = WORDS.findall(text)
    if text.isascii() or not IS_UNSPACED.search(text):
        return out
    return [t for w in out for t in ([w] if len(w) < 2 or not IS_UNSPACED.match(w) else [w[i : i + 2] for i in range(len(w) - 1)])]


#: Examples of one block; texts that are looked up together, and the blocks of their terms at most, but for a single text.
BLOCK, TOGETHER, POSTINGS = 128, 64, 1 << 19
#: Parts of the examples that are held out in turn for calibration.
FOLDS = 5
#: A term that more than this share of the examples hold has a dense row.
COMMON = 0.04
#: Weight of the vote that all examples cast together, and how many made-up votes hold the calibration to the votes as they are.
PRIOR, HELD = 1e-6, 5.0


class Reader:
    """Numbers and counts of the terms of texts; unknown terms are left out, or numbered on sight if `terms` is None."""

    def __init__(self, terms: dict[str, int] | None) -> None:
        self.grow, self.terms = terms is None, {} if terms is None else terms

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(term, count), ascending by term."""
        runs = runs_of(text or "")
        if self.grow:
            for w in runs:
                self.terms.setdefault(w, len(self.terms))
        get = self.terms.get
        own = np.fromiter((get(w, -1) for w in runs), np.int64, len(runs))
        return np.unique(own[own >= 0], return_counts=True)


def weighed(term: np.ndarray, n: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The unit vector of a text's terms."""
    x = (1 + np.log(n)) * weights[term]
    size = np.sqrt((x * x).sum())
    return x / size if size else x


def telling(with_one: np.ndarray, with_zero: np.ndarray, ones: int, zeros: int, floor: float = 0.3) -> np.ndarray:
    """A factor per term: `floor` and the square of the z-score of its log odds of label 1, where positive. Counts are of examples; two made-up ones hold each term to the average."""
    p = (ones + 1) / (ones + zeros + 2)
    a, c = with_one + 2 * p, with_zero + 2 * (1 - p)
    z = np.log((a / (ones + 2)) / (c / (zeros + 2))) / np.sqrt(1 / a + 1 / c)
    return floor + np.maximum(z, 0) ** 2


class Index:
    """Vectors of n examples (row, term, entry x) in blocks of BLOCK rows.

    Common terms have dense rows, and `highest` per block. The others have postings by term, then
    block: run r of them, of one term and block, ends before postings[starts_at[r + 1]], lies in
    block[r], and its highest entry is most[r]; the runs of a term begin at first[term].
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, x: np.ndarray, n: int, terms: int) -> None:
        often = np.bincount(term, minlength=terms) > COMMON * n
        self.common = np.flatnonzero(often)
        self.place = np.where(often, np.cumsum(often) - 1, -1)  # of a common term among them
        on = often[term]
        self.dense = np.zeros((len(self.common), n))
        self.dense[self.place[term[on]], row[on]] = x[on]
        order = np.lexsort((row[~on], term[~on]))
        self.row, self.entry, term = row[~on][order], x[~on][order], term[~on][order]
        block = self.row // BLOCK
        new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, np.int64)
        self.starts_at, self.block = np.r_[new, len(term)], block[new]
        self.most = np.maximum.reduceat(self.entry, new) if len(new) else np.zeros(0)
        self.first = np.searchsorted(term[new], np.arange(terms + 1))
        self.starts = np.arange(0, n, BLOCK)
        self.highest = np.maximum.reduceat(self.dense, self.starts, axis=1) if n else np.zeros((len(self.common), 0))


@dataclass
class Model:
    """terms: term to number; weights: per term; the examples' ids, labels, and their terms and counts one after the other, sizes of them each.

    Only these travel; the index over them is built where it is used.
    """

    terms: dict[str, int]
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    term: np.ndarray
    n: np.ndarray
    sizes: np.ndarray
    k: int = 15
    power: float = 4.0
    slope: float = 1.0
    shift: float = 0.0

    def __getstate__(self) -> dict:
        return {f.name: self.__dict__[f.name] for f in fields(self)}

    @property
    def prior(self) -> float:
        return (float(self.labels.sum()) + 0.1) / (len(self.labels) + 2.0)

    def texts(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(term, count) of the examples at rows."""
        ends = np.cumsum(self.sizes)
        return [(self.term[e - s : e].astype(np.int64), self.n[e - s : e]) for e, s in zip(ends[rows], self.sizes[rows], strict=True)]

    def among(self, some: np.ndarray, weights: np.ndarray) -> Model:
        """The model of some of the examples, with other weights of terms."""
        on = np.repeat(some, self.sizes)
        return Model({}, weights, self.ids[some], self.labels[some], self.term[on], self.n[on], self.sizes[some], self.k, self.power)

    @cached_property
    def index(self) -> Index:
        own = self.texts(np.arange(len(self.ids)))
        x = np.concatenate([weighed(t, n, self.weights) for t, n in own]) if own else np.zeros(0)
        return Index(np.repeat(np.arange(len(self.ids)), self.sizes), self.term, x, len(self.ids), len(self.weights))

    def nearest(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, rows) of the k nearest examples of each text (term, count), ties to smaller rows; -1 where there are fewer with a cosine above 0."""
        b, n, k = len(texts), len(self.ids), self.k
        best, rows = np.zeros((b, k)), np.full((b, k), -1)
        if not n or not b:
            return best, rows
        index = self.index
        term = np.concatenate([t for t, _ in texts])
        x = np.concatenate([weighed(t, c, self.weights) for t, c in texts])
        who = np.repeat(np.arange(b), [len(t) for t, _ in texts])
        dense = np.zeros((b, len(index.common)))
        on = index.place[term] >= 0
        dense[who[on], index.place[term[on]]] = x[on]
        term, x, who = term[~on], x[~on], who[~on]
        many = index.first[term + 1] - index.first[term]
        if b > 1 and many.sum() > POSTINGS:
            halves = [self.nearest(texts[part]) for part in (slice(b // 2), slice(b // 2, b))]
            return np.concatenate([h[0] for h in halves]), np.concatenate([h[1] for h in halves])
        run, whose, x = spread(index.first[term], many), np.repeat(who, many), np.repeat(x, many)
        blocks = len(index.starts)
        bounds = np.bincount(whose * blocks + index.block[run], x * index.most[run], b * blocks).astype(float, copy=False).reshape(b, blocks) + dense @ index.highest
        order = np.argsort(index.block[run], kind="stable")
        run, whose, x = run[order], whose[order], x[order]
        begins = np.searchsorted(index.block[run], np.arange(blocks + 1))
        scores, top = np.full((b, n), -np.inf), np.zeros((b, k))  # top: the highest cosines so far, the least of them first
        for at in np.argsort(-bounds.max(0), kind="stable"):
            lo, hi = index.starts[at], min(index.starts[at] + BLOCK, n)
            visit = (bounds[:, at] > 0) & (bounds[:, at] >= top[:, 0] - 1e-9)
            ask = np.flatnonzero(visit)
            if len(ask):
                own = slice(begins[at], begins[at + 1])
                on = visit[whose[own]]
                r, w = run[own][on], (np.cumsum(visit) - 1)[whose[own][on]]
                many = index.starts_at[r + 1] - index.starts_at[r]
                read = spread(index.starts_at[r], many)
                sums = np.bincount(np.repeat(w, many) * (hi - lo) + index.row[read] - lo, np.repeat(x[own][on], many) * index.entry[read], len(ask) * (hi - lo))
                scores[ask, lo:hi] = got = sums.reshape(len(ask), hi - lo) + dense[ask] @ index.dense[:, lo:hi]
                top[ask] = np.partition(np.concatenate([top[ask], got], axis=1), hi - lo, axis=1)[:, hi - lo :]
        who, row = np.nonzero((scores > 0) & (scores >= top[:, :1] - 1e-9))
        cos = np.round(scores[who, row], 12)  # equal cosines may differ by the order of sums
        order = np.lexsort((row, -cos, who))
        who, row, cos = who[order], row[order], cos[order]
        rank = np.arange(len(who)) - np.searchsorted(who, np.arange(b))[who]
        on = rank < k
        best[who[on], rank[on]], rows[who[on], rank[on]] = cos[on], row[on]
        return best, rows

    def votes(self, cos: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The share of label 1 among each text's nearest examples, weighed by a power of the cosine, and of all examples by a little."""
        w = np.where(rows >= 0, cos, 0.0) ** self.power
        return ((w * (self.labels[rows] if len(self.labels) else 0.0)).sum(1) + PRIOR * self.prior) / (w.sum(1) + PRIOR)

    def score(self, votes: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * logit(votes) + self.shift)


def spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of the ranges of so many numbers, one range after the other."""
    return np.arange(many.sum()) + np.repeat(start - np.cumsum(many) + many, many)


def logit(v: np.ndarray) -> np.ndarray:
    v = np.clip(v, 1e-4, 1 - 1e-4)
    return np.log(v / (1 - v))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def calibrated(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from votes to labels, held to (1, 0) by HELD.

    The loss is convex. Newton's steps are halved until they lower it, since votes near 0 and 1 make
    whole steps overshoot. A slope isn't below 0.05, so that more votes never score less.
    """
    x, start = np.stack([logit(votes), np.ones(len(votes))], axis=1), np.array([1.0, 0.0])
    ones = labels.sum()
    aim = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - aim * z).sum() + HELD / 2 * ((w - start) ** 2).sum())

    w, now = start, loss(start)
    for _ in range(100):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + HELD * np.eye(2), x.T @ (p - aim) + HELD * (w - start))
        while (new := loss(w - step)) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        w, now = w - step, new
    return max(float(w[0]), 0.05), float(w[1])


def _texts(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *more)


def fit(docs: DataFrame, labelled: DataFrame, max_examples: int = 6_000) -> Model:
    """Learn from labelled (doc_id, toxic) joined with docs.

    max_examples bounds the labelled rows: of more, those with the smallest hashes of doc_id are
    taken, about max_examples of them; equal texts with equal labels count once. The terms are all
    of theirs. Document frequencies come from all docs. Null ids and labels are not learned from;
    an id with several labels counts as 1 if one of them is.
    """
    labelled = labelled.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    rate = min(1.0, max_examples / max(labelled.count(), 1))
    chosen = labelled.where(F.xxhash64("doc_id").bitwiseAND(0xFFFFFF) < rate * float(1 << 24))
    rows = _texts(docs).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy(F.xxhash64("text").alias("same"), "label").agg(F.min(F.struct("doc_id", "text")).alias("d")).select("d.doc_id", "label", "d.text")
    rows = stored(rows, "examples")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reader = Reader(None)
            own = [reader.counts(t) for t in b.column("text").to_pylist()]
            names = np.array([*reader.terms], object)
            said = [names[t].tolist() for t, _ in own]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(said, pa.list_(pa.string())), pa.array([c.tolist() for _, c in own], pa.list_(pa.int64()))], ["doc_id", "label", "terms", "n"])

    table = rows.mapInArrow(coded, "doc_id long, label int, terms array<string>, n array<long>").toArrow()
    forget(rows)
    # numbers of terms follow their order, examples that of ids and labels, so reruns agree
    table = table.take(pc.sort_indices(table.select(["doc_id", "label"]), [("doc_id", "ascending"), ("label", "ascending")]))
    labels, ids = (table.column("label").to_numpy() > 0).astype(float), table.column("doc_id").to_numpy()
    row = np.repeat(np.arange(len(ids)), pc.list_value_length(table.column("n")).to_numpy().astype(np.int64))
    n, names = table.column("n").combine_chunks().flatten().to_numpy(), table.column("terms").combine_chunks().flatten().dictionary_encode()
    del table
    term, terms = names.indices.to_numpy().astype(np.int64), {t: i for i, t in enumerate(names.dictionary.to_pylist())}
    del names
    pa.default_memory_pool().release_unused()  # the driver has little room

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Reader(terms), np.zeros(len(terms) + 1, np.int64)
        for b in batches:
            total[-1] += len(b)
            for text in b.column("text").to_pylist():
                total[reader.counts(text)[0]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    seen = docs.select(F.col("text").cast("string")).mapInArrow(found, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[seen.column("term").to_numpy()] = seen.column("n").to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    def weights_of(some: np.ndarray) -> np.ndarray:
        """The weights of terms by the labels of some examples."""
        on = some[row]
        with_one = np.bincount(term[on], labels[row[on]], len(terms))
        return idf * telling(with_one, np.bincount(term[on], minlength=len(terms)) - with_one, int(labels[some].sum()), int((1 - labels[some]).sum()))

    weights = weights_of(labels >= 0)
    without = np.stack([weights_of(ids % FOLDS != f) for f in range(FOLDS)])
    sizes = np.bincount(row, minlength=len(ids))
    # examples that lean on the same term share blocks, which makes the bounds tight
    ends, lead = np.cumsum(sizes), np.full(len(ids), -1)
    for i in np.flatnonzero(sizes):
        own = slice(ends[i] - sizes[i], ends[i])
        lead[i] = term[own][np.argmax(weighed(term[own], n[own], weights))]
    order = np.lexsort((ids, lead))
    at = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in order]) if len(order) else np.zeros(0, np.int64)
    model = Model(terms, weights, ids[order], labels[order], term[at].astype(np.int32), n[at].astype(np.int32), sizes[order])
    model.slope, model.shift = calibrated(_held_out_votes(docs, model, without), model.labels)
    return model


def _held_out_votes(docs: DataFrame, model: Model, without: np.ndarray) -> np.ndarray:
    """The vote on each example of those of other folds (ids modulo FOLDS), with the weights without its fold, in tasks of a few hundred."""
    sc = docs.sparkSession.sparkContext
    fold = model.ids % FOLDS
    asked = [(f, start) for f in range(FOLDS) for start in range(0, int((fold == f).sum()), TOGETHER)]
    bare = Model({}, model.weights, model.ids, model.labels, model.term, model.n, model.sizes, model.k, model.power)  # the terms' names aren't read
    shared = sc.broadcast((bare, without))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, weights = shared.value
        now, others = -1, None
        for b in batches:
            for f, start in zip(b.column("fold").to_pylist(), b.column("start").to_pylist(), strict=True):
                if f != now:
                    now, others = f, m.among(m.ids % FOLDS != f, weights[f])
                rows = np.flatnonzero(m.ids % FOLDS == f)[start : start + TOGETHER]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(others.votes(*others.nearest(m.texts(rows))))], ["row", "vote"])

    tasks = docs.sparkSession.createDataFrame(pa.table({"fold": [f for f, _ in asked], "start": [s for _, s in asked]}), "fold int, start long")
    got = tasks.mapInArrow(work, "row long, vote double").toArrow()
    votes = np.zeros(len(model.ids))
    votes[got.column("row").to_numpy()] = got.column("vote").to_numpy()
    shared.destroy()
    return votes


def score_documents(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """doc_id, score, predicted, evidence (doc_id, cosine, label of the nearest examples) per row; no shuffle.

    keep: the struct column `row`, all columns of docs, instead of doc_id.

    A null or empty text, like any text without known terms, has no neighbours and scores what all
    examples together vote. Whole texts of any length are read. Repeated rows come out repeated, an
    empty table gives an empty one. The model, bounded by fit's max_examples, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = Reader(m.terms)
        for whole in batches:
            for i in range(0, len(whole), TOGETHER):
                b = whole.slice(i, TOGETHER)
                texts = b.column("text") if not inside else b.column("row").field("text")
                cos, rows = m.nearest([reader.counts(t) for t in texts.to_pylist()])
                s = m.score(m.votes(cos, rows))
                on = rows >= 0
                flat = pa.StructArray.from_arrays([pa.array(m.ids[rows[on]]), pa.array(cos[on]), pa.array(m.labels[rows[on]].astype(np.int32))], fields=list(kind.value_type))
                evidence = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(on.sum(1))].astype(np.int32)), flat, type=kind)
                yield pa.RecordBatch.from_arrays([b.column(own), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), evidence], [own, "score", "predicted", "evidence"])

    own = "row" if keep else "doc_id"
    inside = keep and dict(docs.dtypes).get("text") == "string"  # then texts needn't travel twice
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, *([] if inside else [F.col("text").cast("string")])) if keep else _texts(docs)
    return rows.mapInArrow(work, f"{own} {rows.schema[own].dataType.simpleString()}, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, label: int>>")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that aren't predicted to be toxic, with all their columns, whatever their names.

    Null and empty texts stay unless most examples are toxic; an empty table stays empty.
    """
    return score_documents(docs, model, keep=True).where("predicted = 0").select("row.*")


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string")) % 5 == 0, F.lit(False))


def fit_tables(docs: DataFrame, sf_dir: str) -> Model:
    """The model of docs learned from the labels table, without the held-out rows."""
    labels = docs.sparkSession.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return fit(docs, labels.where(~held_out()))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document: doc_id, held_out, score, predicted, evidence (ids of the nearest examples)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score_documents(docs, fit_tables(docs, sf_dir))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.col("evidence.doc_id").alias("evidence"))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
