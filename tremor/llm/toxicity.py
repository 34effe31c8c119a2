"""Toxicity by weak supervision.

Voters are terms: a seed lexicon of insults, and words and word beginnings (patterns) mined from a bounded sample of labelled rows. Each
votes toxic where it occurs and abstains elsewhere; one more voter votes clean where none occurs. A generative label model fits by
expectation maximisation how often each voter fires on either class, measures how the voters' errors correlate, and weights
correlated voters down. A linear classifier on hit statistics is then trained on the model's posterior labels and scaled on the
sample's labels. All of that is fitted on at most ``SAMPLE`` rows; every whole text is scored.

Terms are compared by the hashes of lower-cased words and of their first bytes, vectorised over the text of many documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import held_out, label_sample, only_columns, pieces, text_buffers, tidy, unwrapped, wrapped
from tremor.llm.textvec import ALNUM, LOWER, Words, mix, span_hashes

#: Labelled rows that terms, label model and classifier are fitted on at most.
SAMPLE = 16_000
THRESHOLD = 0.3
#: A voter looks for a word, or for words that begin so, in bytes; 0 stands for the whole word.
LENGTHS = (0, 4, 5, 6)
MOST_TERMS, MOST_VOTERS = 400, 64
#: Nats by which the labels of the texts with a mined term must speak against chance, which brings one of a thousand terms so far; the label model weighs those that are left.
SURPRISE = 7.0

SEED_TERMS = ["idiot", "moron", "stupid", "scum", "loser", "trash", "pathetic", "worthless", "disgusting", "clown", "imbecile", "vermin"]


def _terms(w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of words, hash of the term at each)."""
    low = LOWER[w.buf]
    size = w.ends - w.starts
    for n in LENGTHS:
        at = np.arange(len(size)) if n == 0 else np.flatnonzero(size > n)
        ends = w.ends[at] if n == 0 else w.starts[at] + n
        yield n, at, mix(span_hashes(low, w.starts[at], ends) + np.uint64(n * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def term_hash(word: str) -> int:
    data = np.frombuffer(word.lower().encode(), np.uint8)
    return int(mix(span_hashes(data, np.array([0]), np.array([len(data)])))[0])


def _mine(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents of either label that hold a term; counts by partition are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ys = [], []
        for b in pieces(batches, "text"):
            w = Words(*text_buffers(b.column(0)), ALNUM)
            y = b.column(1).to_numpy(zero_copy_only=False)
            for _, at, h in _terms(w):
                doc = w.doc[at]
                _, first = np.unique(mix(h + doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), return_index=True)
                keys.append(h[first])
                ys.append(y[doc[first]])
        if keys:
            terms, back = np.unique(np.concatenate(keys), return_inverse=True)
            ones = np.concatenate(ys)
            pos = np.bincount(back, weights=ones, minlength=len(terms)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(pos), pa.array(np.bincount(back, minlength=len(terms)) - pos)], names=["term", "toxic", "clean"])

    return sample.select("text", "y").mapInArrow(tidy(run), "term long, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Hits:
    """Which of some terms the texts hold."""

    def __init__(self, terms: np.ndarray):
        self.order = np.argsort(terms)
        self.sorted = terms[self.order]

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, document of each hit, term of each hit)."""
        w = Words(*text_buffers(batch.column(batch.schema.get_field_index("text"))), ALNUM)
        docs, terms = [], []
        for _, at, h in _terms(w):
            if len(self.sorted) and len(h):
                k = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
                yes = np.flatnonzero(self.sorted[k] == h)
                docs.append(w.doc[at[yes]])
                terms.append(self.order[k[yes]])
        none = np.zeros(0, np.int64)
        return w.counts, np.concatenate(docs) if docs else none, np.concatenate(terms) if terms else none


def _features(counts: np.ndarray, doc: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Statistics of the hits: sum of voter weights, distinct voters, hits, hits in 100 words, none at all."""
    n, k = len(counts), len(weight)
    hits = np.bincount(doc, minlength=n)
    pairs = np.unique(doc * max(k, 1) + term)
    distinct = np.bincount(pairs // max(k, 1), minlength=n)
    votes = np.bincount(pairs // max(k, 1), weights=weight[pairs % max(k, 1)] if k else None, minlength=n)
    return np.stack([np.minimum(votes, 20.0), np.log1p(distinct), np.log1p(hits), np.minimum(100 * hits / np.maximum(counts, 1), 10.0), (hits == 0).astype(float)], axis=1)


@dataclass
class LabelModel:
    """Share of toxic texts, rates at which each voter fires on toxic and on clean texts, and log-odds weights; the last voter fires where no other does."""

    prior: float
    rate: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        z = np.log(self.prior / (1 - self.prior)) + votes @ self.weight
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def label_model(votes: np.ndarray, prior: float, rounds: int = 12) -> LabelModel:
    """``votes``: rows by voters, 1 where a voter fires; 0 is abstention and no evidence. ``prior`` is held, which tells the two classes apart."""
    votes = np.hstack([votes, votes.sum(axis=1, keepdims=True) == 0])
    n, k = votes.shape
    q = np.where(votes[:, -1] > 0, 0.02, 0.8)
    model, most = None, np.zeros((k, k))
    for _ in range(rounds):
        a = (q @ votes + 0.2) / (q.sum() + 1)
        b = ((1 - q) @ votes + 0.02) / ((1 - q).sum() + 1)
        rest = votes - np.outer(q, a) - np.outer(1 - q, b)
        spread = np.sqrt((rest**2).mean(axis=0)) + 1e-6
        near = np.abs(rest.T @ rest / n / np.outer(spread, spread))
        np.fill_diagonal(near, 0)
        near = most = np.maximum(near, most)  # a group that errs together may come to define the classes; what it showed before that still counts
        share = 1 / np.sqrt(1 + np.where(near > 0.1, near, 0).sum(axis=1))  # of voters that err together each counts in part
        model = LabelModel(prior, np.stack([a, b]), share * np.log(a / b))
        q = model.posterior(votes)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Newton steps for soft labels ``y``; the last column of ``x`` is the intercept."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    terms: np.ndarray
    weight: np.ndarray
    beta: np.ndarray
    scale: tuple[float, float]

    def __call__(self, hits: Hits, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        counts, doc, term = hits(batch)
        x = _features(counts, doc, term, self.weight)
        z = np.hstack([x, np.ones((len(x), 1))]) @ self.beta
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * z + self.scale[1], -30, 30))), np.bincount(doc, minlength=len(counts))


def _seeds_only() -> Model:
    terms = np.array([term_hash(t) for t in SEED_TERMS], np.uint64)
    return Model(terms, np.ones(len(terms)), np.array([0.0, 1.0, 1.0, 0.5, 0.0, -2.0]), (1.0, 0.0))


def choose(votes: np.ndarray, y: np.ndarray, most: int) -> list[int]:
    """Voters by greedy cover: each adds the most toxic rows that no earlier two hold, weighed against the clean rows it fires on."""
    chosen: list[int] = []
    times = np.zeros(len(votes))
    clean = votes[y == 0].sum(axis=0)
    total = votes.sum(axis=0)
    ok = (total - clean) / np.maximum(total, 1) >= 0.6
    while len(chosen) < most:
        gain = ((y == 1) & (times < 2)).astype(float) @ votes - 2 * clean
        gain[~ok] = -1
        gain[chosen] = -1
        k = int(np.argmax(gain)) if len(gain) else -1
        if k < 0 or gain[k] < 1:
            break
        chosen.append(k)
        times += votes[:, k]
    return chosen


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Without labelled rows of both classes the seed lexicon alone scores, with fixed weights."""
    sample = label_sample(labels, "toxic", most)
    if len({y for _, y in sample}) < 2:
        return _seeds_only()
    ids = F.broadcast(docs.sparkSession.createDataFrame(sample, f"doc_id {dict(labels.dtypes)['doc_id']}, y int"))
    rows = only_columns(docs, "doc_id", "text").join(ids, "doc_id").select("text", "y")
    toxic = sum(y for _, y in sample)
    least = max(2, toxic // 400)
    ratio = (F.col("toxic") + 0.1) / toxic / ((F.col("clean") + 0.5) / (len(sample) - toxic))
    share = toxic / len(sample)
    part = lambda n, p: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (F.col("toxic") + F.col("clean")) / p)).otherwise(0.0)
    surprise = part("toxic", share) + part("clean", 1 - share)
    best = _mine(rows).where((F.col("toxic") >= least) & (ratio >= 4) & (surprise >= SURPRISE)).orderBy((F.col("toxic") * F.log(ratio)).desc(), "term").limit(MOST_TERMS).collect()
    terms = np.unique(np.array([r.term for r in best] + [np.uint64(term_hash(t)).astype(np.int64) for t in SEED_TERMS], np.int64).view(np.uint64))
    hits = Hits(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            counts, doc, term = hits(b)
            rows_ = [term[doc == i].tolist() for i in range(b.num_rows)] if len(doc) else [[] for _ in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(counts.astype(np.int64)), pa.array(rows_, pa.list_(pa.int32()))], names=["y", "n", "hits"])

    got = rows.mapInArrow(tidy(run), "y int, n long, hits array<int>").collect()
    got.sort(key=lambda r: (r.y, r.n, r.hits))  # the same model whatever order the rows came in
    y, counts = np.array([r.y for r in got]), np.array([r.n for r in got])
    votes = np.zeros((len(got), len(terms)))
    for i, r in enumerate(got):
        votes[i, r.hits] = 1
    if not len(got) or not votes.any():
        return _seeds_only()
    chosen = choose(votes, y, MOST_VOTERS)
    seeds = np.flatnonzero(np.isin(terms, np.array([term_hash(t) for t in SEED_TERMS], np.uint64)))
    # Terms that the cover had no need of vote too where they are as pure: held-out texts may hold only those.
    clean, total = votes[y == 0].sum(axis=0), votes.sum(axis=0)
    pure = np.flatnonzero((total - clean >= least) & (clean <= 0.02 * total))
    use = np.array(sorted({*chosen, *seeds.tolist(), *pure.tolist()}))
    votes, terms = votes[:, use], terms[use]
    model = label_model(votes, min(max(y.mean(), 0.01), 0.99))
    weight = np.maximum(model.weight[:-1], 0)
    renumber = np.full(hits.sorted.shape, -1)
    renumber[use] = np.arange(len(use))
    doc = np.repeat(np.arange(len(got)), [len(r.hits) for r in got])
    term = renumber[np.array([h for r in got for h in r.hits], np.int64)]
    x = _features(counts, doc[term >= 0], term[term >= 0], weight)
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = _logistic(x, model.posterior(np.hstack([votes, votes.sum(axis=1, keepdims=True) == 0])), ridge=1.0)
    scale = _logistic(np.stack([x @ beta, np.ones(len(x))], axis=1), y.astype(float), ridge=1.0)
    return Model(terms, weight, beta, (float(scale[0]), float(scale[1])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` (with text) and ``toxicity``, a struct of score (double) and hits (long); a column of that name is replaced."""
    rows = wrapped(docs, F.col("`text`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(model.terms)
        for b in pieces(batches, "text"):
            p, n = model(hits, b)
            both = pa.StructArray.from_arrays([pa.array(p), pa.array(n.astype(np.int64))], names=["score", "hits"])
            yield pa.RecordBatch.from_arrays([b.column(0), both], names=["row", "toxicity"])

    scored = rows.mapInArrow(tidy(run), f"row {rows.schema['row'].dataType.simpleString()}, toxicity struct<score: double, hits: bigint>")
    return unwrapped(scored, docs.columns, toxicity=F.col("toxicity"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: toxic likelier), predicted (1 if score >= 0.3), hits.

    Labels of held-out rows are never read. Null and empty texts have no hit and get the score of such texts. Null ids are not held out;
    repeated rows are scored each. Nothing but the text enters a score.
    """
    scored = score(only_columns(docs, "doc_id", "text"), fit(docs, labels))
    p = F.col("toxicity.score")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), p.alias("score"), (p >= THRESHOLD).cast("int").alias("predicted"), F.col("toxicity.hits").alias("hits"))
