"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max index.

The classifier is fitted on a bounded sample of the labelled rows. Terms are chosen
by chi-square between term and label, examples become TF-IDF vectors, and their
inverted lists are cut into blocks of neighbouring examples with the largest weight
of each term in each block. For a text, a block's bound is the text's weights times
those maxima; blocks are scored exactly in order of their bounds until no bound
reaches the k-th best cosine, so the k nearest are exact. Their votes, weighted by
cosine and class share, are calibrated on other labelled rows by a monotone fit.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firesight.llm.common import table, texts_of, tune, whole_rows, written

#: Bounds of the fitted sample: examples per class, rows for calibration, terms.
EXAMPLES, CALIBRATION, TERMS = 2048, 4096, 2048
#: A term is used from this chi-square (1 degree of freedom) on: a chance of 1 in 10 million, as so many are tried.
CHI_SQUARE = 28.0
#: Besides words, their beginnings are terms, so that inflected and unseen forms count.
PREFIXES = (3, 4, 5, 6)
#: A term needs so many toxic examples, and so large a part of them.
SUPPORT, SUPPORT_SHARE = 5, 0.01
#: The term that stands for all words without a chosen term: it holds how thin the evidence is.
OTHER = ""
#: Words a worker remembers the terms of.
MEMORY_WORDS = 1 << 19
NEIGHBOURS = 16
#: Examples per block of the index.
BLOCK = 64
THRESHOLD = 0.3

_token = re.compile(r"\w+").findall


def tokens(text: bytes) -> list[str]:
    return _token(text.decode("utf-8", "replace").lower())


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, the latter marked by a hyphen."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


class Known(dict):
    """Word -> those of its terms that a model uses."""

    def __init__(self, terms):
        self.terms = terms

    def __missing__(self, word):
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = found = tuple(t for t in terms_of(word) if t in self.terms) or (OTHER,)
        return found

    def count(self, text: bytes) -> dict[str, int]:
        return Counter(chain.from_iterable(map(self.__getitem__, tokens(text))))


def held_out(doc_id: Column) -> Column:
    """True where labels must not be learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


class BlockMaxIndex:
    """Inverted lists of unit vectors with the largest weight per term and block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(vectors), block
        self.blocks = max(1, -(-self.n // block))
        term = np.concatenate([v[0] for v in vectors] or [np.array([], np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors])
        weight = np.concatenate([v[1] for v in vectors] or [np.array([])])
        order = np.lexsort((row, term))
        self.row, self.weight, term = row[order], weight[order], term[order]
        cell = term * self.blocks + self.row // block
        # self.at[t, b] .. self.at[t, b + 1]: the entries of term t in block b
        at = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)) if len(cell) else np.zeros(n_terms * self.blocks + 1, np.int64)
        self.first = at[:-1].reshape(n_terms, self.blocks)
        self.last = at[1:].reshape(n_terms, self.blocks)
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks)

    def scores(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Exact dot products with the examples of the blocks; 0 elsewhere."""
        first = self.first[terms][:, blocks]
        sizes = (self.last[terms][:, blocks] - first).ravel()
        total = int(sizes.sum())
        at = np.repeat(first.ravel() - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(total)
        q = np.repeat(np.repeat(weights, len(blocks)), sizes)
        return np.bincount(self.row[at], q * self.weight[at], minlength=self.n)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine over zero; equal cosines by place."""
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        head, rest = order[:4], order[4:]
        found = self.scores(terms, weights, head)
        best = np.partition(found, self.n - k)[self.n - k] if self.n > k else 0.0
        rest = rest[bound[rest] >= best - 1e-9]
        if len(rest):
            found += self.scores(terms, weights, rest)
        # rounded, so that equal vectors tie whatever the order of their sums
        found = np.round(found, 12)
        some = np.flatnonzero(found > 0)
        top = some[np.lexsort((some, -found[some]))][:k]
        return top, found[top]


def monotone(scores: np.ndarray, labels: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of the label rate by score, each pool smoothed by one prior row."""
    order = np.argsort(scores, kind="stable")
    x, pools = scores[order], []
    values, starts = np.unique(x, return_index=True)
    for i, s in enumerate(starts):
        e = starts[i + 1] if i + 1 < len(starts) else len(x)
        pools.append([float(labels[order[s:e]].sum()), e - s, values[i]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            hi = pools.pop()
            pools[-1] = [pools[-1][0] + hi[0], pools[-1][1] + hi[1], pools[-1][2]]
    at = np.array([p[2] for p in pools])
    rate = np.array([(p[0] + prior) / (p[1] + 1) for p in pools])
    return at, np.maximum.accumulate(rate) if len(rate) else rate


class Model:
    def __init__(self, terms: dict[str, int], idf: np.ndarray):
        self.terms, self.idf = terms, idf
        self.known: dict[int, tuple[float, np.ndarray]] = {}

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = sorted((self.terms[t], n) for t, n in counts.items() if t in self.terms)
        at = np.array([i for i, _ in ids], dtype=np.int64)
        w = (1 + np.log(np.array([n for _, n in ids], dtype=float))) * self.idf[at] if ids else np.array([])
        norm = np.sqrt((w * w).sum())
        return at, (w / norm if norm else w)

    def build(self, examples: list[tuple[int, int, dict[str, int]]], share: float) -> None:
        """examples: (id, label, counts); share: the toxic part of all labelled rows."""
        rows = [(i, y, self.vector(c)) for i, y, c in examples]
        # neighbours in the index are alike: by label, then heaviest term, then id
        rows.sort(key=lambda r: (r[1], int(r[2][0][np.argmax(r[2][1])]) if len(r[2][0]) else -1, r[0]))
        self.ids = np.array([r[0] for r in rows], dtype=np.int64)
        self.labels = np.array([r[1] for r in rows], dtype=np.int64)
        n1 = max(1, int(self.labels.sum()))
        n0 = max(1, len(rows) - int(self.labels.sum()))
        self.mass = np.where(self.labels == 1, share / n1, (1 - share) / n0)
        self.share, self.index = share, BlockMaxIndex([r[2] for r in rows], len(self.idf))
        self.at, self.rate = np.array([]), np.array([])
        self.without = share

    def vote(self, counts: dict[str, int]) -> tuple[float, np.ndarray]:
        """Distance-weighted share of toxic neighbours, and the neighbours; -1 without evidence."""
        at, w = self.vector(counts)
        if not len(at):
            return -1.0, at
        if len(at) == 1 and int(at[0]) in self.known:  # a vector of one term is the same for all texts
            return self.known[int(at[0])]
        top, cos = self.index.nearest(at, w, NEIGHBOURS)
        if not len(top):
            return -1.0, top
        mass = self.mass[top] * cos / (1.01 - np.minimum(cos, 1.0)) ** 0.5
        found = float((mass * self.labels[top]).sum() / mass.sum()), top
        if len(at) == 1:
            self.known[int(at[0])] = found
        return found

    def calibrate(self, rows: list[tuple[int, dict[str, int]]]) -> None:
        votes = np.array([self.vote(c)[0] for _, c in rows])
        labels = np.array([y for y, _ in rows], dtype=float)
        bare = votes < 0
        self.without = (labels[bare].sum() + self.share) / (bare.sum() + 1)
        if (~bare).any():
            self.at, self.rate = monotone(votes[~bare], labels[~bare], self.share)

    def score(self, counts: dict[str, int]) -> tuple[float, np.ndarray]:
        vote, top = self.vote(counts)
        if vote < 0:
            return float(self.without), top
        if not len(self.at):
            return vote, top
        # between two fitted points the rate is interpolated
        return float(np.interp(vote, self.at, self.rate)), top


def _counted(sample: DataFrame, known: Known | None = None) -> DataFrame:
    """(_id, _y, _part, counts) of a bounded sample: the counts of all terms, or of a model's."""
    def run(batches):
        for batch in batches:
            counts = [known.count(t) if known is not None else Counter(chain.from_iterable(map(terms_of, tokens(t))))
                      for t in texts_of(batch, "_t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_y"), batch.column("_part"),
                 pa.array([list(c.items()) for c in counts], pa.map_(pa.string(), pa.int32()))],
                names=["_id", "_y", "_part", "counts"])

    return sample.mapInArrow(run, "_id long, _y int, _part int, counts map<string,int>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        examples: int = EXAMPLES, calibration: int = CALIBRATION) -> Model:
    """The model from at most ``examples`` rows per class and ``calibration`` further rows.

    Rows are taken by MD5 of their id, so the sample doesn't depend on the table's order. A row
    that is labelled twice is toxic if either label says so; null labels and ids are left out.
    """
    y = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_y")).filter(
        F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id"))).groupBy("_id").agg(
        (F.max("_y") > 0).cast("int").alias("_y")).withColumn("_at", F.md5(F.col("_id").cast("string")))
    n, pos = y.agg(F.count("*"), F.sum("_y")).first()
    share = (pos or 0) / n if n else 0.0
    # a quarter of the rows is for calibration only, in their natural shares
    apart = F.substring("_at", 32, 1).isin(list("cdef"))
    parts = [y.filter((F.col("_y") == v) & ~apart).orderBy("_at").limit(examples).withColumn("_part", F.lit(0)) for v in (0, 1)]
    rest = y.filter(apart).orderBy("_at").limit(calibration).withColumn("_part", F.lit(1))
    sample = parts[0].unionAll(parts[1]).unionAll(rest).select("_id", "_y", "_part")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_t"))
    # at most 2 * examples + calibration rows: small whatever the tables hold
    taken = texts.join(F.broadcast(sample), "_id").groupBy("_id", "_y", "_part").agg(F.min("_t").alias("_t"))
    taken = written(taken.select("_id", "_y", "_part", "_t"), "toxicity-sample")
    n1, n0 = (taken.filter((F.col("_part") == 0) & (F.col("_y") == v)).count() for v in (1, 0))
    chosen = []
    if n1 and n0:
        terms = (_counted(taken.filter("_part = 0")).select("_y", F.explode(F.map_keys("counts")).alias("term"))
                 .groupBy("term").agg(F.sum("_y").alias("a"), F.count("*").alias("d"))
                 .filter(F.col("a") >= max(SUPPORT, SUPPORT_SHARE * n1)))
        a, b = F.col("a").cast("double"), (F.col("d") - F.col("a")).cast("double")
        terms = terms.withColumn("x", F.lit(float(n1 + n0)) * F.pow(a * (n0 - b) - b * (n1 - a), 2) / (
            F.lit(float(n1)) * n0 * F.col("d") * F.greatest(F.lit(1e-9), n1 + n0 - F.col("d"))))
        chosen = (terms.filter((F.col("x") >= CHI_SQUARE) & (a * n0 > b * n1)).orderBy(F.desc("x"), "term")
                  .limit(TERMS - 1).select("term", "d").collect())
    names, rows = [*(r.term for r in chosen), OTHER], np.array([*(r.d for r in chosen), n1 + n0], dtype=float)
    model = Model({t: i for i, t in enumerate(names)}, np.log1p((n1 + n0) / np.maximum(1.0, rows)))
    got = _counted(taken, Known(model.terms)).orderBy("_id", "_part").collect()
    model.build([(r._id, r._y, r.counts) for r in got if r._part == 0], share)
    model.calibrate([(r._y, r.counts) for r in got if r._part == 1])
    return model


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold."""
    rows = docs.select(whole_rows(docs).alias("_row"), F.col(text).alias("_text"))
    return score(rows, model, "_text", keep=("_row",)).filter("predicted = 0").select("_row.*")


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: the columns in ``keep``, ``score``, ``predicted`` and ``evidence``.

    ``evidence`` holds the ids of up to three nearest examples. Null and empty texts and texts
    without any of the model's terms get the rate of such rows. Only the text enters the score.
    Nulls in ``keep`` and repeated rows are passed on; empty input gives no rows.
    """
    tune(docs.sparkSession)
    names = [f"_keep{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("_t"))

    def run(batches):
        known = Known(model.terms)
        for batch in batches:
            scores, near = [], []
            for t in texts_of(batch, "_t"):
                s, top = model.score(known.count(t))
                scores.append(min(1.0, max(0.0, s)))
                near.append(model.ids[top[:3]].tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(near, pa.list_(pa.int64()))],
                names=[*names, "score", "predicted", "evidence"])

    schema = rows.drop("_t").schema.add("score", "double").add("predicted", "integer").add(
        "evidence", T.ArrayType(T.LongType()))
    return rows.mapInArrow(run, schema).toDF(*keep, "score", "predicted", "evidence")


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")
