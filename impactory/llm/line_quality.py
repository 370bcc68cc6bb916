"""Document quality from a linear-chain conditional random field over lines.

Every line has features of itself and of the lines before and after it (binned shares of capitals,
symbols, bars and repeated words, and its length). The field has the states bad and good; forward
and backward sums give each line's marginal of good. A document's raw quality is the mean marginal
weighted by line length (plus one, so that empty lines count a little); a logistic curve, fitted on
the training documents, turns it into the score.

Only documents are labelled, so lines are labelled weakly: first by their document, then, for ROUNDS
rounds, the lines of bad documents that the field itself finds good are relabelled, all but the worst.

Rows: null and empty texts are one empty line; very long texts are read whole; repeated rows and ties
score alike (in the fit one row stands for an id, the one with the smallest hash of the text); null labels
are ignored; with labels of one kind only, the score is that label's. Extra columns are never read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_column, load, one_row_each, small_batches, small_tables, within

#: Bound of the fit: labelled rows; and the bytes of line features taken in by the driver.
SAMPLE_ROWS, FEATURE_BYTES = 4000, 50_000_000
KEEP, ROUNDS, STEPS = 0.3, 2, 60
#: Edges of the bins: fixed values.
SHARES = np.array([0.02, 0.08, 0.15, 0.3, 0.5, 0.7])
LENGTHS = np.array([1, 12, 40, 100, 250, 800])
KINDS = 5  # capitals, symbols, bars, repeated words, length
BINS = 7
WIDTH = 3 * KINDS * BINS + 2  # this line, the one before, the one after; first, last


@functools.cache
def classes() -> np.ndarray:
    """For all code points: 1 letter, and 2 more if capital; 4 digit, 8 white space, 16 other."""
    out = np.full(0x110000, 16, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            out[i] = 1 + 2 * c.isupper()
        elif c.isdigit():
            out[i] = 4
        elif c.isspace():
            out[i] = 8
    return out


def line_bins(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts: bins (lines, KINDS), lengths of lines, lines of each text."""
    lines = [t.split("\n") for t in texts]
    n_lines = np.array([len(x) for x in lines])
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(codes == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    kind = classes()[codes]

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return sums[ends] - sums[starts]

    letters, capitals = count(kind & 1 > 0), count(kind & 2 > 0)
    other, bars = count(kind == 16), count(codes == 124)
    plain = count((codes == 44) | (codes == 46) | (codes == 39) | (codes == 45) | (codes == 34))
    repeated = np.fromiter((1 - len(set(w)) / len(w) if len(w := x.split()) > 3 else 0.0 for t in lines for x in t), float, len(ends))
    long = np.maximum(lengths, 1)
    shares = [capitals / np.maximum(letters, 1), (other - plain) / long, bars * 5 / long, repeated]
    return np.stack([*(np.searchsorted(SHARES, s, "right") for s in shares), np.searchsorted(LENGTHS, lengths, "right")], 1).astype(np.uint8), lengths, n_lines


def feature_ids(bins: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
    """Active features (lines, 3 KINDS + 2) as places in the weights; WIDTH stands for none."""
    own = bins.astype(np.int32) + np.arange(KINDS, dtype=np.int32) * BINS
    last = np.cumsum(n_lines) - 1
    first = last - n_lines + 1
    none = np.full((1, KINDS), WIDTH, np.int32)
    before = np.concatenate([none, own[:-1] + KINDS * BINS])
    after = np.concatenate([own[1:] + 2 * KINDS * BINS, none])
    before[first] = WIDTH
    after[last] = WIDTH
    edge = np.full((len(own), 2), WIDTH, np.int32)
    edge[first, 0], edge[last, 1] = WIDTH - 2, WIDTH - 1
    return np.concatenate([own, before, after, edge], 1)


@dataclass
class Field:
    weights: np.ndarray  # (WIDTH + 1, 2); the last row stays zero
    moves: np.ndarray  # (2, 2), from and to
    slope: float = 8.0
    middle: float = 0.5

    def marginals(self, ids: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of good for each line; of pairs of states, summed; log partition of each text. All chains advance together."""
        scores = self.weights[ids].sum(axis=1)
        order = np.argsort(-n_lines, kind="stable")
        sizes, starts = n_lines[order], (np.cumsum(n_lines) - n_lines)[order]
        most = int(sizes[0]) if len(sizes) else 0
        alive = np.searchsorted(-sizes, -np.arange(most), "left")  # chains that have a line at each step
        ahead, back = np.zeros_like(scores), np.zeros_like(scores)
        if most:
            ahead[starts] = scores[starts]
        for t in range(1, most):
            at = starts[: alive[t]] + t
            into = ahead[at - 1][:, :, None] + self.moves
            ahead[at] = np.logaddexp(into[:, 0], into[:, 1]) + scores[at]
        for t in range(most - 1, 0, -1):
            at = starts[: alive[t]] + t
            out = self.moves + (scores[at] + back[at])[:, None, :]
            back[at - 1] = np.logaddexp(out[:, :, 0], out[:, :, 1])
        whole = np.logaddexp(*(ahead + back).T)
        pairs = np.zeros((2, 2))
        inner = np.ones(len(scores), bool)
        inner[np.cumsum(n_lines) - n_lines] = False
        at = np.flatnonzero(inner)
        if len(at):
            pairs = np.exp(ahead[at - 1][:, :, None] + self.moves + (scores[at] + back[at])[:, None, :] - whole[at][:, None, None]).sum(axis=0)
        return np.exp((ahead + back)[:, 1] - whole), pairs, whole

    def raw(self, good: np.ndarray, lengths: np.ndarray, n_lines: np.ndarray) -> np.ndarray:
        starts = np.cumsum(n_lines) - n_lines
        weight = lengths + 1.0
        return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts) if len(n_lines) else np.zeros(0)

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        bins, lengths, n_lines = line_bins(texts)
        raw = self.raw(self.marginals(feature_ids(bins, n_lines), n_lines)[0], lengths, n_lines)
        return 1 / (1 + np.exp(-np.clip(self.slope * (raw - self.middle), -40, 40)))


def learn(ids: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, field: Field) -> Field:
    """Ascent of the conditional likelihood of the line labels, by Adam over the whole sample."""
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(n_lines) - n_lines] = False
    at = np.flatnonzero(inner)
    want_moves = np.zeros((2, 2))
    np.add.at(want_moves, (labels[at - 1], labels[at]), 1)
    params, grads = [field.weights, field.moves], [None, None]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat = ids.ravel()
    for step in range(1, STEPS + 1):
        good, pairs, _ = field.marginals(ids, n_lines)
        off = np.repeat(labels - good, ids.shape[1])
        up = np.bincount(flat, off, WIDTH + 1) / len(ids)
        grads = [np.stack([-up, up], 1) - 1e-4 * params[0], (want_moves - pairs) / len(ids) - 1e-4 * params[1]]
        for k, g in enumerate(grads):
            m[k] = 0.8 * m[k] + 0.2 * g
            v[k] = 0.95 * v[k] + 0.05 * g * g
            params[k] += 0.2 * (m[k] / (1 - 0.8**step)) / (np.sqrt(v[k] / (1 - 0.95**step)) + 1e-8)
        field.weights[WIDTH] = 0
    return field


def train(bins: np.ndarray, lengths: np.ndarray, n_lines: np.ndarray, quality: np.ndarray) -> Field:
    field = Field(np.zeros((WIDTH + 1, 2)), np.zeros((2, 2)))
    if not len(quality) or quality.min() == quality.max():
        field.slope, field.middle = 0.0, 0.0
        if len(quality):
            field.slope, field.middle = 40.0, (-1.0 if quality[0] else 2.0)
        return field
    ids, doc = feature_ids(bins, n_lines), np.repeat(np.arange(len(n_lines)), n_lines)
    labels = quality[doc].astype(int)
    for k in range(ROUNDS + 1):
        field = learn(ids, n_lines, labels, field)
        good = field.marginals(ids, n_lines)[0]
        if k < ROUNDS:
            worst = np.minimum.reduceat(good, np.cumsum(n_lines) - n_lines)[doc]
            labels = np.where(quality[doc] == 1, 1, ((good > 0.5) & (good > worst)).astype(int))
    raw, y = field.raw(good, lengths, n_lines), quality.astype(float)
    w = np.zeros(2)
    x = np.stack([raw, np.ones_like(raw)], 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w += np.clip(np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * w), -3, 3)
    field.slope, field.middle = float(w[0]), float(-w[1] / w[0]) if w[0] else 0.5
    return field


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """From docs (doc_id, text) and labels (doc_id, quality); the sample is the labelled rows with the smallest hash."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))  # at most sample_rows rows of two numbers

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                bins, lengths, n = line_bins([t or "" for t in f["text"]])
                cut = np.cumsum(n)[:-1]
                yield pd.DataFrame({"doc_id": f["doc_id"], "quality": f["quality"], "bins": [b.tobytes() for b in np.split(bins, cut)], "lengths": [x.astype(np.int32).tobytes() for x in np.split(lengths, cut)]})

    rows = one_row_each(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality")))
    parts = within(rows.mapInPandas(lines, "doc_id long, quality int, bins binary, lengths binary"), "bins", FEATURE_BYTES)
    parts.sort(key=lambda r: (r["doc_id"], r["bins"]))
    if not parts:
        return train(np.zeros((0, KINDS), np.uint8), np.zeros(0), np.zeros(0, int), np.zeros(0, int))
    bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, KINDS) for r in parts])
    lengths = [np.frombuffer(r["lengths"], np.int32) for r in parts]
    return train(bins, np.concatenate(lengths), np.array([len(x) for x in lengths]), np.array([int(r["quality"] > 0) for r in parts]))


def quality(spark: SparkSession, text: Column, field: Field) -> Column:
    """A column with the quality score of a text column."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score([t or "" for t in texts]))

    return score(text)


def model_for(spark: SparkSession, sf_dir: str) -> Field:
    """Learns from rows whose fold of 5 is not 0."""
    docs = load(spark, sf_dir, "documents")
    return fit(docs.where(fold_column("doc_id", 5) != 0), load(spark, sf_dir, "labels").where(fold_column("doc_id", 5) != 0))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score and whether it is kept."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.select("doc_id", (fold_column("doc_id", 5) == 0).alias("held_out"), quality(spark, F.col("text"), model_for(spark, sf_dir)).alias("score"))
    return scored.select("*", (F.col("score") >= KEEP).cast("int").alias("predicted"))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A pipeline stage: docs whose score is at least KEEP, columns as they were."""
    small_tables(spark)
    return docs.where(quality(spark, docs["text"], model_for(spark, sf_dir)) >= KEEP)
