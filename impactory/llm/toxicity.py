"""Toxicity by a classifier chain: categories in sequence, earlier probabilities feeding later models.

Features are presence of words, of word beginnings (PREFIXES letters), and of beginnings that several
different words of the text share. Indicators are the features
that mark toxic rows in the labelled sample. The table labels only toxic or not, so the first two
categories are weak labels drawn from those indicators:

    explicit  toxic, and holds an indicator word
    coded     toxic, and holds an indicator beginning that many different words share
    toxic     the label itself

Each category is a logistic model over the indicators and the probabilities of the categories before
it. In training those are out-of-fold predictions (FOLDS folds), so that a later model doesn't trust
an earlier one more than it may in use. A document is rejected at a toxic probability of REJECT or more.

Rows: a null or empty text has no feature and gets the chain's base probabilities; very long texts are
read whole; repeated rows and ties are scored alike (in the fit one row stands for an id, the one with the
smallest hash of the text); null labels are ignored; without toxic labels every probability is 0. Extra
columns, whatever their names, are carried or ignored, never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, one_row_each, small_batches, small_tables, within

CATEGORIES = ("explicit", "coded", "toxic")
PREFIXES = (4, 5, 6, 7)
#: Bounds of the fit: labelled rows, bytes of their distinct words, indicators of each kind (the most frequent ones).
SAMPLE_ROWS, WORD_BYTES, INDICATORS = 5_000, 60_000_000, 120
#: An indicator occurs in so many toxic rows and in such a share of them at least, and is so many times likelier there.
LEAST_ROWS, LEAST_SHARE, LEAST_LIFT = 3, 0.007, 20.0
#: A coded beginning is shared by so many different words at least.
LEAST_FORMS = 3
FOLDS, REJECT = 5, 0.6
WORD = re.compile(r"[^\W\d_]+")
RESULT = T.StructType([T.StructField(c, T.DoubleType()) for c in CATEGORIES])


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """w: words, p: beginnings, q: beginnings of two words or more."""
    out = {f"w:{w}" for w in words}
    for n in PREFIXES:
        begun = Counter(w[:n] for w in words if len(w) > n)
        out |= {f"p:{p}" for p in begun}
        out |= {f"q:{p}" for p, k in begun.items() if k > 1}
    return out


@dataclass
class Model:
    indicators: dict[str, int]
    weights: list[np.ndarray]  # for each category: intercept, indicators, earlier categories

    def predict(self, found: list[list[int]]) -> np.ndarray:
        """Probabilities (rows, categories) from the indicators that each row holds."""
        out = np.zeros((len(found), len(CATEGORIES)))
        if not self.weights:
            return out
        x = dense(found, len(self.indicators))
        for k, w in enumerate(self.weights):
            out[:, k] = sigmoid(np.column_stack([x, out[:, :k]]) @ w[1:] + w[0])
        return out


def dense(found: list[list[int]], n: int) -> np.ndarray:
    x = np.zeros((len(found), n))
    for i, row in enumerate(found):
        x[i, row] = 1.0
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton's steps; the intercept comes first and isn't shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    w[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Sample:
    """Labelled rows as the places of those candidate features that they hold; the words behind the beginnings in toxic rows."""

    names: list[str]
    held: list[np.ndarray]
    forms: list[list[tuple[str, str]]]
    toxic: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, str, int]]) -> Sample:
        """Candidates are features of LEAST_ROWS toxic rows or more: a fold can't select others."""
        inside: Counter = Counter()
        for _, words, y in rows:
            if y:
                inside.update(features_of(set(words.split())))
        names = sorted(f for f, k in inside.items() if k >= LEAST_ROWS)
        place = {f: i for i, f in enumerate(names)}
        begun = {f[2:] for f in names if f[0] != "w"}
        held, forms = [], []
        for _, words, y in rows:
            own = set(words.split())
            held.append(np.array(sorted(place[f] for f in features_of(own) if f in place), np.int32))
            forms.append([(w[:n], w) for w in own for n in PREFIXES if len(w) > n and w[:n] in begun] if y else [])
        return cls(names, held, forms, np.array([bool(y) for _, _, y in rows]))

    def select(self, rows: np.ndarray) -> tuple[list[int], int]:
        """The indicators that a part of the rows yields, words first, and how many of them are words."""

        def counts(some: np.ndarray) -> np.ndarray:
            return np.bincount(np.concatenate([np.zeros(0, np.int32), *(self.held[i] for i in some)]), minlength=len(self.names))

        yes, no = rows[self.toxic[rows]], rows[~self.toxic[rows]]
        inside, outside = counts(yes), counts(no)
        lift = inside / (outside + 0.5) * (len(no) + 1) / (len(yes) + 1)
        marks = np.flatnonzero((inside >= max(LEAST_ROWS, LEAST_SHARE * len(yes))) & (lift >= LEAST_LIFT))
        marks = marks[np.argsort(-inside[marks], kind="stable")].tolist()
        forms: dict[str, set[str]] = defaultdict(set)
        for i in yes:
            for begun, word in self.forms[i]:
                forms[begun].add(word)
        explicit = [k for k in marks if self.names[k][0] == "w"][:INDICATORS]
        coded = [k for k in marks if self.names[k][0] != "w" and len(forms[self.names[k][2:]]) >= LEAST_FORMS][: 2 * INDICATORS]
        return [*explicit, *coded], len(explicit)

    def inputs(self, chosen: list[int], n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Of all rows: presence of the chosen features, and the targets of the categories."""
        at = np.full(len(self.names), -1)
        at[chosen] = np.arange(len(chosen))
        x = dense([at[h][at[h] >= 0] for h in self.held], len(chosen))
        has = np.stack([x[:, :n_words].any(axis=1), x[:, n_words:].any(axis=1), np.ones(len(x), bool)])
        return x, (has & self.toxic).astype(float)


def train(rows: list[tuple[int, str, int]]) -> Model:
    """rows: (fold key, distinct words joined by blanks, toxic).

    Indicators are selected anew from each fold's training rows, and so are the weak labels that rest on
    them: what a row's own label says never enters its out-of-fold predictions. The model that is returned
    selects from all rows.
    """
    toxic = sum(r[2] for r in rows)
    if not toxic or toxic == len(rows):
        return Model({}, [])
    sample, fold = Sample.of(rows), np.array([r[0] % FOLDS for r in rows])
    parts = []
    for k in range(FOLDS):
        mine, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(mine) and len(others):
            parts.append((mine, others, *sample.inputs(*sample.select(others))))
    chosen, n_words = sample.select(np.arange(len(rows)))
    x, target = sample.inputs(chosen, n_words)
    weights, earlier = [], np.zeros((len(rows), 0))
    for c in range(len(CATEGORIES)):
        oof = np.zeros(len(rows))
        for mine, others, own, wanted in parts:
            seen = np.column_stack([own, earlier])
            w = logistic(seen[others], wanted[c][others])
            oof[mine] = sigmoid(seen[mine] @ w[1:] + w[0])
        weights.append(logistic(np.column_stack([x, earlier]), target[c]))
        earlier = np.column_stack([earlier, oof])
    return Model({sample.names[k]: i for i, k in enumerate(chosen)}, weights)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """From docs (doc_id, text) and labels (doc_id, toxic); the sample is the labelled rows with the smallest hash."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))  # at most sample_rows rows of two numbers

    def bags(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "words": [" ".join(sorted(words_of(t))) for t in f["text"]], "toxic": f["toxic"]})

    rows = one_row_each(docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")))
    got = within(rows.mapInPandas(bags, "doc_id long, words string, toxic int"), "words", WORD_BYTES)
    got.sort(key=lambda r: (r["doc_id"], r["words"]))
    return train([(zlib.crc32(r["words"].encode()), r["words"], int(r["toxic"] > 0)) for r in got])


def probabilities(spark: SparkSession, text: Column, model: Model) -> Column:
    """A struct column with a probability for each category."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        one, two, all_words = ({f[2:]: i for f, i in m.indicators.items() if f[0] == kind} for kind in "pqw")

        class Marks(dict):
            """The indicators of the words in a piece of text, and the beginnings that count; most pieces have none."""

            def __missing__(self, piece: str) -> tuple:
                if len(self) > 300_000:
                    self.clear()
                out = []
                for word in WORD.findall(piece):
                    begun = [word[:n] for n in PREFIXES if len(word) > n]
                    hits = [all_words[word]] if word in all_words else []
                    hits += [one[p] for p in begun if p in one]
                    pairs = [two[p] for p in begun if p in two]
                    if hits or pairs:
                        out.append((word, hits, pairs))
                self[piece] = out = tuple(out)
                return out

        marks = Marks()
        for texts in batches:
            found = []
            for text_ in texts:
                hits: set[int] = set()
                begun: dict[int, set[str]] = defaultdict(set)
                if text_:
                    for some in map(marks.__getitem__, set(text_.lower().split())):
                        for word, own, pairs in some:
                            hits.update(own)
                            for k in pairs:
                                begun[k].add(word)
                hits.update(k for k, words in begun.items() if len(words) > 1)
                found.append(sorted(hits))
            yield pd.DataFrame(m.predict(found), columns=list(CATEGORIES))

    return predict(text)


def model_for(spark: SparkSession, sf_dir: str) -> Model:
    return fit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's category probabilities, and whether it is rejected."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.select("doc_id", probabilities(spark, F.col("text"), model_for(spark, sf_dir)).alias("p"))
    return scored.select("doc_id", *(F.col(f"p.{c}").alias(f"p_{c}") for c in CATEGORIES), (F.col("p.toxic") >= REJECT).cast("int").alias("toxic"))


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A pipeline stage: docs without those that are rejected, columns as they were."""
    small_tables(spark)
    return docs.where(probabilities(spark, docs["text"], model_for(spark, sf_dir))["toxic"] < REJECT)
