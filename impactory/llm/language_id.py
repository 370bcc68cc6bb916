"""Language identification by words first, then ever shorter character n-grams.

Fit counts words and character n-grams per language on a bounded sample of labelled rows. A known
word contributes its log frequency in each language; an unseen word backs off to its n-grams of the
longest length of which at least one is known (NGRAMS, longest first); one of unknown letters
contributes nothing. The per-language sums give the prediction, a tempered softmax the score.

Rows: null texts, empty ones and texts without a letter (as Unicode has it) give ``und`` with score 0; ties go to the language that
sorts first; repeated rows are scored alike; with no labelled row every text is ``und``. Whole texts
are scored. Only the text column is read, so other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fold_column, load, materialize, small_batches

UND = "und"
#: Character n-gram lengths of the backoff, longest first; words are padded with a blank at both ends.
NGRAMS = (4, 3, 2, 1)
#: Bounds of the fit: languages (the most frequent ones), labelled rows of each, and its most frequent words and n-grams of each length.
LANGS = 1000
SAMPLE_ROWS, WORDS_PER_LANG, GRAMS_PER_LANG = 800, 100_000, 40_000
CACHE = 300_000
WORD = re.compile(r"[^\W\d_]+")
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def has_letter(words: list[str]) -> bool:
    """The pattern's words may be of fractions, superscripts and the like alone, which are no letters."""
    return any(w.isalpha() or any(c.isalpha() for c in w) for w in words)


@dataclass
class Model:
    """units[n] gives the row of a word (n = 0) or n-gram in tables[n]: log frequencies per language, less their mean."""

    langs: list[str]
    units: dict[int, dict[str, int]]
    tables: dict[int, np.ndarray]

    def scorer(self):
        """A function from a word to its list of scores; zeros where no backoff level knows the word."""
        rows = {n: t.tolist() for n, t in self.tables.items()}
        words, levels = self.units[0], [(n, self.units[n], rows[n]) for n in NGRAMS]
        nothing = [0.0] * len(self.langs)

        def score(word: str) -> list[float]:
            if (i := words.get(word)) is not None:
                return rows[0][i]
            padded = f" {word} "
            for n, units, table in levels:
                found = [table[units[g]] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in units]
                if found:
                    k = 1.0 / len(found)
                    return [sum(x) * k for x in zip(*found, strict=True)]
            return nothing

        return score


def _counts(sample: DataFrame) -> DataFrame:
    """(lang, n, unit, count): words as n = 0 and n-grams, counted on the executors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = defaultdict(Counter)
        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"], strict=True):
                words[lang].update(WORD.findall(text.lower()))
        rows: Counter = Counter()
        for lang, counts in words.items():
            for word, k in counts.items():
                rows[lang, 0, word] += k
                padded = f" {word} "
                for n in NGRAMS:
                    for i in range(len(padded) - n + 1):
                        rows[lang, n, padded[i : i + n]] += k
        keys = list(rows)
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pd.DataFrame({"lang": [k[0] for k in part], "n": [k[1] for k in part], "unit": [k[2] for k in part], "k": [rows[k] for k in part]})

    return sample.mapInPandas(run, "lang string, n int, unit string, k long").groupBy("lang", "n", "unit").agg(F.sum("k").alias("k"))


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """From columns doc_id, text, lang; of each language the sample is a share of the rows, by hash, that makes about sample_rows."""
    small_batches(docs.sparkSession)
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("rows"))
    share = sizes.orderBy(F.desc("rows"), "lang").limit(LANGS).select("lang", F.least(F.lit(1.0), 0.9 * sample_rows / F.col("rows")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    drawn = rows.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("text", "lang")
    counts = materialize(_counts(drawn), "language-counts")
    if counts.isEmpty():
        discard(counts)
        return Model([], {n: {} for n in (0, *NGRAMS)}, {n: np.zeros((0, 0)) for n in (0, *NGRAMS)})
    groups = Window.partitionBy("lang", "n")
    ranked = counts.select("*", F.row_number().over(groups.orderBy(F.desc("k"), "unit")).alias("r"), F.sum("k").over(groups).alias("total"))
    top = ranked.where(F.col("r") <= F.when(F.col("n") == 0, WORDS_PER_LANG).otherwise(GRAMS_PER_LANG)).toArrow().to_pylist()
    discard(counts)
    totals = {(r["lang"], r["n"]): r["total"] for r in top}
    langs = sorted({lang for lang, _ in totals})
    at = {lang: i for i, lang in enumerate(langs)}
    units: dict[int, dict[str, int]] = {n: {} for n in (0, *NGRAMS)}
    for r in top:
        units[r["n"]].setdefault(r["unit"], len(units[r["n"]]))
    tables = {n: np.full((len(u), len(langs)), 0.5) for n, u in units.items()}
    for r in top:
        tables[r["n"]][units[r["n"]][r["unit"]], at[r["lang"]]] += r["k"]
    for n, table in tables.items():
        table[:] = np.log(table / (np.array([totals.get((lang, n), 0) for lang in langs]) + 0.5 * (len(table) + 1)))
        table -= table.mean(axis=1, keepdims=True)
    return Model(langs, units, tables)


def identify(docs: DataFrame, text: Column, model: Model) -> Column:
    """A struct column (lang_pred, score) for a text column."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: Model = shared.value
        rows, score = np.zeros((2 * CACHE + 1, max(1, len(m.langs)))), m.scorer()

        class Places(dict):
            def __missing__(self, word: str) -> int:
                i = self[word] = len(self)
                rows[i] = score(word)
                return i

        known = Places()
        place = known.__getitem__
        for texts in batches:
            langs, scores = [], []
            for one in texts:
                words = WORD.findall(one.lower()) if one else []
                if not m.langs or not has_letter(words):
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                total = np.zeros(len(m.langs))
                for start in range(0, len(words), CACHE):
                    part = words[start : start + CACHE]
                    if len(known) > CACHE:
                        known.clear()
                    total += rows[np.fromiter(map(place, part), np.int64, len(part))].sum(axis=0)
                total /= np.sqrt(len(words))
                p = np.exp(total - total.max())
                best = int(np.argmax(total))
                langs.append(m.langs[best])
                scores.append(float(p[best] / p.sum()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict(text)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """Every document's language; learns from rows whose fold of 4 is not 2."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(fold_column("doc_id", 4) != 2))
    return docs.select("doc_id", (fold_column("doc_id", 4) == 2).alias("held_out"), identify(docs, F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")
