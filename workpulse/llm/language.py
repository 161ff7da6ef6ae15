"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (``GRAMS``, 2 ** ``BITS`` of them), weighted by log-damped counts
times inverse document frequency and scaled to unit length. Document frequencies are counted over all
documents to learn from. Weights are learned by follow-the-regularised-leader with an elastic net: its
L1 part leaves unhelpful weights at exactly zero. A temperature, fitted on sample rows that the weights
did not see, then calibrates the probabilities.

The classifier is fitted on a bounded sample: for each language the ``SAMPLE_PER_LANGUAGE`` learnable
rows that come first by a hash of id and text. Its size does not depend on the corpus; the document
frequencies and the predictions cover every row.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any learnable row
every text is ``und`` with score 0; a row with a null ``lang`` is not learned from; repeated rows are
learned from as they are; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import cut, sample_rows, text_or_empty
from workpulse.llm.grams import hashed_grams

GRAMS = (1, 2, 3)
BITS = 15
SAMPLE_PER_LANGUAGE = 1000
#: Most languages that a model may have; its size is languages x 2 ** BITS.
MOST_LANGUAGES = 500
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.05
UNDETERMINED = "und"


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text that occur, and how often."""
    grams = hashed_grams(text, GRAMS, BITS)
    if len(grams) < 1 << (BITS - 2):
        return np.unique(grams, return_counts=True)
    counts = np.bincount(grams, minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def unit_weights(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1.0 + np.log(counts)) * idf[found]
    length = np.sqrt((weights * weights).sum())
    return weights / length if length > 0 else weights


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Number of rows of ``text`` that have each feature, and in the last place the number of rows.

    Tasks count into one array each; the arrays are added up in a shuffle by feature. The result has
    2 ** BITS + 1 numbers, whatever the corpus.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((1 << BITS) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                total[gram_counts(text)[0]] += 1
            total[-1] += len(batch)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"feature": found, "n": total[found]})

    summed = texts.mapInPandas(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    result = np.zeros((1 << BITS) + 1, dtype=np.int64)
    for feature, n in summed.collect():
        result[feature] = n
    return result


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    return np.log((1.0 + counts[-1]) / (1.0 + counts[:-1])) + 1.0


def follow_the_leader(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features, classes) and intercepts by FTRL-proximal with an elastic net."""
    size = (1 << BITS) + 1
    z, squares = np.zeros((size, classes)), np.zeros((size, classes))

    def weights_at(index: np.ndarray) -> np.ndarray:
        zi = z[index]
        l1 = np.where(index == size - 1, 0.0, L1)[:, None]  # the intercept is not penalised
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(squares[index])) / ALPHA + L2))

    for _ in range(epochs):
        for found, values, label in rows:
            index, x = np.append(found, size - 1), np.append(values, 1.0)
            w = weights_at(index)
            scores = x @ w
            p = np.exp(scores - scores.max())
            p /= p.sum()
            p[label] -= 1.0
            gradient = x[:, None] * p[None, :]
            added = gradient * gradient
            sigma = (np.sqrt(squares[index] + added) - np.sqrt(squares[index])) / ALPHA
            z[index] += gradient - sigma * w
            squares[index] += added
    weights = weights_at(np.arange(size))
    return weights[:-1], weights[-1]


def log_loss(scores: np.ndarray, labels: np.ndarray, temperature: float) -> float:
    scaled = scores / temperature
    scaled = scaled - scaled.max(axis=1, keepdims=True)
    return float((np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(labels)), labels]).mean())


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0
    low, high, ratio = np.log(0.25), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if log_loss(scores, labels, np.exp(a)) < log_loss(scores, labels, np.exp(b)):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


class Model:
    """Learned languages, weights with the inverse frequencies, temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, intercepts: np.ndarray, temperature: float):
        self.languages, self.idf, self.temperature = languages, idf.astype(np.float32), temperature
        self.weights, self.intercepts = weights.astype(np.float32), intercepts

    def scores(self, found: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[found] + self.intercepts

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        found, counts = gram_counts(text)
        scaled = self.scores(found, unit_weights(found, counts, self.idf)) / self.temperature
        p = np.exp(scaled - scaled.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def fit(learnable: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from the rows (id, text, lang) of ``learnable``; null texts and languages are left out."""
    rows = learnable.where("text is not null and lang is not null")
    counts = document_frequencies(rows.select("text"))
    idf = inverse_frequencies(counts)
    sizes = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], idf, np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    sample = sample_rows(rows, "lang", {r["lang"]: r["count"] for r in sizes}, per_language, F.xxhash64("id", "text"))
    place = {name: i for i, name in enumerate(languages)}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [gram_counts(t) for t in batch["text"]]
            yield pd.DataFrame({
                "order": batch["_order"], "label": [place[x] for x in batch["lang"]],
                "found": [f.astype(np.int32) for f, _ in pairs],
                "counts": [c.astype(np.int32) for _, c in pairs],
            })

    schema = "order long, label int, found array<int>, counts array<int>"

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat([pd.DataFrame(columns=["order", "label", "found", "counts"]), *batches], ignore_index=True)
        frame = frame.sort_values("order", kind="stable")
        data = []
        for f, c, label in zip(frame["found"], frame["counts"], frame["label"], strict=True):
            found = np.asarray(f, dtype=np.int64)
            data.append((found, unit_weights(found, np.asarray(c), idf), int(label)))
        # every fifth row calibrates, the others teach
        teach = [x for i, x in enumerate(data) if i % 5 != 4] or data
        check = data[4::5]
        weights, intercepts = follow_the_leader(teach, len(languages))
        scores = np.array([x @ weights[f] + intercepts for f, x, _ in check]).reshape(len(check), len(languages))
        temperature = fit_temperature(scores, np.array([label for _, _, label in check], dtype=int))
        feature, label = np.nonzero(weights)
        yield pd.DataFrame({"feature": feature, "label": label, "weight": weights[feature, label]})
        yield pd.DataFrame({"feature": -1, "label": np.arange(len(languages)), "weight": intercepts})
        yield pd.DataFrame({"feature": [-2], "label": [0], "weight": [temperature]})

    # the sample is bounded by its parameter: one task learns from it
    learned = (
        cut(sample.mapInPandas(features, schema)).coalesce(1).mapInPandas(train, "feature long, label long, weight double").toPandas()
    )
    weights, intercepts = np.zeros((1 << BITS, len(languages))), np.zeros(len(languages))
    real, bias = learned[learned["feature"] >= 0], learned[learned["feature"] == -1]
    weights[real["feature"], real["label"]] = real["weight"]
    intercepts[bias["label"]] = bias["weight"]
    return Model(languages, idf, weights, intercepts, float(learned.loc[learned["feature"] == -2, "weight"].iloc[0]))


def predict(docs: DataFrame, model: Model, text: Column | str = "text") -> DataFrame:
    """``docs`` with the struct column ``language`` (lang, score) added."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        known = sent.value
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn("language", of(text_or_empty(text)))
