"""The scores of the toxicity model, worked out again from their definition."""

import math
import random

import numpy as np
import pytest

from workpulse.llm import toxicity as T
from workpulse.llm.grams import hashed_grams


def table(noise):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(12)) + (" horrible insult" if i % 4 == 0 else "")) for i in range(400)]
    labels = [(i, int(i % 4 == 0) ^ int(rng.random() < noise)) for i in range(400)]
    return rows, labels


def grams(text):
    found, counts = np.unique(hashed_grams(text, T.GRAMS, T.BITS), return_counts=True)
    return dict(zip(found.tolist(), counts.tolist(), strict=True))


class Plain:
    """Every cosine, the nearest by a sort, votes and score, in plain Python."""

    def __init__(self, model, rows, labels, is_learnable):
        self.model = model
        terms = set(model.index.terms.tolist())
        known = [{t: c for t, c in grams(text).items() if t in terms} for _, text in rows]
        self.idf = {t: math.log((1 + len(rows)) / (1 + sum(t in k for k in known))) + 1 for t in terms}
        texts, marks = dict(rows), {i: y for i, y in labels if is_learnable(i)}
        self.ids = [int(i) for i in model.index.ids]
        self.examples = [(self.vector(texts[i]), marks[i]) for i in self.ids]
        self.share = sum(marks.values()) / len(marks)
        rows_of = [sum(y == k for y in marks.values()) / sum(y == k for _, y in self.examples) for k in (0, 1)]
        mean = sum(rows_of[y] for _, y in self.examples) / len(self.examples)
        self.worth = [w / mean for w in rows_of]

    def vector(self, text):
        weights = {t: (1 + math.log(c)) * self.idf[t] for t, c in grams(text).items() if t in self.idf}
        length = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / length for t, w in weights.items()}

    def score(self, text):
        own = self.vector(text)
        cosines = [(sum(w * v.get(t, 0.0) for t, w in own.items()), k) for k, (v, _) in enumerate(self.examples)]
        near = sorted((-round(c, 12), k) for c, k in cosines if c > 0)[: T.NEIGHBOURS]
        if not near:
            return None
        votes = [1 - self.share, self.share]
        for c, k in near:
            label = self.examples[k][1]
            votes[label] += self.worth[label] / (1 - min(-c, 1.0) + T.NEAR)
        odds = math.log(votes[1] / votes[0])
        return 1 / (1 + math.exp(-(self.model.slope * odds + self.model.offset)))


# with few examples the wording alone is left as terms: the scores are then two
@pytest.mark.parametrize(("per_label", "scores"), [(1000, 21), (45, 2)])
def test_scores_match_a_plain_version(spark, per_label, scores):
    rows, labels = table(noise=0.05)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), per_label=per_label)
    learnable = {r[0] for r in docs.where(~T.held_out("doc_id")).select("doc_id").collect()}
    plain = Plain(model, rows, labels, learnable.__contains__)
    assert set(plain.ids) <= learnable and (per_label == 45) == (len(plain.ids) < len(learnable))
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).select("doc_id", "toxicity.score").collect()}
    compared = 0
    for i, text in rows:
        want = plain.score(text)
        if want is None:
            assert got[i] == model.lone_share
        else:
            assert got[i] == pytest.approx(want, abs=1e-6)
            compared += 1
    # every fourth text has the wording that tells the labels apart
    assert compared >= 100 and len({round(s, 6) for s in got.values()}) >= scores


def test_calibration_has_the_least_penalised_loss():
    rng = np.random.default_rng(2)
    votes = rng.normal(0, 2, 300)
    labels = (rng.random(300) < 1 / (1 + np.exp(-(0.6 * votes - 0.4)))).astype(int)
    weights = rng.uniform(0.2, 3, 300)
    model = T.Model(None, 0.5, 0.5, (1.0, 1.0))
    model.calibrate(votes, labels, weights)

    def loss(slope, offset):
        z = slope * votes + offset
        own = weights / weights.mean()
        return (own * (np.log1p(np.exp(z)) - labels * z)).sum() + ((slope - 1) ** 2 + offset**2) / 2

    best = loss(model.slope, model.offset)
    steps = [(a, b) for a in (-0.02, 0, 0.02) for b in (-0.02, 0, 0.02)]
    assert all(best <= loss(model.slope + a, model.offset + b) + 1e-9 for a, b in steps)
    assert 0.3 < model.slope < 0.9 and -0.8 < model.offset < 0.0


def test_calibration_needs_both_labels():
    model = T.Model(None, 0.5, 0.5, (1.0, 1.0))
    model.calibrate(np.array([1.0, 2.0]), np.array([1, 1]), np.ones(2))
    assert (model.slope, model.offset) == (1.0, 0.0)
