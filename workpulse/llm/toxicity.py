"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Texts are bags of hashed character n-grams across word starts. The index keeps the n-grams that tell the
labels apart in the examples (a corrected chi-square that is high enough, the ``MOST_TERMS`` highest at
most); their inverse document frequencies are counted over all documents. Cosine is exact over these terms.

The examples lie in a block-max inverted index: postings (term, block) -> (example, weight), with the
largest weight of every term in every block. A text's dot product with the block maxima bounds its
cosine with any example of a block. Blocks of the highest bounds are scored first; then only those
whose bound reaches the k-th best cosine so far. The k best, ties by example number, are therefore those
of a full scan. They vote with weight 1 / (distance + ``NEAR``), times how many labelled rows of its
label an example stands for. A logistic curve turns votes into calibrated scores; it is fitted on votes
for each of ``FOLDS`` parts of the examples by an index, with terms of its own, of the other parts.
Evidence is the nearest examples' ids, cosines and labels.

The examples are a bounded sample: for each label the ``SAMPLE_PER_LABEL`` learnable labelled rows that
come first by a hash of their id. Nothing else is bounded.

Defined cases: a null text is the empty text; a text without an index term gets the share of toxic rows
among the examples without one; without any labelled row every score is 0, with labels of one kind the
share of toxic rows (0 or 1); labels that are null are left out, of repeated labels of an id the larger
counts; repeated rows score alike; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import cut, first_by_hash, held_out, text_or_empty
from workpulse.llm.grams import hashed_grams

GRAMS = (4, 5)
BITS = 20
SAMPLE_PER_LABEL = 1000
#: A term's chi-square must be LEAST_CHI2 and LEAST_EFFECT times the number of examples.
LEAST_CHI2 = 8.0
LEAST_EFFECT = 0.006
MOST_TERMS = 8192
FOLDS = 5
BLOCK = 64
FIRST_BLOCKS = 4
NEIGHBOURS = 7
NEAR = 0.05
THRESHOLD = 0.7


def chi_square(with_toxic: np.ndarray, with_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Chi-square, corrected for continuity, of the 2 x 2 table (has the term, is toxic) for every term."""
    having, rows = with_toxic + with_clean, toxic + clean
    difference = np.abs(with_toxic * (clean - with_clean) - with_clean * (toxic - with_toxic)) - rows / 2
    scale = having * (rows - having) * float(toxic) * float(clean)
    return np.where(scale > 0, rows * np.maximum(difference, 0.0) ** 2 / np.maximum(scale, 1), 0.0)


def best_terms(chi: np.ndarray, rows: int) -> np.ndarray:
    """Places of the terms that tell the labels of so many rows apart, ascending."""
    order = np.argsort(-chi, kind="stable")[:MOST_TERMS]
    return np.sort(order[chi[order] >= max(LEAST_CHI2, LEAST_EFFECT * rows)])


class Index:
    """Examples in blocks, with postings by block and term and the largest weights."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], ids: list, labels: np.ndarray):
        self.terms, self.idf, self.ids, self.labels = terms, idf, ids, labels
        self.slot = np.full(1 << BITS, -1, dtype=np.int32)
        self.slot[terms] = np.arange(len(terms))
        vectors = [self.weights(found, counts) for found, counts in rows]
        # examples of like weightiest term next to each other: the maxima of a block are then few
        top = [(int(f[w.argmax()]) if len(f) else -1) for (f, _), w in zip(rows, vectors, strict=True)]
        order = np.lexsort((np.arange(len(rows)), top))
        self.number = order
        size = len(terms)
        self.blocks = (len(rows) + BLOCK - 1) // BLOCK
        cells, where, values = [], [], []
        for place, example in enumerate(order):
            found = rows[example][0]
            cells.append(found * self.blocks + place // BLOCK)
            where.append(np.full(len(found), place))
            values.append(vectors[example])
        cell = np.concatenate(cells) if cells else np.empty(0, dtype=np.int64)
        by_cell = np.argsort(cell, kind="stable")
        cell = cell[by_cell]
        self.place = (np.concatenate(where) if where else cell)[by_cell].astype(np.int32)
        self.value = (np.concatenate(values) if values else cell.astype(float))[by_cell]
        # a term's postings lie together, those of a block within them
        self.start = np.searchsorted(cell, np.arange(self.blocks * size + 1)).astype(np.int32)
        most = np.zeros(self.blocks * size)
        np.maximum.at(most, cell, self.value)
        self.most = np.ascontiguousarray(most.reshape(size, self.blocks))

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Index terms of a text, as places, and how often they occur."""
        slots = self.slot[hashed_grams(text, GRAMS, BITS)]
        return np.unique(slots[slots >= 0], return_counts=True)

    def weights(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1.0 + np.log(counts)) * self.idf[found]
        length = np.sqrt((weights * weights).sum())
        return weights / length if length > 0 else weights

    def _score(self, blocks: np.ndarray, found: np.ndarray, weights: np.ndarray, scores: np.ndarray) -> None:
        """Add to ``scores`` the dot products with all examples of some blocks."""
        cells = (found[None, :] * self.blocks + blocks[:, None]).ravel()
        first, sizes = self.start[cells], self.start[cells + 1] - self.start[cells]
        some = sizes > 0
        first, sizes = first[some].astype(np.int64), sizes[some].astype(np.int64)
        if not len(first):
            return
        offsets = np.repeat(first - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        query = np.repeat(np.tile(weights, len(blocks))[some], sizes)
        scores += np.bincount(self.place[offsets], query * self.value[offsets], minlength=len(scores))

    def _score_all(self, found: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The dot products with all examples, from the terms' whole postings."""
        first, last = self.start[found * self.blocks], self.start[(found + 1) * self.blocks]
        ranges = list(zip(first.tolist(), last.tolist(), strict=True))
        places = np.concatenate([self.place[a:b] for a, b in ranges])
        values = np.concatenate([self.value[a:b] for a, b in ranges]) * np.repeat(weights, last - first)
        return np.bincount(places, values, minlength=len(self.number))

    def nearest(self, found: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines of the k nearest with a positive cosine, best first."""
        bounds = weights @ self.most[found]
        scores = np.zeros(len(self.number))
        order = np.argsort(-bounds, kind="stable")
        head, tail = order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]
        self._score(head, found, weights, scores)
        reached = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        # a bound is a sum in another order than the cosine: leave room for its rounding
        rest = tail[(bounds[tail] > 0) & (bounds[tail] >= reached - 1e-9)]
        if 2 * len(rest) > self.blocks:
            scores = self._score_all(found, weights)  # most blocks are left: no need to pick them out
        elif len(rest):
            self._score(rest, found, weights, scores)
        if len(scores) > k:
            least = np.partition(scores, -k)[-k]
            picked = np.flatnonzero((scores >= least) & (scores > 0))
        else:
            picked = np.flatnonzero(scores > 0)
        best = picked[np.lexsort((self.number[picked], -np.round(scores[picked], 12)))][:k]
        return self.number[best], scores[best]


@dataclass
class Example:
    """A labelled row: its index terms, as ascending places, and how often they occur."""

    id: str
    toxic: int
    fold: int
    found: np.ndarray
    counts: np.ndarray

    def narrowed(self, places: np.ndarray, size: int) -> Example:
        """With only the terms at ``places`` left, numbered anew."""
        number = np.full(size, -1, dtype=np.int64)
        number[places] = np.arange(len(places))
        found = number[self.found]
        return Example(self.id, self.toxic, self.fold, found[found >= 0], self.counts[found >= 0])


class Model:
    """An index, the rows that an example of each label stands for, and the calibration."""

    def __init__(self, index: Index | None, share: float, lone_share: float, worth: tuple[float, float]):
        self.index, self.share, self.lone_share, self.worth = index, share, lone_share, worth
        self.slope, self.offset = 1.0, 0.0

    def vote(self, found: np.ndarray, counts: np.ndarray) -> tuple[float | None, np.ndarray, np.ndarray]:
        """The log odds of the weighted votes (None without an index term), example numbers, cosines."""
        if not len(found):
            return None, found, np.empty(0)
        numbers, cosines = self.index.nearest(found, self.index.weights(found, counts))
        if not len(numbers):
            return None, numbers, cosines
        pull = 1.0 / (1.0 - np.minimum(cosines, 1.0) + NEAR)
        toxic = self.index.labels[numbers] == 1
        # one more neighbour at distance 1, split as the labels are
        for_toxic = self.worth[1] * pull[toxic].sum() + self.share
        for_clean = self.worth[0] * pull[~toxic].sum() + (1.0 - self.share)
        return float(np.log(max(for_toxic, 1e-9) / max(for_clean, 1e-9))), numbers, cosines

    def score(self, text: str) -> tuple[float, list[tuple]]:
        if self.index is None:
            return self.share, []
        odds, numbers, cosines = self.vote(*self.index.counts(text))
        if odds is None:
            return self.lone_share, []
        evidence = [
            (str(self.index.ids[n]), float(c), int(self.index.labels[n]))
            for n, c in zip(numbers[:3], cosines[:3], strict=True)
        ]
        return float(1.0 / (1.0 + np.exp(-(self.slope * odds + self.offset)))), evidence

    def calibrate(self, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Slope (not negative) and offset of the logistic curve, by damped Newton steps."""
        if len(set(labels.tolist())) < 2:
            return
        x = np.stack([votes, np.ones(len(votes))], axis=1)
        weights = weights / weights.mean()
        beta, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
            gradient = x.T @ (weights * (p - labels)) + (beta - prior)
            hessian = (x * (weights * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.eye(2)
            step = np.linalg.solve(hessian, gradient)
            beta = beta - np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.offset = max(float(beta[0]), 0.0), float(beta[1])


SAMPLE = "id string, toxic int, place long, fold int, found array<int>, counts array<int>"


def _term_arrays(rows: DataFrame) -> DataFrame:
    """The rows with their terms and counts as arrays in place of the text."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [np.unique(hashed_grams(t, GRAMS, BITS), return_counts=True) for t in batch["text"]]
            kept = batch[["id", "toxic", "place", "fold"]].copy()
            kept["found"] = [f.astype(np.int32) for f, _ in pairs]
            kept["counts"] = [c.astype(np.int32) for _, c in pairs]
            yield kept

    return rows.mapInPandas(of, SAMPLE)


def rows_of_terms(sample: DataFrame, slot: np.ndarray) -> DataFrame:
    """The sample with only the index terms left, as their places in ascending order."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, counts = [], []
            for f, c in zip(batch["found"], batch["counts"], strict=True):
                places = slot[np.asarray(f, dtype=np.int64)]
                some = places >= 0
                found.append(places[some].astype(np.int32))
                counts.append(np.asarray(c)[some])
            yield batch.assign(found=found, counts=counts)

    return sample.mapInPandas(of, SAMPLE)


def _choose_terms(sample: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """The terms that any index needs, and the places among them that each index takes.

    The first index is of all rows, the others leave out one fold each. Terms are counted per label and
    fold in a shuffle by term; only those that may be taken come to the driver.
    """
    cells = [(label, fold) for label in (0, 1) for fold in range(FOLDS)]
    mine = [(F.col("toxic") == label) & (F.col("fold") == fold) for label, fold in cells]
    totals = sample.agg(*(F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(mine))).first()
    rows = np.array(list(totals), dtype=np.int64).reshape(2, FOLDS)
    counted = (
        sample.select("toxic", "fold", F.explode("found").alias("term"))
        .groupBy("term")
        .agg(*(F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(mine)))
    )

    def squares(counts: np.ndarray) -> list[np.ndarray]:
        """From (terms, 2, FOLDS) the chi-squares over all rows, then without each fold."""
        kept = [list(range(FOLDS)), *([k for k in range(FOLDS) if k != fold] for fold in range(FOLDS))]
        return [
            chi_square(counts[:, 1][:, k].sum(1), counts[:, 0][:, k].sum(1), int(rows[1, k].sum()), int(rows[0, k].sum()))
            for k in kept
        ]

    names = [f"n{i}" for i in range(2 * FOLDS)]

    @F.pandas_udf("double")
    def highest(counts: pd.DataFrame) -> pd.Series:
        return pd.Series(np.max(squares(counts.to_numpy(dtype=np.int64).reshape(-1, 2, FOLDS)), axis=0))

    best = counted.withColumn("chi", highest(F.struct(*names))).where(F.col("chi") >= LEAST_CHI2)
    found = best.orderBy(F.col("chi").desc(), "term").limit((FOLDS + 1) * MOST_TERMS).drop("chi").toPandas()
    found = found.sort_values("term")
    counts = found[names].to_numpy(dtype=np.int64).reshape(-1, 2, FOLDS)
    return found["term"].to_numpy(dtype=np.int64), [best_terms(chi, int(rows.sum())) for chi in squares(counts)]


def _term_frequencies(texts: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of ``text`` each of the terms occurs, and the number of rows."""
    slot = np.full(1 << BITS, -1, dtype=np.int32)
    slot[terms] = np.arange(len(terms))
    sent = texts.sparkSession.sparkContext.broadcast(slot)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(terms) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                slots = sent.value[hashed_grams(text, GRAMS, BITS)]
                seen = np.zeros(len(terms), dtype=bool)
                seen[slots[slots >= 0]] = True
                total[:-1] += seen
            total[-1] += len(batch)
        yield pd.DataFrame({"term": np.arange(len(total)), "n": total})

    # a task sends one number for each term; the result has one number for each term
    summed = texts.mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    result = np.zeros(len(terms) + 1, dtype=np.int64)
    for term, n in summed:
        result[term] = n
    return result[:-1], int(result[-1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", toxic: str = "toxic",
    per_label: int = SAMPLE_PER_LABEL,
) -> Model:
    """A model from the labelled rows that may be learned from; document frequencies are over ``docs``."""
    texts = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text]).alias("text"))
    marks = (
        labels.select(labels[id_col].alias("id"), labels[toxic].cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model(None, 1.0 if 1 in totals else 0.0, 0.0, (1.0, 1.0))
    share = totals[1] / (totals[0] + totals[1])
    picked = first_by_hash(marks, "toxic", totals, per_label, F.xxhash64("id")).select("id", "toxic")
    # at most 2 * per_label ids; an id that several rows have gives its first row by hash
    found = (
        texts.join(F.broadcast(picked), "id")
        .groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .withColumn("place", F.xxhash64("id"))
        .withColumn("fold", F.pmod("place", F.lit(FOLDS)).cast("int"))
    )
    sample = cut(_term_arrays(found.withColumn("id", F.col("id").cast("string"))))
    terms, taken = _choose_terms(sample)
    if not len(taken[0]):
        return Model(None, share, share, (1.0, 1.0))
    frequencies, rows = _term_frequencies(texts.select("text"), terms)
    idf = np.log((1.0 + rows) / (1.0 + frequencies)) + 1.0
    slot = np.full(1 << BITS, -1, dtype=np.int64)
    slot[terms] = np.arange(len(terms))
    # only the index terms of the bounded sample come to the driver
    data = [
        Example(r["id"], r["toxic"], r["fold"], np.array(r["found"], dtype=np.int64), np.array(r["counts"], dtype=np.int64))
        for r in rows_of_terms(sample, slot).orderBy("place", "id").collect()
    ]
    # labelled rows that an example stands for, 1 on average
    worth = tuple(totals[k] / max(1, sum(x.toxic == k for x in data)) for k in (0, 1))
    mean = sum(worth[x.toxic] for x in data) / max(1, len(data))
    worth = (worth[0] / mean, worth[1] / mean)

    def model_of(examples: list[Example], places: np.ndarray) -> Model:
        narrowed = [x.narrowed(places, len(terms)) for x in examples]
        lone = [x.toxic for x in narrowed if not len(x.found)]
        lone_toxic, lone_clean = worth[1] * sum(lone), worth[0] * (len(lone) - sum(lone))
        lone_share = (lone_toxic + worth[0] * share) / (lone_toxic + lone_clean + worth[0])
        index = Index(
            terms[places], idf[places], [(x.found, x.counts) for x in narrowed], [x.id for x in narrowed],
            np.array([x.toxic for x in narrowed]),
        )
        return Model(index, share, lone_share, worth)

    votes, truth, weights = [], [], []
    for fold in range(FOLDS):
        places = taken[fold + 1]
        other = model_of([x for x in data if x.fold != fold], places)
        for x in (x.narrowed(places, len(terms)) for x in data if x.fold == fold):
            odds = other.vote(x.found, x.counts)[0]
            if odds is not None:
                votes.append(odds)
                truth.append(x.toxic)
                weights.append(worth[x.toxic])
    model = model_of(data, taken[0])
    if votes:
        model.calibrate(np.array(votes), np.array(truth), np.array(weights))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``toxicity``: score, predicted, evidence (id, cosine, label)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, predicted int, evidence array<struct<id string, cosine double, label int>>")
    def of(texts: pd.Series) -> pd.DataFrame:
        known = sent.value
        rows = [known.score(t) for t in texts]
        return pd.DataFrame({
            "score": [s for s, _ in rows], "predicted": [int(s >= THRESHOLD) for s, _ in rows],
            "evidence": pd.Series([[{"id": i, "cosine": c, "label": y} for i, c, y in e] for _, e in rows], dtype="object"),
        })

    return docs.withColumn("toxicity", of(text_or_empty(docs[text])))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that are predicted toxic."""
    columns = docs.columns
    model = fit(docs, labels, id_col, text)
    packed = docs.select(F.struct(*(docs[c] for c in columns)).alias("_row"), docs[text].alias("text"))
    return score(packed, model).where("toxicity.predicted = 0").select("_row.*")
