import random
import zlib

import numpy as np
import pytest

from workpulse.llm import toxicity as T
from workpulse.llm.queries import QUERIES


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def random_index(rng, rows=700, terms=60):
    made = []
    for _ in range(rows):
        found = np.sort(rng.choice(terms, rng.integers(0, 8), replace=False))
        made.append((found.astype(np.int64), rng.integers(1, 4, len(found))))
    return T.Index(np.arange(terms), rng.uniform(1, 5, terms), made, list(range(rows)), rng.integers(0, 2, rows)), made


def test_nearest_are_those_of_a_full_scan():
    rng = np.random.default_rng(7)
    index, rows = random_index(rng)
    full = np.zeros((len(rows), 60))
    for i, (found, counts) in enumerate(rows):
        full[i, found] = index.weights(found, counts)
    for _ in range(300):
        found = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        weights = index.weights(found, rng.integers(1, 4, len(found)))
        cosines = full[:, found] @ weights
        want = np.lexsort((np.arange(len(rows)), -np.round(cosines, 12)))[:7]
        want = want[cosines[want] > 0]
        numbers, scores = index.nearest(found, weights)
        assert numbers.tolist() == want.tolist()
        assert np.allclose(scores, cosines[want])


def test_block_maxima_bound_every_example():
    rng = np.random.default_rng(3)
    index, rows = random_index(rng, 300, 40)
    for place, example in enumerate(index.number):
        found, counts = rows[example]
        assert (index.most[found, place // T.BLOCK] >= index.weights(found, counts) - 1e-12).all()


def test_chi_square_against_the_table():
    a, b, n1, n0 = np.array([8]), np.array([2]), 10, 30
    table = np.array([[8, 2], [2, 28]], dtype=float)
    expected = np.outer(table.sum(1), table.sum(0)) / 40
    want = ((np.abs(table - expected) - 0.5) ** 2 / expected).sum()
    assert T.chi_square(a, b, n1, n0)[0] == pytest.approx(want)


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, sf).collect()}
    assert all(r["held_out"] == is_held_out(i) and 0 <= r["score"] <= 1 for i, r in rows.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if is_held_out(r["doc_id"])}
    caught = [i for i, y in truth.items() if y == 1 and rows[i]["predicted"]]
    wrong = [i for i, y in truth.items() if y == 0 and rows[i]["predicted"]]
    assert len(caught) > 0.8 * sum(truth.values()) and len(wrong) < 0.02 * len(truth)


def test_labels_of_held_out_rows_are_never_used(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    a, b = (
        sorted(T.score(docs.select("doc_id", "text"), T.fit(docs, x)).select("doc_id", "toxicity.score").collect())
        for x in (labels, flipped)
    )
    assert a == b


def test_few_or_no_labels_and_awkward_tables(spark, awkward, empty):
    labels = spark.createDataFrame([(0, 1), (2, 0), (3, 1), (4, None), (None, 1), (3, 0), (77, 1)], "doc_id long, toxic int")
    for some in (labels, labels.where("toxic = 1"), labels.where("toxic = 0"), labels.where("false")):
        got = T.score(awkward, T.fit(awkward, some)).collect()
        assert len(got) == awkward.count() and all(0 <= r["toxicity"]["score"] <= 1 for r in got)
    kept = T.drop_toxic(awkward, labels.where("false"))
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert T.drop_toxic(empty, labels).count() == 0


def test_evidence_names_examples(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(20)) + (" horrible insult" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"] for r in T.score(docs, T.fit(docs, labels)).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in got)
    assert all(e["label"] == 1 and not is_held_out(int(e["id"])) for i in got if i % 4 == 0 for e in got[i]["evidence"])


def test_rare_toxic_wording_is_a_term():
    """A term of 14 in 1000 toxic examples and of no clean one is indexed."""
    chi = T.chi_square(np.array([14, 5]), np.array([0, 4]), 1000, 1000)
    assert T.best_terms(chi, 2000).tolist() == [0]
