import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from workpulse.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counted = [(i, collections.Counter(terms(x))) for i, x in docs]
    n_docs = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_texts(rng, count, words=30):
    # few words with skewed frequencies: ties, copies, terms in every document
    vocabulary = [f"w{i}" for i in range(words)]
    return [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(words)], k=rng.randrange(0, 14))) for _ in range(count)]


@pytest.mark.parametrize("options", [{}, {"block_postings": 40}, {"part_chars": 200, "block_postings": 300}])
def test_random_texts(spark, options):
    rng = random.Random(2)
    docs = list(enumerate(random_texts(rng, 400)))
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(None, docs[5][1]), (2000, None)]
    items = list(enumerate(random_texts(rng, 12))) + [(50, "w29"), (51, ""), (52, None), (53, "none such"), (50, "w29")]
    got = R.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert rows_of(got) == brute(docs, items)


def test_terms_of_every_kind_of_character():
    text = "".join(chr(c) for c in range(1, 0x250)) + " ÀB😀c中 _x_ A-b"
    assert [t.decode() for t in R.terms(text) if t] == terms(text)


def blocks(rng, n_docs=300, words=25):
    texts = [collections.Counter(rng.choices(range(words), [1 / (i + 1) ** 2 for i in range(words)], k=rng.randrange(1, 30))) for _ in range(n_docs)]
    sizes = np.array([len(c) for c in texts])
    term = np.array([t for c in texts for t in c], dtype="int32")
    tf = np.array([n for c in texts for n in c.values()], dtype="int32")
    n = np.array([sum(c.values()) for c in texts])
    return texts, R.Block(n, sizes, term, tf, n_docs, int(n.sum())), n


def test_block_search_is_exact_and_stops_early():
    rng = random.Random(9)
    texts, block, n = blocks(rng, 3000, 200)
    df = collections.Counter(t for c in texts for t in c)
    early = 0
    for _ in range(60):
        item = np.array(sorted(rng.sample(range(200), rng.randrange(1, 9))))
        weights = np.zeros(200, dtype="int64")
        weights[item] = [R.weight(3000, df[t]) if df[t] else 0 for t in item.tolist()]
        every = []
        for d, c in enumerate(texts):
            m = int(R.length_measure(np.array([n[d]]), 3000, int(n.sum()))[0])
            every.append((-sum(int(weights[t]) * int(1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in item.tolist() if c[t]), d))
        every = sorted(x for x in every if x[0])
        docs, scores, read = block.search(item, weights, 10)
        got = sorted(zip((-scores).tolist(), docs.tolist(), strict=True))
        kth = every[9][0] if len(every) > 9 else -1
        assert got == [x for x in every if x[0] <= kth]  # all with the k-th score too
        early += read < sum(df[t] for t in item.tolist() if weights[t]) // 2
        if not every:
            continue
        # a k-th score known before only leaves out what is below it
        docs, scores, _ = block.search(item, weights, 10, floor=int(-every[0][0]))
        assert sorted(docs.tolist()) == [d for s, d in every if s == every[0][0]]
    assert not block.seen.any() and not block.known.any()
    assert early > 5


def test_best_positions_stop_sooner_than_last_read_positions(monkeypatch):
    """Positions seen by direct access lower the bound: without them more is read."""
    rng = random.Random(10)
    _, block, _ = blocks(rng, 3000, 60)
    weights = np.zeros(60, dtype="int64")
    item = np.arange(2, 10)
    weights[item] = 500
    monkeypatch.setattr(R, "FIRST_READ", 1)
    _, scores, read = block.search(item, weights, 10)
    direct = R.Block.direct
    monkeypatch.setattr(R.Block, "direct", lambda self, docs, w: (direct(self, docs, w)[0], self._read_places(docs)))
    reads = {"n": 0}

    def own_places(self, docs):
        # only what has been read in order counts as seen: each list up to where it has been read
        reads["n"] += 1
        step = 2 ** reads["n"] - 1
        return np.concatenate([np.arange(s, min(e, s + step)) for t, (s, e) in self.lists.items() if weights[t]])

    monkeypatch.setattr(R.Block, "_read_places", own_places, raising=False)
    _, same, without = block.search(item, weights, 10)
    assert sorted(same.tolist())[-10:] == sorted(scores.tolist())[-10:]
    assert read <= without


def test_awkward_tables(spark, awkward, empty):
    items = spark.createDataFrame([(1, "one word"), (None, "Üben é"), (3, None)], "item_id long, text string")
    items = items.withColumn("rank", F.lit("r")).withColumn("score", F.lit("s"))
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows_of(R.search(awkward, items)) == brute(docs, [(r["item_id"], r["text"]) for r in items.collect()])
    assert R.search(empty, items).count() == 0 and R.search(awkward, items.where("false")).count() == 0
