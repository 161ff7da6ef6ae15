import random
import string

import numpy as np
import pytest

from workpulse.llm import decontaminate as X
from workpulse.llm.queries import QUERIES

RNG = random.Random(9)


def words(n):
    return " ".join("".join(RNG.choice(string.ascii_lowercase) for _ in range(RNG.randrange(2, 9))) for _ in range(n))


def folded(text):
    return " ".join("".join(c.lower() if len(c.lower()) == 1 else c for c in text).split())


def best_distance(item, text):
    """Least edits from the item to any stretch of the text, by the full table."""
    row = np.zeros(len(text) + 1, dtype=int)
    codes = np.array([ord(c) for c in text])
    for i, char in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (codes != ord(char)), row[1:] + 1)
        shift = np.arange(len(new))
        row = np.minimum.accumulate(new - shift) + shift
    return int(row.min())


def edited(text, edits):
    chars = list(text)
    for _ in range(edits):
        i = RNG.randrange(len(chars))
        kind = RNG.randrange(3)
        if kind == 0:
            chars[i] = RNG.choice(string.ascii_lowercase)
        elif kind == 1:
            chars.insert(i, RNG.choice(string.ascii_lowercase + " "))
        elif len(chars) > 1:
            del chars[i]
    return "".join(chars)


@pytest.fixture(scope="module")
def items():
    return [(i, words(RNG.randrange(6, 40))) for i in range(12)]


def test_hits_match_the_full_table(items):
    index = X.ItemIndex(items)
    for trial in range(150):
        i, item = RNG.choice(items)
        budget = X.edit_budget(len(folded(item)))
        inside = edited(item, RNG.randrange(0, budget + 4))
        text = f"{words(RNG.randrange(0, 30))} {inside.upper() if trial % 3 else inside} {words(RNG.randrange(0, 30))}"
        want = {k for k, t in items if best_distance(folded(t), folded(text)) <= X.edit_budget(len(folded(t)))}
        got = {h["item_id"]: h for h in index.hits(text)}
        assert set(got) == want
        for k, hit in got.items():
            assert hit["edits"] == best_distance(folded(dict(items)[k]), folded(text))
            span = folded(text[hit["start"] : hit["end"]])
            assert best_distance(folded(dict(items)[k]), span) <= hit["edits"] + 1


def test_spans_of_several_hits(items):
    index = X.ItemIndex(items)
    text = f"é {items[0][1]}  \n {items[1][1]} x {items[0][1]}"
    found = [(h["item_id"], text[h["start"] : h["end"]]) for h in index.hits(text)]
    assert found == [(0, items[0][1]), (0, items[0][1]), (1, items[1][1])]


def test_short_items():
    index = X.ItemIndex([(1, "abc"), (2, "a bcd efgh"), (3, ""), (4, None)])
    assert [h["item_id"] for h in index.hits(" ABC ")] == [1]
    assert index.hits("xx abc yy") == []
    assert [h["item_id"] for h in index.hits("zz A  bcd efgh zz")] == [2]
    assert index.hits("") == []
    assert X.ItemIndex([]).hits("some text of any kind") == []


def test_parts_give_the_same_result(spark, items):
    docs = spark.createDataFrame([(k, f"{words(5)} {t} {words(5)}") for k, t in items] + [(99, words(50)), (100, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (50, None)], "item_id long, text string")
    whole, parts = (sorted(X.contaminated(docs, benchmark, part_chars=n).collect()) for n in (5_000_000, 300))
    assert whole == parts and [r["doc_id"] for r in whole] == list(range(12))
    assert sorted(r["doc_id"] for r in X.drop_contaminated(docs, benchmark).collect()) == [99, 100]


def test_query_finds_every_exact_passage(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    texts = {r["doc_id"]: folded(r["text"]) for r in docs}
    want = {(i, b["item_id"]) for b in benchmark for i, t in texts.items() if folded(b["text"]) in t}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontaminate"](spark, sf).collect()}
    assert want and want <= got
    wide = {b["item_id"]: folded(b["text"]) for b in benchmark}
    assert all(best_distance(wide[k], texts[i]) <= X.edit_budget(len(wide[k])) for i, k in got - want)


def test_awkward_tables(spark, awkward, empty, items):
    benchmark = spark.createDataFrame([*items, (70, "word " * 8), (71, "ONE")], "item_id long, text string")
    got = X.contaminated(awkward, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(6, 70), (3, 71), (None, 71)}
    kept = X.drop_contaminated(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 4
    assert X.contaminated(empty, benchmark).count() == 0
    assert X.drop_contaminated(awkward, benchmark.where("false")).count() == awkward.count()


def test_parts_run_in_turn_and_repeated_items_are_sent_once(spark, items):
    docs = spark.createDataFrame([(k, f"x {t} y") for k, t in items], "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, *[items[0]] * 49], "item_id long, text string")
    assert sum(p.count() for p in X.benchmark_parts(benchmark, "item_id", "text", 300)) == len(items)
    found = X.contaminated(docs, benchmark, part_chars=300)
    # the hits of every part are written by now: no part's index is left in the plan
    assert "ArrowEvalPython" not in found._jdf.queryExecution().toString()
    got = [r["item_id"] for r in found.collect()]
    assert got.count(items[0][0]) == 50 and sorted(got) == sorted(r["item_id"] for r in X.contaminated(docs, benchmark).collect())
