import random

import pandas as pd
from pyspark.sql import functions as F

from workpulse.llm.common import connected_components, first_by_hash, row_hash, sample_rows, whole_groups, word_count


def test_first_by_hash(spark):
    rows = spark.range(6000).select(F.col("id"), F.when(F.col("id") < 30, "few").otherwise("many").alias("g"))
    hashed = [(r["g"], r["h"], r["id"]) for r in rows.select("g", "id", F.xxhash64("id").alias("h")).collect()]
    got = first_by_hash(rows, "g", {"few": 30, "many": 5970}, 200, F.xxhash64("id")).collect()
    want = {g: sorted((h, i) for k, h, i in hashed if k == g)[:200] for g in ("few", "many")}
    assert sorted((r["g"], r["id"]) for r in got) == sorted((g, i) for g, own in want.items() for _, i in own)


def test_sample_rows(spark):
    """Distinct rows: the same as first_by_hash. Repeated rows: as often as their share makes them, never none, never too many."""
    rows = spark.range(6000).select(F.col("id"), F.when(F.col("id") < 30, "few").otherwise("many").alias("g"))
    sizes = {"few": 30, "many": 5970}
    one, other = (f(rows, "g", sizes, 200, F.xxhash64("id")).collect() for f in (first_by_hash, sample_rows))
    assert sorted((r["g"], r["id"], r["_order"]) for r in one) == sorted((r["g"], r["id"], r["_order"]) for r in other)
    # a: one row; b: one row with half of the group; c: 40 rows of 500 copies each; d: fewer rows than asked for
    copies = [("a", 1, 20_000), ("b", 2, 5000), *(("c", 100 + i, 500) for i in range(40)), ("d", 3, 50), ("d", 4, 7)]
    table = spark.createDataFrame(copies, "g string, id long, n int").selectExpr("g", "id", "explode(sequence(1, n)) as x").drop("x")
    table = table.unionByName(spark.range(10_000, 15_000).selectExpr("'b' as g", "id")).repartition(7)
    sizes = {r["g"]: r["count"] for r in table.groupBy("g").count().collect()}
    got = [(r["g"], r["id"]) for r in sample_rows(table, "g", sizes, 1000, F.xxhash64("id")).collect()]
    count = lambda g: sum(x == g for x, _ in got)
    assert (count("a"), count("b"), count("d")) == (1000, 1000, 57) and got.count(("d", 4)) == 7
    assert 430 < got.count(("b", 2)) < 570 and len({i for g, i in got if g == "b"}) > 400
    assert count("c") == 1000 and all(5 < got.count(("c", 100 + i)) < 60 for i in range(40))


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for size, links in ((60, 40), (200, 180)):
        edges = [(rng.randrange(size), rng.randrange(size)) for _ in range(links)]
        label = list(range(size))
        for _ in range(size):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        touched = {x for a, b in edges if a != b for x in (a, b)}
        assert got == {x: label[x] for x in touched}


def test_whole_groups_never_split_a_group():
    frame = pd.DataFrame({"k": [1] * 3 + [2] * 10 + [3] + [4] * 4, "v": range(18)})
    batches = [frame.iloc[i : i + 3] for i in range(0, 18, 3)] + [frame.iloc[:0]]
    out = list(whole_groups(iter(batches), ["k"], 4))
    assert pd.concat(out)["v"].tolist() == list(range(18))
    assert sum(f["k"].nunique() for f in out) == 4


def test_word_count_and_row_hash(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a  b c d ", "x\x1cy"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(word_count(F.col("text"))).collect()]
    assert got == [len((t or "").encode().split()) for t in texts]
    with_map = df.withColumn("m", F.create_map(F.lit("k"), F.col("text")))
    assert with_map.select(row_hash(with_map).alias("h")).distinct().count() == len(texts)
