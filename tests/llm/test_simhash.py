import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from workpulse.llm import simhash as S
from workpulse.llm.common import connected_components
from workpulse.llm.queries import QUERIES


def slow_fingerprint(text, size=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "")) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    runs = [words[i : i + size] for i in range(len(words) - size + 1)] or [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, ids, bits=3):
    """Component id of every row, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t", "A b", "a b c d", "É x y Z \x0b Q", "The the THE " * 50])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_spark_and_library_hash_agree(spark):
    got = spark.sql("select hex(xxhash64('a é b'))").first()[0]
    assert int(got, 16) == xxhash.xxh64_intdigest("a é b".encode(), 42)


@pytest.mark.parametrize("group_rows", [4, 1024])
def test_links_match_all_pairs(spark, group_rows):
    """Random and clustered fingerprints; a small bound on groups forces them to be cut again and again."""
    rng = random.Random(group_rows)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(150)} | {0, 1, 3, 2**63, 2**64 - 1}
    for _ in range(400):  # a hot group: many that agree in most blocks
        value = centre
        for _ in range(rng.randrange(0, 7)):
            value ^= 1 << rng.randrange(64)
        values.add(value)
    values = sorted(values)
    rows = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = S.fingerprint_links(spark.createDataFrame(rows, "fp long"), 3, group_rows).collect()
    place = {r[0]: i for i, r in enumerate(rows)}
    label = S.smallest_reachable(
        len(values), np.array([place[r["a"]] for r in links]), np.array([place[r["b"]] for r in links])
    )
    assert label.tolist() == classes(values, list(range(len(values))))


def test_walk_finds_every_pair():
    rng = random.Random(1)
    groups, values = [], []
    for g in range(30):
        base = rng.getrandbits(64)
        own = sorted({base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(rng.randrange(1, 20))})
        groups += [g] * len(own)
        values += own
    a, b = S.walk_tries(np.array(groups), np.array(values, dtype=np.uint64), 3)
    want = {
        (i, j) for j in range(len(values)) for i in range(j)
        if groups[i] == groups[j] and (values[i] ^ values[j]).bit_count() <= 3
    }
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
    assert len(a) == len(want)


def test_components_of_a_chain(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = connected_components(edges.unionByName(spark.createDataFrame([(900, 901)], "a long, b long")))
    assert {(r["node"], r["component"]) for r in got.collect()} == {(i, 0) for i in range(200)} | {(900, 900), (901, 900)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    prints = [slow_fingerprint(r["text"]) for r in rows]
    want = classes(prints, [r["doc_id"] for r in rows])
    got = sorted(QUERIES["op2_simhash"](spark, sf).collect())
    assert [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got] == [
        (r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True)
    ]


def test_awkward_tables(awkward, empty):
    rows = awkward.collect()
    prints = [slow_fingerprint(r["text"]) for r in rows]
    want = classes(prints, [r["doc_id"] for r in rows])
    got = S.near_duplicates(awkward).collect()
    key = lambda x: (x[0] is None, x)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=key) == sorted(
        ((r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, want, strict=True)), key=key
    )
    kept = S.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
    assert S.near_duplicates(empty).count() == 0
    assert S.drop_near_duplicates(empty).count() == 0
