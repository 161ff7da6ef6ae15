import os
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from workpulse.llm import simhash
from workpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]


def test_stages():
    assert [name for name, _ in C.STAGES] == NAMES


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def planted(spark, given):
    """The given documents with planted cases behind them, and the ids of each kind."""
    rng = random.Random(8)
    syllables = ["ka", "lo", "mi", "ne", "pu", "ra", "si", "to", "ve", "zu"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = {90_000 + i: text(rng.randrange(4, 30)) for i in range(40)}
    sources = [text(20) for _ in range(6)]
    copies = {91_000 + 10 * k + j: t for k, t in enumerate(sources) for j in range(3)}
    # one word in a very long line changes: line hashes differ everywhere, the fingerprint hardly
    flat = [" ".join(word() for _ in range(1500)) for _ in range(4)]
    near = {92_000 + 10 * k + j: t.replace(t.split()[700], f"other{j}", 1) for k, t in enumerate(flat) for j in range(3)}
    passage = " ".join(word() for _ in range(60))
    passages = {93_000 + j: f"{text(5)}\n{passage}\n{text(5)}" for j in range(8)}
    leaks = {94_000 + j: f"{text(4)}\n{item}\n{text(4)}" for j in range(8)}
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in (clean | copies | near | passages | leaks).items()]
    docs = given.unionByName(spark.createDataFrame(rows, given.schema)).cache()
    return docs, {"clean": clean, "copies": copies, "near": near, "passages": passages, "leaks": leaks, "passage": passage}


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_toxicity_keeps_clean_documents(spark, planted):
    docs, cases = planted
    kept = C.STAGES[0][1](spark, docs, SF)
    assert kept.columns == docs.columns
    assert len(set(cases["clean"]) - ids(kept)) <= 1


def test_line_dedup(spark, planted):
    docs, cases = planted
    kept = C.STAGES[1][1](spark, docs, SF)
    assert kept.columns == docs.columns and ids(kept) == ids(docs)
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert all(texts[i]["text"] == t and texts[i]["n_chars"] == len(t) for i, t in cases["clean"].items())
    holders = [i for i in cases["passages"] if cases["passage"] in texts[i]["text"]]
    assert holders == [min(cases["passages"])]
    assert all((texts[i]["text"] == "") == (i % 10 > 0) for i in cases["copies"])
    assert all(r["n_chars"] == len(r["text"]) for r in texts.values())


def test_near_dedup(spark, planted):
    docs, cases = planted
    kept = ids(C.STAGES[2][1](spark, docs, SF))
    assert set(cases["clean"]) <= kept
    for kind in ("copies", "near"):
        assert {i for i in cases[kind] if i in kept} == {i for i in cases[kind] if i % 10 == 0}
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert kept == groups


def test_decontamination(spark, planted):
    docs, cases = planted
    kept = ids(C.STAGES[3][1](spark, docs, SF))
    assert not kept & set(cases["leaks"])
    assert set(cases["clean"]) | set(cases["copies"]) | set(cases["passages"]) <= kept


def test_mixing(spark, planted):
    docs, _ = planted
    got = C.STAGES[4][1](spark, docs, SF)
    assert got.columns == [*docs.columns, "copy"]
    taken = {r["doc_id"]: r["copies"] for r in QUERIES["op5_mixing"](spark, SF).collect()}
    mixed = C.STAGES[4][1](spark, docs.where("doc_id < 90000"), SF).groupBy("doc_id").agg(F.max("copy").alias("n"), F.count("*").alias("c"))
    rows = mixed.collect()
    assert all(r["n"] == r["c"] for r in rows)
    sizes = {r["doc_id"]: r["n"] for r in rows}
    assert set(sizes) <= set(taken) and sum(sizes.values()) > 0


def test_run_chains_the_stages(spark, given):
    docs = given
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
    want = sorted(tuple(r) for r in docs.collect())
    assert want and sorted(tuple(r) for r in C.run(spark, SF).collect()) == want


@pytest.mark.parametrize("number", range(5))
def test_awkward_tables(spark, awkward, empty, number):
    stage = C.STAGES[number][1]
    got = stage(spark, awkward, SF)
    assert set(got.columns) == set(awkward.columns)
    assert 0 < got.count() <= 3 * awkward.count()
    assert stage(spark, empty, SF).count() == 0


def test_run_goes_on_after_the_last_written_stage(spark, tmp_path, monkeypatch):
    """A stage that fails leaves the ones before it; earlier stages are deleted once the next is written."""
    docs = spark.createDataFrame([(i, f"text number {i} of its own words", "en", "s", 5) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    ran = []

    def stage(name, fails=False):
        def of(spark, docs, sf_dir):
            ran.append(name)
            if fails:
                raise OSError("lost")
            return docs.withColumn("text", F.concat("text", F.lit(f" {name}")))

        return name, of

    folder = f"{tmp_path}/stages"
    monkeypatch.setattr(C, "STAGES", [stage("a"), stage("b"), stage("c", fails=True), stage("d")])
    with pytest.raises(OSError):
        C.run(spark, f"{tmp_path}/in", folder)
    assert sorted(os.listdir(folder)) == ["1"]
    monkeypatch.setattr(C, "STAGES", [stage("a"), stage("b"), stage("c"), stage("d")])
    got = C.run(spark, f"{tmp_path}/in", folder)
    assert ran == ["a", "b", "c", "c", "d"] and sorted(os.listdir(folder)) == ["2"]
    assert {r["text"].split("words ")[1] for r in got.collect()} == {"a b c d"}
