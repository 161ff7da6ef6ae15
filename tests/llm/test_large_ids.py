"""Ids beyond 2 ** 53, next to a null id in the same batch, come out as they went in."""

import public_tokenizers
import pytest

from workpulse.llm import decontaminate, language, licenses, lines, mixing, secrets, simhash, spotsigs, tokens, toxicity

LINE = "this line has more than eight different words in it for sure"
FIRST, LAST = 2**60 + 1, 2**60 + 3


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(FIRST, f"{LINE}\nReleased under the MIT License.", "a"), (LAST, f"mine\n{LINE}\nReleased under the MIT License. secret=abcdefghijk", None), (None, "other text", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)


def ids(df):
    return {r["doc_id"] for r in df.collect()}


def test_every_operator(spark, docs):
    every = {FIRST, LAST, None}
    benchmark = spark.createDataFrame([(LAST, LINE), (None, "nothing of this kind is anywhere in there")], "item_id long, text string")
    labels = spark.createDataFrame([(FIRST, 1), (LAST, 0)], "doc_id long, toxic int")
    learned = language.fit(docs.selectExpr("doc_id as id", "text", "'en' as lang"))
    for found in (
        secrets.find_secrets(docs), simhash.near_duplicates(docs), simhash.drop_near_duplicates(docs),
        spotsigs.likeness_to_edits(docs), language.predict(docs, learned), mixing.mix(docs),
        tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json")), lines.dedup_lines(docs).select("_row.doc_id"),
        lines.documents_without_repeats(docs), toxicity.score(docs, toxicity.fit(docs, labels)), mixing.mixed_documents(docs),
    ):
        assert ids(found) <= every and {FIRST, LAST} <= ids(found) | ({FIRST, LAST} if "copy" in found.columns else set())
    assert ids(licenses.license_notices(docs)) == {FIRST, LAST}
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()} == {(FIRST, LAST), (LAST, LAST)}
    holders = [r["holders"] for r in lines.dedup_lines(docs).collect() if r["holders"]]
    assert holders == [[FIRST]]
    prints, members = spotsigs.near_pairs(spotsigs.fingerprints(docs))
    assert {r["id"] for r in members.collect()} <= every
