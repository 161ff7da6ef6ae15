"""Registered queries: each applies one operator, with its production parameters, to whole tables.

Every query reads the tables of ``sf_dir`` without a limit, sample or id subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm import (
    decontaminate, language, licenses, lines, mixing, packing, prefix_tree, ranked_search, secrets, simhash, spotsigs, tokens, toxicity,
)
from workpulse.llm.common import held_out, read_table, text_or_empty


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    kinds = [rule.kind for rule in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in kinds),
        F.sha2(secrets.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.likeness_to_edits(read_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    learnable = docs.where(~held_out("doc_id")).select(F.col("doc_id").alias("id"), "text", "lang")
    predicted = language.predict(docs.select("doc_id", "text"), language.fit(learnable))
    return predicted.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, vocabulary).select(
        "doc_id",
        F.octet_length(text_or_empty("text")).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "text",
        F.coalesce(F.expr("aggregate(blocks, 0, (n, b) -> n + b.last - b.first + 1)"), F.lit(0)).alias("lines_deleted"),
        F.col("words").alias("words_deleted"),
        "blocks",
        "holders",
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_notices(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "toxicity.score", "toxicity.predicted", "toxicity.evidence"
    )


def op11_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_tree.turns(read_table(spark, sf_dir, "conversations"))
    return prefix_tree.prefix_trie(prefix_tree.with_shared_openings(own))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_simhash": op2_simhash,
    "op3_fingerprints": op3_fingerprints,
    "op4_language": op4_language,
    "op5_mixing": op5_mixing,
    "op6_decontaminate": op6_decontaminate,
    "op7_tokens": op7_tokens,
    "op8_lines": op8_lines,
    "op9_licenses": op9_licenses,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ranked_search": op13_ranked_search,
}
