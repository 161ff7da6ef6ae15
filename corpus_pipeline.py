"""Corpus pipeline: documents in, training mix out.

The stages run in the order of ``STAGES``, each over all rows that the one before it kept, written as
Parquet and read again in between (``run`` uses the shared folder of ``spark.checkpoint.dir``).

* toxicity: documents that the nearest labelled examples call toxic go;
* line dedup: blocks of lines that an earlier document has are deleted from the later one;
* SimHash near-dedup: of each group of near-duplicates the document with the smallest id stays;
* benchmark decontamination: documents that contain a benchmark item go;
* mixing: every document comes as often as the mix of sources takes it, with ``copy`` (1, 2, ...).

Where a stage changes a text, ``n_chars``, if there is such a column, follows it. Null texts, empty
tables, repeated rows and extra columns pass through as each operator's module states.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm import decontaminate, lines, mixing, simhash, toxicity
from workpulse.llm.common import read_table, shared_checkpoint_dir
from workpulse.sources.versions import Folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = lines.documents_without_repeats(docs)
    if "n_chars" not in docs.columns:
        return found
    kind = dict(docs.dtypes)["n_chars"]
    chars = F.coalesce(F.length("text"), F.lit(0)).cast(kind)
    return found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(chars))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
]

#: SQL can't express the classifier or the alignment; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The mix made from the documents of ``sf_dir``.

    Each stage but the last is written to ``folder``, by default a new one in that of the checkpoints, and the one
    before it is deleted then: one written stage is left, which the result reads. Called again with the same
    ``folder``, it goes on after the last stage that was written whole.
    """
    store = Folder(spark, folder or f"{shared_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}")
    before = STAGES[:-1]
    done = max((n for n in range(len(before)) if "_SUCCESS" in store.names(str(n))), default=-1)
    for number in range(done + 1, len(before)):
        docs = spark.read.parquet(f"{store.path}/{number - 1}") if number else read_table(spark, sf_dir, "documents")
        before[number][1](spark, docs, sf_dir).write.mode("overwrite").parquet(f"{store.path}/{number}")
        if number:
            store.delete(str(number - 1))
    return STAGES[-1][1](spark, spark.read.parquet(f"{store.path}/{len(before) - 1}"), sf_dir)
