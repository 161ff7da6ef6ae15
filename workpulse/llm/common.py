"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where it is unset and Spark runs in this process alone a
    temporary one is set. On a cluster executors would not share that: it is refused."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="workpulse-llm-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: the files outlive executors."""
    shared_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col.cast("string"), F.lit(""))


def row_hash(docs: DataFrame) -> Column:
    """A 64-bit hash of all columns; maps, which Spark doesn't hash, count as their JSON text."""
    return F.xxhash64(*(F.to_json(docs[c]) if "map<" in kind else docs[c] for c, kind in docs.dtypes))


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as the empty text (not held out)."""
    return F.crc32(text_or_empty(doc_id).cast("binary")) % 3 == 1


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def first_by_hash(rows: DataFrame, group: str, sizes: dict, most: int, order: Column) -> DataFrame:
    """Of each ``group`` value in ``sizes`` (value to number of rows), the ``most`` rows first by ``order``.

    ``order`` is a 64-bit hash. Only rows below the hash that about 2 * ``most`` rows of their group have
    are shuffled, so that no task gets more than that for a group, however many tasks there are.
    """
    span = 1 << 64
    bounds = [(value, min(span, 2 * most * span // max(1, n)) - (span >> 1) - 1) for value, n in sizes.items()]
    kind = dict(rows.dtypes)[group]
    below = rows.sparkSession.createDataFrame(bounds, f"_group {kind}, _bound long")
    few = (
        rows.withColumn("_order", order)
        .join(F.broadcast(below), F.col(group) == F.col("_group"))
        .where("_order <= _bound")
    )
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_order", *(c for c in ("id",) if c in rows.columns)))
    return few.withColumn("_place", place).where(F.col("_place") <= most).drop("_group", "_bound", "_place")


def sample_rows(rows: DataFrame, group: str, sizes: dict, most: int, order: Column) -> DataFrame:
    """Of each ``group`` value in ``sizes`` about the ``most`` first rows by the hash ``order``, repeated rows as often as
    their share of the group makes them.

    Equal rows have one hash. They are counted, as (group, hash) only, and a hash that n of a group's N rows have is due
    2 * most * n / N candidates: its whole part, and one more where the hash itself falls below the rest. Each
    candidate of a repeated row has a place of its own below the bound, so that ``most`` of them, the first by
    place, are a fair share. Without repeated rows this is ``first_by_hash``. The candidates, about 2 * ``most`` a
    group, are the side that is broadcast; the copies of a row become one before they are dealt out again.
    """
    span = 1 << 64
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[group]
    bounds = [(value, float(n), min(span, 2 * most * span // max(1, n)) - (span >> 1) - 1) for value, n in sizes.items()]
    below = spark.createDataFrame(bounds, f"_group {kind}, _size double, _bound long")
    hashed = rows.withColumn("_hash", order)
    low = -(1 << 63)
    part = (F.col("_hash").cast("double") - float(low)) / float(span)
    due = F.col("_n") * (2.0 * most) / F.col("_size")
    once = (F.col("_n") == 1) & (F.col("_hash") <= F.col("_bound"))
    many = F.least(F.floor(due) + (part < due - F.floor(due)).cast("long"), F.col("_n"))
    counted = (
        hashed.groupBy(F.col(group).alias("_group"), "_hash").agg(F.count("*").alias("_n"))
        .join(F.broadcast(below), "_group")
        .withColumn("_times", F.when(F.col("_n") == 1, once.cast("long")).otherwise(many))
        .where("_times > 0")
    )
    others = [c for c in rows.columns if c != group]
    same = (F.col(group) == F.col("_group")) & (hashed["_hash"] == F.col("_h"))
    chosen = hashed.join(F.broadcast(counted.withColumnRenamed("_hash", "_h")), same).groupBy("_group", "_h", "_n", "_times", "_bound").agg(
        F.min(F.struct(*others)).alias("_row")
    )
    width = F.col("_bound").cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)") + 1
    own = (F.pmod(F.xxhash64("_h", "_copy").cast("decimal(38,0)"), width) + F.lit(low).cast("decimal(38,0)")).cast("long")
    each = chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).withColumn(
        "_order", F.when(F.col("_n") == 1, F.col("_h")).otherwise(own)
    )
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_order", "_h", "_copy"))
    return each.withColumn("_place", place).where(F.col("_place") <= most).select(
        F.col("_group").alias(group), *(F.col("_row")[c].alias(c) for c in others), "_order"
    )


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Regroup the batches of a partition sorted by ``keys`` into frames of whole groups.

    A frame has about ``rows`` rows, or one group where that is larger.
    """
    kept: list[pd.DataFrame] = []
    held = 0
    for batch in batches:
        if batch.empty:
            continue
        kept.append(batch)
        held += len(batch)
        if held < rows:
            continue
        frame = pd.concat(kept, ignore_index=True)
        last = np.ones(len(frame), dtype=bool)
        for key in keys:
            last &= (frame[key] == frame[key].iloc[-1]).to_numpy()
        start = len(frame) - int(last.sum())
        if start:
            yield frame.iloc[:start].reset_index(drop=True)
        kept, held = [frame.iloc[start:].reset_index(drop=True)], len(frame) - start
    if kept:
        yield pd.concat(kept, ignore_index=True)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of undirected ``edges`` (a, b); component is the smallest node.

    Alternating large-star and small-star rounds, each a shuffle join on a node and its smallest
    neighbour. Every round is cut with a checkpoint. A node of very high degree is split by the
    skew join; only the number of changed edges comes to the driver.
    """

    def least(pairs: DataFrame) -> DataFrame:
        lowest = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(lowest, "u")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        return (
            least(both)
            .where("v > u")
            .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
            .distinct()
        )

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        joined = least(down)
        return (
            joined.where("v <> m")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )

    def mark(e: DataFrame) -> tuple:
        # the edge set as two numbers, whatever the order of its rows
        return tuple(
            e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    current = cut(edges.where("a <> b").select("a", "b").distinct())
    before = mark(current)
    for _ in range(max_rounds):
        current = cut(small_star(large_star(current)))
        after = mark(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
