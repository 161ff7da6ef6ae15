"""Write plans, space-filling-curve clustering and Bloom filters: files, row groups and what a look-up reads."""

from __future__ import annotations

import glob
import os
import random
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from workpulse.sources import Layout, current_version, plan_write, read_published, refresh
from workpulse.sources.layout import curve, curve_of, range_number, sampled_bounds


def _files(spark, path):
    return sorted(glob.glob(os.path.join(path, current_version(spark, path).folder, "**", "*.parquet"), recursive=True))


def test_plan_bounds_files_and_tasks():
    rng = random.Random(1)
    for target in (1, 10, 1000):
        sizes = [(d, rng.choice([1, 3, 50, 5000])) for d in range(rng.randrange(1, 60))]
        plan = plan_write(sizes, target)
        total = sum(s for _, s in sizes)
        assert [s[0] for s in plan.slots] == [d for d, _ in sizes]
        assert plan.files <= len(sizes) + total / target
        tasks = [set(range(first, first + own)) for _, first, own in plan.slots]
        assert set().union(*tasks) <= set(range(plan.tasks + 1))
        load = dict.fromkeys(range(plan.tasks + 1), 0.0)
        for (_, size), own in zip(sizes, tasks, strict=True):
            for t in own:
                load[t] += size / len(own)
        assert max(load.values()) <= 3 * target
        # a large value's tasks are its own
        for (_, size), own in zip(sizes, tasks, strict=True):
            if len(own) > 1:
                assert sum(bool(own & other) for other in tasks) == 1
    assert plan_write([], 10).tasks == 0


def test_files_of_a_table_that_comes_from_a_join_by_user(spark):
    """16 tasks that each hold all of 60 dates would write 960 files; the plan writes one or few for each date."""
    path = os.path.join(tempfile.mkdtemp(prefix="wp-layout-", dir="/tmp"), "t")
    days = 60
    # the first date has a third of the rows
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % days)
    df = spark.range(30_000).select("id", (F.col("id") % 500).alias("user_id"), F.lit("x" * 20).alias("text"),
                                    F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("date"))
    users = spark.range(500).select(F.col("id").alias("user_id"), F.concat(F.lit("u"), "id").alias("name"))
    joined = df.repartition(16, "user_id").join(users.hint("shuffle_hash"), "user_id")
    size = 30_000 * (8 * 3 + 24)
    refresh(joined, path, Layout(("date",), ("user_id",), file_bytes=size // 30), histogram_of=df)
    files = _files(spark, path)
    assert len(files) <= days + 30
    assert sum("date=2024-01-01" in f for f in files) >= 8  # the large date is several files, of like size
    rows = [pq.ParquetFile(f).metadata.num_rows for f in files if "date=2024-01-01" in f]
    assert max(rows) < 2 * sum(rows) / len(rows)
    assert read_published(spark, path).count() == 30_000


def test_range_numbers_and_curve(spark):
    rng = random.Random(3)
    values = [rng.choice([None, "u%03d" % rng.randrange(300)]) for _ in range(800)]
    other = [rng.choice([None, rng.randrange(-50, 50), 7]) for _ in range(800)]  # 7 is hot
    df = spark.createDataFrame(list(zip(values, other, strict=True)), "a string, b long")
    bounds = sampled_bounds(df, ("a", "b"), 800)
    got = df.select("a", "b", curve([range_number(F.col("a"), bounds[0], "string"), range_number(F.col("b"), bounds[1], "bigint")]).alias("z"))
    assert all(r["z"] == curve_of((r["a"], r["b"]), bounds) for r in got.collect())
    none = sampled_bounds(df.where("false"), ("a", "b"), 0)
    assert none == [[], []]
    assert df.select(range_number(F.col("a"), [], "string").alias("n")).distinct().collect()[0]["n"] == 0


@pytest.fixture(scope="module")
def clustered(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="wp-cluster-", dir="/tmp"), "t")
    h = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    df = spark.range(200_000).select(
        "id", F.concat(F.lit("U"), F.lpad(h(1, 5000).cast("string"), 5, "0")).alias("user_id"),
        F.concat(F.lit("A"), F.lpad(h(2, 400).cast("string"), 4, "0")).alias("account_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), h(3, 4).cast("int")).alias("date"))
    layout = Layout(("date",), cluster_by=("user_id", "account_id"), bloom=("user_id", "account_id"),
                    file_bytes=100_000, row_group_bytes=32_000)
    refresh(df, path, layout)
    return path


def _share(files, column, value):
    """Share of the row groups whose statistics let them hold the value."""
    groups = hits = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups += 1
            hits += s.min <= value <= s.max
    return hits / groups, groups


def test_each_key_alone_reads_a_small_share(spark, clustered):
    files = _files(spark, clustered)
    for column, values in (("user_id", [f"U{i:05d}" for i in range(0, 5000, 97)]), ("account_id", [f"A{i:04d}" for i in range(0, 400, 9)])):
        shares = [_share(files, column, v) for v in values]
        assert shares[0][1] > 100
        # about 1.8 over the root of a date's row groups (52 here); a key at a border of the curve is in more of them
        assert sum(s for s, _ in shares) / len(shares) <= 0.28 and max(s for s, _ in shares) <= 0.5, (column, shares)
    both = [f for f in files if "date=2024-01-02" in f]
    assert 0.2 < len(both) / len(files) < 0.3  # a date is its folder


def test_bloom_filters_are_written(spark, clustered):
    # a filter for each id column and row group makes the files larger than their columns
    file = _files(spark, clustered)[0]
    meta = pq.ParquetFile(file).metadata
    columns = sum(meta.row_group(g).column(c).total_compressed_size for g in range(meta.num_row_groups) for c in range(meta.num_columns))
    assert os.path.getsize(file) > columns + meta.num_row_groups * 2 * 32
    table = read_published(spark, clustered)
    one = table.where("user_id = 'U01234' and account_id = 'A0200'").count()
    assert one == sum(r["user_id"] == "U01234" and r["account_id"] == "A0200" for r in table.select("user_id", "account_id").collect())
