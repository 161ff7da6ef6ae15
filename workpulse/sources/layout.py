"""Read layouts: how the rows of a published table are dealt to files and sorted in them.

A layout stands for the index statements of a row store. ``partition_by`` makes folders (pruned by name),
``cluster_by`` lays several look-up keys along a space-filling curve, so that a row group covers a small range of each of
them, ``sort_by`` sorts inside files, ``bloom`` adds Parquet Bloom filters, and ``ordered`` makes one
order through all files.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

#: Size of a file that a write aims at, in bytes before compression as ``row_bytes`` estimates them.
FILE_BYTES = 512 << 20
#: Ranges of a clustered column: a power of two.
RANGE_BITS = 8
#: Rows of the sample that the ranges come from: about 40 for each range.
SAMPLE_ROWS = 10_000


@dataclass(frozen=True)
class Layout:
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    #: one order by ``sort_by`` over all files: a file's rows come after those of the files before it
    ordered: bool = False
    file_bytes: int = FILE_BYTES
    row_group_bytes: int | None = None


def row_bytes(df: DataFrame) -> Column:
    """A row's size, estimated: the length of its text and binary columns and 8 bytes for any other."""
    sized = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    fixed = F.lit(8 * (len(df.columns) - len(sized)))
    return sum(sized, fixed).cast("bigint")


@dataclass(frozen=True)
class WritePlan:
    """First task and number of tasks of each partition value; ``tasks`` in all."""

    slots: list[tuple]
    tasks: int

    @property
    def files(self) -> int:
        """Most files that the write makes: one for each value and task that holds it."""
        return sum(s[-1] for s in self.slots)


def plan_write(sizes: Sequence[tuple], file_bytes: int) -> WritePlan:
    """Deal (*value, bytes) to tasks of about ``file_bytes``: a large value gets several tasks of its own, small
    ones that follow each other share a task. Files are at most the values plus all bytes / ``file_bytes``."""
    slots, task, filled = [], 0, 0
    for *value, size in sizes:
        own = size // file_bytes
        if own:
            # the value's own tasks share its bytes evenly; a new task begins after them
            task += filled > 0
            slots.append((*value, task, own))
            task, filled = task + own, 0
            continue
        if filled and filled + size > file_bytes:
            task, filled = task + 1, 0
        slots.append((*value, task, 1))
        filled += size
    return WritePlan(slots, task + (filled > 0))


def sampled_bounds(
    df: DataFrame, columns: Sequence[str], total: int, bits: int = RANGE_BITS, sample_rows: int = SAMPLE_ROWS
) -> list[list]:
    """For each column 2 ** bits - 1 values, ascending, that part it into ranges of about as many rows.

    The sample has about ``2 * sample_rows`` of the ``total`` rows, at most twice that, whatever the table. It is
    all that comes to the driver, and decides only how well the ranges are balanced.
    """
    rows = df.select(*columns)
    some = rows.sample(2 * sample_rows / total, seed=7) if total > 2 * sample_rows else rows
    sample = some.limit(4 * sample_rows).collect()
    ranges, out = 1 << bits, []
    for column in columns:
        values = sorted(r[column] for r in sample if r[column] is not None)
        out.append([values[i * len(values) // ranges] for i in range(1, ranges)] if values else [])
    return out


def range_number(column: Column, bounds: list, kind: str) -> Column:
    """How many of the ascending ``bounds`` are not above the value; 0 for null. Two steps of about 16 comparisons."""
    if not bounds:
        return F.lit(0)
    step = 16
    literal = lambda values: F.array(*(F.lit(v) for v in values)).cast(f"array<{kind}>")
    count = lambda values: F.size(F.filter(values, lambda b: b <= column))
    coarse = count(literal(bounds[step - 1 :: step])) if len(bounds) >= step else F.lit(0)
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    fine = F.element_at(F.array(*map(literal, blocks)), F.least(coarse, F.lit(len(blocks) - 1)) + 1)
    return F.when(column.isNull(), 0).otherwise(F.least(coarse, F.lit(len(blocks) - 1)) * step + count(fine)).cast("int")


def curve(numbers: Sequence[Column], bits: int = RANGE_BITS) -> Column:
    """Place on the Z-order curve: the bits of the range numbers, interleaved."""
    place = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("bigint")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(numbers) + i))
    return place


def curve_of(value: Sequence, bounds: Sequence[list], bits: int = RANGE_BITS) -> int:
    """``curve`` of plain values."""
    numbers = [0 if v is None else bisect.bisect_right(b, v) for v, b in zip(value, bounds, strict=True)]
    return sum(((n >> bit) & 1) << (bit * len(numbers) + i) for bit in range(bits) for i, n in enumerate(numbers))


def histogram(df: DataFrame, by: Sequence[str], size: Column) -> tuple[list[tuple], int]:
    """(*by, bytes) in order, and the number of rows: one row for each partition value, of which the table has as
    many as folders."""
    rows = df.groupBy(*by).agg(F.sum(size), F.count(F.lit(1))).orderBy(*(F.asc_nulls_first(c) for c in by)).collect()
    return [tuple(r)[:-1] for r in rows], sum(r[-1] for r in rows)


def arranged(df: DataFrame, layout: Layout, histogram_of: DataFrame | None = None) -> DataFrame:
    """``df`` dealt to write tasks and sorted in them as the layout asks, with helper columns (``_task``, ``_place``).

    With ``partition_by`` one shuffle brings a value's rows to the tasks that ``plan_write`` gives it from the
    (value, bytes) histogram of ``histogram_of`` (default ``df``; pass a cheaper input with the same partition
    and clustered columns where ``df`` holds a join or a rollup: it decides balance and file sizes, never rows). Among a value's tasks the rows are dealt by their place on the curve, or by a
    hash where there is none.
    """
    if layout.ordered:
        # sampled ranges: a task has the rows between two bounds, its file comes in that order
        return df.orderBy(*layout.sort_by)
    out, place = df, None
    if not layout.partition_by and not layout.cluster_by:
        return df.sortWithinPartitions(*layout.sort_by) if layout.sort_by else df
    # two cheap reads of ``base``: sizes by partition value, then a sample of the look-up keys
    base = df if histogram_of is None else histogram_of
    # a column that the cheaper input lacks counts 8 bytes
    size = row_bytes(base) + F.lit(8 * max(0, len(df.columns) - len(base.columns)))
    sizes, total = histogram(base, layout.partition_by, size)
    if layout.cluster_by:
        kinds = dict(df.dtypes)
        bounds = sampled_bounds(base, layout.cluster_by, total)
        numbers = [range_number(F.col(c), b, kinds[c]) for c, b in zip(layout.cluster_by, bounds, strict=True)]
        out, place = out.withColumn("_place", curve(numbers)), F.col("_place")
    if layout.partition_by:
        plan = plan_write(sizes, layout.file_bytes)
        kinds = dict(df.dtypes)
        slots = df.sparkSession.createDataFrame(
            plan.slots, ", ".join(f"`_p_{c}` {kinds[c]}" for c in layout.partition_by) + ", _first int, _own int"
        )
        same = [out[c].eqNullSafe(slots[f"_p_{c}"]) for c in layout.partition_by]
        out = out.join(F.broadcast(slots), same, "left")
        top = 1 << (RANGE_BITS * max(1, len(layout.cluster_by)))
        spread = F.floor(place * F.col("_own") / top) if place is not None else F.pmod(F.xxhash64(*df.columns), F.col("_own"))
        # a value that the histogram has not seen goes to the first task
        task = F.coalesce(F.col("_first") + spread, F.lit(0)).cast("int")
        out = out.withColumn("_task", task).drop("_first", "_own", *(f"_p_{c}" for c in layout.partition_by))
        out = out.repartitionById(max(1, plan.tasks), F.col("_task"))
    elif place is not None:
        out = out.repartitionByRange("_place")
    order = [*layout.partition_by, *(["_place"] if place is not None else []), *layout.sort_by]
    return out.sortWithinPartitions(*order) if order else out


def writer(df: DataFrame, layout: Layout) -> DataFrameWriter:
    out = df.write.mode("errorifexists").format("parquet")
    if layout.partition_by:
        out = out.partitionBy(*layout.partition_by)
    for column in layout.bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if layout.bloom:
        # as large as the ids of a row group need
        out = out.option("parquet.bloom.filter.adaptive.enabled", "true")
    if layout.row_group_bytes:
        out = out.option("parquet.block.size", str(layout.row_group_bytes))
    return out
