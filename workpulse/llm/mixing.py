"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times that the mix wants it, between 0 and C copies. Among all
rates r that give each source its target of words, the chosen ones have the least binary relative entropy of r / C
against 1 / C, summed over the documents: r ln r + (C - r) ln((C - r) / (C - 1)). They are exponentially tilted: with
a document's size x in units of its source's mean the rate is
``C e^(l x) / (C - 1 + e^(l x))``, where l solves the convex dual of the source's token constraint.
All duals are solved together by Newton steps, each one aggregation over the (source, size) counts, kept inside a
bracket; after ``MAX_STEPS`` of them the bracket is halved until it closes. Rates are then rounded into whole copies:
within blocks of a source, from the largest document to the smallest, a document gets one copy more when the words
still owed reach half its size, so that a block ends off by about half its smallest document. Rows equal in id,
tie and size are one counted row until then, so that a block is bounded however often a row repeats.

Targets: the sources share all words by their weights (cycled over the sources by code point, null
last); a target stops at C times its source's words, and the excess is shared anew by weight.

Defined cases: a null text has size 0; documents of size 0 get rate 1 and take nothing; a null source
is a source; rows equal in id and size are interchangeable, and reruns agree; an empty table gives an
empty result; extra columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workpulse.llm.common import cut, row_hash, word_count

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Documents of one source that are rounded together.
BLOCK_DOCS = 4096
MAX_STEPS = 80
#: A bracket of two numbers closes in far fewer halvings, whatever its ends.
HALVINGS = 1200
TOLERANCE = 1e-7
#: Equal rows that are dealt out together.
DEAL = 4096


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``sizes`` (source, source_size, one row each) with ``place`` (1, 2, ...) and ``target``.

    The windows are over one row for each source, not over documents.
    """
    shares = F.array(*(F.lit(float(w)) for w in weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everywhere = Window.partitionBy()
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(shares, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
        .withColumn("most", max_copies * F.col("source_size"))
        .withColumn("room", F.col("most") / F.col("weight"))
    )
    # fill from the source that is full first: level = what is left / weights that are left, at the
    # first source that it doesn't fill (it only falls after that one)
    level = (
        F.sum("source_size").over(everywhere) - (F.sum("most").over(by_room) - F.col("most"))
    ) / (F.sum("weight").over(everywhere) - F.sum("weight").over(by_room) + F.col("weight"))
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(everywhere))
        .withColumn("target", F.least(F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight")))
        .select("place", "source", "source_size", "target")
    )


def tilted_rate(tilt: Column, size: Column, mean: Column, max_copies: int) -> Column:
    """C e^y / (C - 1 + e^y) with y = tilt * size / mean, without overflow."""
    y = tilt * size / mean
    return max_copies / (1 + (max_copies - 1) * F.exp(-F.greatest(F.least(y, F.lit(700.0)), F.lit(-700.0))))


def solve_duals(
    counts: DataFrame, sources: DataFrame, max_copies: int = MAX_COPIES, max_steps: int = MAX_STEPS
) -> DataFrame:
    """(place, tilt, mean): the tilt of each source from ``counts`` (place, size, n) and its target.

    A source whose target is all it can give, or nothing, needs no step: its tilt is plus or minus
    infinity. One row for each source is kept; only whether some are open comes to the driver.
    """
    means = counts.where("size > 0").groupBy("place").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    full = F.col("target") >= max_copies * F.col("source_size") * (1 - 1e-12)
    state = cut(
        sources.join(means, "place").select(
            "place", "mean", "target",
            F.when(full, float("inf")).when(F.col("target") <= 0, float("-inf")).otherwise(0.0).alias("tilt"),
            F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
            (full | (F.col("target") <= 0)).alias("done"),
        )
    )
    rows = counts.where("size > 0")
    for step in itertools.count():
        if state.where("not done").isEmpty():
            break
        if step > max_steps + HALVINGS:
            raise RuntimeError(f"the tilt of a source did not settle in {step} steps")
        rate = tilted_rate(F.col("tilt"), F.col("size"), F.col("mean"), max_copies)
        words = F.col("n") * F.col("size")
        sums = (
            rows.join(state.where("not done"), "place")
            .groupBy("place")
            .agg(
                F.sum(words * rate).alias("value"),
                F.sum(words * rate * (1 - rate / max_copies) * F.col("size") / F.col("mean")).alias("slope"),
            )
        )
        over = F.col("value") > F.col("target")
        low = F.when(over, F.col("low")).otherwise(F.col("tilt"))
        high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - (F.col("value") - F.col("target")) / F.greatest(F.col("slope"), F.lit(1e-300))
        reach = 2 * F.greatest(F.abs("tilt"), F.lit(1.0))
        # outside the bracket: halve it, or step out while it has an open end
        inside = (
            F.when(F.col("low") == float("-inf"), F.greatest(newton, F.col("tilt") - reach))
            .when(F.col("high") == float("inf"), F.least(newton, F.col("tilt") + reach))
            .otherwise(
                F.when((newton > F.col("low")) & (newton < F.col("high")) & F.lit(step < max_steps), newton)
                .otherwise((F.col("low") + F.col("high")) / 2)
            )
        )
        near = F.abs(F.col("value") - F.col("target")) <= TOLERANCE * F.col("target")
        # the bracket has closed to one number: no rate gets closer in double precision
        closed = (F.col("high") - F.col("low")) <= 1e-13 * F.greatest(F.abs("tilt"), F.lit(1.0))
        stepped = (
            state.join(sums, "place", "left")
            .withColumn("low", F.when(F.col("done"), F.col("low")).otherwise(low))
            .withColumn("high", F.when(F.col("done"), F.col("high")).otherwise(high))
        )
        state = cut(
            stepped.select(
                "place", "mean", "target",
                F.when(F.col("done") | near, F.col("tilt")).otherwise(inside).alias("tilt"),
                "low", "high",
                (F.col("done") | near | closed).alias("done"),
            )
        )
    return state.select("place", "tilt", "mean")


def extra_copies(owed: float, size: int, part: float, n: int) -> int:
    """How many of ``n`` equal documents get one copy more, each when the words owed, ``part`` of its size
    more with every document, reach half its size."""
    if part <= 0 or not size:
        return 0
    return min(n, max(0, math.floor((owed + n * part * size) / size + 0.5)))


def _round(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole copies from rates, with the words owed carried from document to document."""
    frame = frame.sort_values(["size", "tie", "id"], ascending=[False, True, True], kind="stable")
    owed, whole, extra = 0.0, [], []
    for size, rate, n in zip(frame["size"].tolist(), frame["rate"].tolist(), frame["n"].tolist(), strict=True):
        least = int(rate)
        more = extra_copies(owed, size, rate - least, n)
        owed += n * (rate - least) * size - more * size
        whole.append(least)
        extra.append(more)
    frame["copies"], frame["extra"] = whole, extra
    return frame[["id", "tie", "place", "size", "rate", "n", "copies", "extra"]]


def _mixed(
    docs: DataFrame, weights: tuple[float, ...], max_copies: int, block_docs: int
) -> tuple[DataFrame, DataFrame]:
    """From (id, tie, source, size): (id, tie, place, size, rate, n, copies, extra), and the sources.

    A row stands for ``n`` equal ones, of which ``extra`` get one more than ``copies``.
    """
    docs = cut(docs.groupBy("id", "tie", "source", "size").agg(F.count("*").alias("n")))
    counted = cut(docs.groupBy("source", "size").agg(F.sum("n").alias("n")))
    sources = cut(
        source_targets(
            counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, max_copies
        )
    )
    placed = counted.join(sources.select("place", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
    counts = cut(placed.select("place", "size", "n"))
    duals = solve_duals(counts, sources, max_copies)
    blocks = counts.groupBy("place").agg(F.ceil(F.sum("n") / block_docs).alias("blocks"))
    known = sources.join(blocks, "place").join(duals, "place", "left").select(
        "place", F.col("source").alias("name"), "blocks", "tilt", "mean"
    )
    rate = (
        F.when((F.col("size") == 0) | F.col("mean").isNull(), 1.0)
        .when(F.col("tilt") == float("inf"), float(max_copies))
        .when(F.col("tilt") == float("-inf"), 0.0)
        .otherwise(tilted_rate(F.col("tilt"), F.col("size"), F.col("mean"), max_copies))
    )
    # ids go to pandas as text: next to a null it would make long integers floating-point numbers
    rated = docs.join(known, F.col("source").eqNullSafe(F.col("name"))).select(
        F.col("id").cast("string").alias("id"), "tie", "place", "size", rate.alias("rate"), "n",
        F.pmod(F.xxhash64("tie", "size"), F.col("blocks")).alias("block"),
    )
    kind = dict(docs.dtypes)["id"]
    rounded = rated.groupBy("place", "block").applyInPandas(
        _round, "id string, tie long, place int, size long, rate double, n long, copies long, extra long"
    )
    return rounded.withColumn("id", F.col("id").cast(kind)), sources


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target``, ``taken``, ``rate`` and ``copies``."""
    sized = docs.select(
        docs[id_col].alias("id"), F.xxhash64(docs[id_col]).alias("tie"), docs[source].alias("source"), word_count(docs[text]).alias("size")
    )
    counted, sources = _mixed(sized, weights, max_copies, block_docs)
    # equal rows again one by one, in runs of DEAL
    kinds = F.array(
        F.struct(F.col("extra").alias("times"), (F.col("copies") + 1).cast("int").alias("each")),
        F.struct((F.col("n") - F.col("extra")).alias("times"), F.col("copies").cast("int").alias("each")),
    )
    runs = counted.select("id", "place", "size", "rate", F.inline(kinds)).where("times > 0")
    runs = runs.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(DEAL).cast("long"))))
    left = F.least(F.col("times") - F.col("run"), F.lit(DEAL).cast("long")).cast("int")
    rounded = runs.select("id", "place", "size", "rate", F.col("each").alias("copies"), F.explode(F.sequence(F.lit(1), left)).alias("one"))
    return rounded.join(sources.select("place", "source_size", "target"), "place").select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies"
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with ``copy`` (1, 2, ...).

    A column of ``docs`` that is itself named ``copy`` gives way to it.
    """
    columns = [docs[c] for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), row_hash(docs).alias("_hash"))
    sized = keyed.select(
        F.col(f"_row.{id_col}").alias("id"), F.col("_hash").alias("tie"), F.col(f"_row.{source}").alias("source"),
        word_count(F.col(f"_row.{text}")).alias("size"),
    )
    rounded, _ = _mixed(sized, weights, max_copies, block_docs)
    # rows equal in every column share a key: their copies add up on one of them
    added = F.sum(F.col("n") * F.col("copies") + F.col("extra"))
    copies = rounded.groupBy("tie", "id").agg(added.alias("_copies")).where("_copies > 0")
    keyed = keyed.withColumn("_id", F.col(f"_row.{id_col}"))
    joined = keyed.join(copies, (F.col("_hash") == copies["tie"]) & F.col("_id").eqNullSafe(copies["id"]))
    one_each = joined.dropDuplicates(["_hash", "_id"])
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c.lower() != "copy"]
    # in runs of DEAL: a row that repeats without end makes no array of that length
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(DEAL).cast("long"))).alias("_run")
    dealt = one_each.select(*(c.alias(f"_c{i}") for i, c in enumerate(kept)), "_copies", runs)
    left = F.least(F.col("_copies") - F.col("_run"), F.lit(DEAL).cast("long"))
    each = dealt.select(*(f"_c{i}" for i in range(len(kept))), "_run", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_one"))
    names = [c for c in docs.columns if c.lower() != "copy"]
    return each.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)), (F.col("_run") + F.col("_one")).cast("int").alias("copy"))
