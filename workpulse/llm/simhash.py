"""SimHash near-duplicates: 64-bit fingerprints linked by a binary-trie self-join.

A fingerprint bit is 1 if it is set in more than half of the XXH64 hashes of the text's word
shingles. Two fingerprints link when they differ in at most ``max_bits`` bits; groups are the
connected components of these links.

The self-join walks a binary trie with itself. A pair of nodes stands for two sets of fingerprints
with their bits so far fixed; going down one bit makes up to four child pairs, the unequal ones cost
one error, and a pair beyond the budget is pruned. To run it on many machines the root is cut into
many: ``max_bits + 1`` disjoint blocks of bits must hold one on which two linked fingerprints agree,
so the trie is walked once for each block, over the groups of fingerprints equal in that block. A
group with more than ``GROUP_ROWS`` fingerprints is cut again in the same way over its other bits
(again exact), until few enough bits are left that it is small by itself. Only distinct fingerprints
take part, so copies are never paired, and a group hands on a spanning forest of its links, never all
of its pairs.

Defined cases: a null text is the empty text; a text without words has fingerprint zero and links like
any other; a null id never becomes a group's id unless the group has no other; repeated rows are
copies; an empty table gives an empty result; columns beyond those named are ignored by
``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import connected_components, cut, row_hash, text_or_empty, whole_groups

BITS = 64
SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Largest group of fingerprints that one trie walk takes; larger ones are cut over further bits.
GROUP_ROWS = 1024
#: Sum of squared group sizes that one vectorised walk takes at once; bounds its memory.
WALK_PAIRS = 2_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = np.array([digest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        runs = zip(*(words[i:] for i in range(shingle)), strict=False)
        hashes = np.fromiter(
            (digest(b" ".join(run), SEED) for run in runs), dtype=np.uint64, count=len(words) - shingle + 1
        )
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` in the single column ``_row`` (a struct), and ``_fp``, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = [fingerprint(t, shingle) for t in texts]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return docs.select(F.struct("*").alias("_row"), of(text_or_empty(docs[text])).alias("_fp"))


def walk_tries(groups: np.ndarray, values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) in one group whose values differ in at most ``max_bits`` bits.

    ``groups`` and, in each group, the unsigned ``values`` ascend; values of a group are distinct. A
    node is a range of positions with equal leading bits; all node pairs of a level go down together.
    """
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]).astype(np.int64)
    ends = np.r_[starts[1:], len(groups)]
    many = ends - starts > 1
    # pairs (node, other node) as four positions and the errors so far; a self pair has equal nodes
    own_lo, own_hi = starts[many], ends[many]
    a_lo = a_hi = b_lo = b_hi = np.empty(0, dtype=np.int64)
    err = np.empty(0, dtype=np.int64)
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []
    for bit in range(BITS - 1, -1, -1):
        if not len(own_lo) and not len(a_lo):
            break
        ones = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)]

        def middle(lo, hi, ones=ones):
            return hi - (ones[hi] - ones[lo])

        a_mid, b_mid, own_mid = middle(a_lo, a_hi), middle(b_lo, b_hi), middle(own_lo, own_hi)
        a_lo, a_hi, b_lo, b_hi, err = (
            np.concatenate(x)
            for x in (
                (a_lo, a_mid, a_lo, a_mid, own_lo),
                (a_mid, a_hi, a_mid, a_hi, own_mid),
                (b_lo, b_mid, b_mid, b_lo, own_mid),
                (b_mid, b_hi, b_hi, b_mid, own_hi),
                (err, err, err + 1, err + 1, np.ones(len(own_lo), dtype=np.int64)),
            )
        )
        keep = (a_hi > a_lo) & (b_hi > b_lo) & (err <= max_bits)
        a_lo, a_hi, b_lo, b_hi, err = a_lo[keep], a_hi[keep], b_lo[keep], b_hi[keep], err[keep]
        own_lo, own_hi = np.r_[own_lo, own_mid], np.r_[own_mid, own_hi]
        many = own_hi - own_lo > 1
        own_lo, own_hi = own_lo[many], own_hi[many]
        # two single leaves: what is left of their paths is one comparison
        leaf = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if leaf.any():
            i, j = a_lo[leaf], b_lo[leaf]
            near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
            out_a.append(np.minimum(i, j)[near])
            out_b.append(np.maximum(i, j)[near])
            rest = ~leaf
            a_lo, a_hi, b_lo, b_hi, err = a_lo[rest], a_hi[rest], b_lo[rest], b_hi[rest], err[rest]
    if not out_a:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def smallest_reachable(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``size`` positions the smallest position that the links (a, b) reach."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b, label[a], label[b]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _cut_masks(mask: int, parts: int) -> list[int]:
    """``mask`` joined with each of ``parts`` equal shares of the bits that it leaves out."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    shares = np.array_split(np.array(free), parts)
    return [mask | sum(1 << int(b) for b in share) for share in shares]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _trie_groups(distinct: DataFrame, max_bits: int, group_rows: int) -> DataFrame:
    """(mask, key, fp): each fingerprint in the groups that are to be walked."""
    parts = max_bits + 1

    def spread(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
        if len(masks) == 1:
            each = F.array(*(F.lit(_signed(x)) for children in masks.values() for x in children))
            return keyed(rows.select("fp", F.explode(each).alias("mask")))
        cases = rows.sparkSession.createDataFrame(
            [(_signed(m), [_signed(x) for x in children]) for m, children in masks.items()],
            "mask long, children array<long>",
        )
        # one row for each mask of this level: at most parts ** levels, whatever the data
        return keyed(rows.join(F.broadcast(cases), "mask").select("fp", F.explode("children").alias("mask")))

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")

    masks = {0: _cut_masks(0, parts)}
    rows = spread(distinct.select("fp"), masks)
    done: list[DataFrame] = []
    while True:
        level = [m for children in masks.values() for m in children]
        left = BITS - max(m.bit_count() for m in level)
        if left < parts or 2**left <= group_rows:
            break
        hot = cut(rows.groupBy("mask", "key").count().where(F.col("count") > group_rows).drop("count"))
        if hot.isEmpty():
            break
        done.append(rows.join(hot, ["mask", "key"], "left_anti"))
        masks = {m: _cut_masks(m, parts) for m in level}
        rows = cut(spread(rows.join(hot, ["mask", "key"], "left_semi"), masks))
    for part in done:
        rows = rows.unionByName(part)
    return rows


def fingerprint_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Links (a, b) that connect what the near pairs of the distinct fingerprints ``fp`` connect.

    Of each group walked it keeps a spanning forest: at most one row less than the group has.
    """

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["mask", "key"], 200_000):
            same = (frame["mask"].diff().fillna(1) == 0) & (frame["key"].diff().fillna(1) == 0)
            number = np.cumsum(~same.to_numpy())
            signed = frame["fp"].to_numpy(dtype=np.int64)
            # the groups are sorted by signed value: the top bit, flipped, makes the order unsigned
            order = np.ascontiguousarray(signed).view(np.uint64) ^ np.uint64(1 << (BITS - 1))
            _, first, sizes = np.unique(number, return_index=True, return_counts=True)
            load = np.cumsum(sizes.astype(np.int64) ** 2) // WALK_PAIRS
            cuts = np.r_[first[np.flatnonzero(np.r_[True, load[1:] != load[:-1]])], len(frame)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                a, b = walk_tries(number[lo:hi], order[lo:hi], max_bits)
                label = smallest_reachable(hi - lo, a, b)
                child = np.flatnonzero(label != np.arange(hi - lo))
                if len(child):
                    yield pd.DataFrame({"a": signed[lo + child], "b": signed[lo + label[child]]})

    groups = _trie_groups(distinct, max_bits, group_rows)
    return (
        groups.repartition("mask", "key")
        .sortWithinPartitions("mask", "key", "fp")
        .mapInPandas(walk, "a long, b long")
        .distinct()
    )


def _classes(marked: DataFrame, order, max_bits: int) -> DataFrame:
    """(fp, first): of each fingerprint, the least ``order`` in its component."""
    distinct = cut(marked.groupBy("fp").agg(F.min(order).alias("own")))
    parts = connected_components(fingerprint_links(distinct.select("fp"), max_bits))
    linked = parts.withColumnRenamed("node", "fp").join(distinct, "fp")
    least = linked.groupBy("component").agg(F.min("own").alias("least"))
    found = linked.join(least, "component").select("fp", "least")
    return distinct.join(found, "fp", "left").select("fp", F.coalesce("least", "own").alias("first"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row for each row: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    The classes are cut so that the last join has a shuffle on both sides: the rows of a fingerprint that
    very many share are then split over tasks.
    """
    pairs = docs.select(docs[id_col].alias(id_col), docs[text].alias(text))
    marked = cut(with_fingerprint(pairs, text, shingle).select(F.col(f"_row.{id_col}").alias("id"), F.col("_fp").alias("fp")))
    classes = cut(_classes(marked, F.col("id"), max_bits))
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (nulls last).

    Rows of one id are told apart by a hash of all columns; of rows equal in every column one stays.
    """
    columns = [docs[c] for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), row_hash(docs).alias("_hash"))
    flat = keyed.select(F.col(f"_row.{id_col}").alias("id"), "_hash", F.col(f"_row.{text}").alias("text"))
    marked = cut(
        with_fingerprint(flat, "text", shingle).select("_row.id", F.col("_row._hash").alias("hash"), F.col("_fp").alias("fp"))
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    stays = _classes(marked, order, max_bits).select("first.id", "first.hash").distinct()
    # equal rows share hash and id, so that one shuffle serves the join and the last dedupe
    keyed = keyed.withColumn("_id", F.col(f"_row.{id_col}"))
    kept = keyed.join(stays, (F.col("_hash") == stays["hash"]) & F.col("_id").eqNullSafe(stays["id"]), "left_semi")
    return kept.dropDuplicates(["_hash", "_id"]).select("_row.*")
