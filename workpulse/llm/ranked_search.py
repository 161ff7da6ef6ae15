"""Ranked lexical search over impact lists by the Best Position Algorithm.

One pass over the documents keeps, of each, its number of terms and the frequencies of the terms that some item
asks for; its sums give the corpus statistics. A shard is a block of about ``BLOCK_POSTINGS`` postings. In it each
term has an impact list: its documents by falling impact. An item reads its lists side by side, some positions
deeper in each round. A document met for the first time is looked up directly in all the other lists, which gives its
whole score and its position in each of them. Every list keeps its best position: the end of the run of
positions from the top that have all been seen, by reading or by direct access. Any document not seen yet lies behind the
best positions, so its score is at most the sum of the impacts that follow them. The search ends when that sum
is strictly below the k-th score found: with an equal score a smaller id could still win. The k best
of the blocks before it in the same task count from the start. The k best of all tasks are ranked in Spark.

The items are the query set and are taken in parts of about ``PART_CHARS`` characters, each searched by itself with
the same result; only a part, its term weights and its index of lists per block are in memory.

A term's impact is floor(weight * saturated frequency) in 64-bit integers, as ``saturation`` and ``weights`` define.

Defined cases: null and empty texts have no term and match nothing; a very long text is one document of the
same index; equal scores rank by ascending id, nulls first, repeated rows of one id in the order of their rows; every row of the items
is an item of its own; empty tables give no row; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.llm.common import cut, text_or_empty

#: Characters of the items that are searched together.
PART_CHARS = 4_000_000
#: Postings of a block, about: a block's lists are in the memory of one task.
BLOCK_POSTINGS = 1_500_000
#: Positions read in each list in the first round; a round reads twice as many as the one before.
FIRST_READ = 16
#: Ways by which the tasks' best rows of an item are ranked before the last ranking.
WAYS = 64
#: Bytes that part terms, as spaces, and capitals as small letters: terms are runs of ASCII letters and digits and of anything beyond ASCII.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in their order, as UTF-8."""
    return text.encode("utf-8").translate(FOLDED).split(b" ")


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's frequency counts in a document of length measure ``m``: below a million."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_measure(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    return 100 - 90 + (90 * n * documents) // max(1, total)


def weight(documents: int, df: int) -> int:
    """Of a term that ``df`` of the documents have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _term_counts(sent: Broadcast):
    """Rows (row, id, text) to (row, id, n, terms, tfs): all terms are counted, those of the vocabulary kept."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            sizes, ids, tfs = [], [], []
            for text in batch.column(2):
                found = Counter(terms(text.as_py()))
                found.pop(b"", None)
                sizes.append(sum(found.values()))
                own = [(number[t], n) for t, n in found.items() if t in number]
                ids.append(np.array([t for t, _ in own], dtype="int32"))
                tfs.append(np.array([n for _, n in own], dtype="int32"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                ["_row", "_id", "n", "terms", "tfs"],
            )

    return of


class Block:
    """Impact lists of a block of documents, with direct access by document."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, documents: int, total: int):
        self.first = np.concatenate([[0], np.cumsum(sizes)])  # a document's postings
        self.term = term
        m = np.repeat(length_measure(n, documents, total), sizes)
        self.impact = saturation(tf.astype("int64"), m)  # still without the term's weight
        doc = np.repeat(np.arange(len(sizes), dtype="int64"), sizes)
        # term by term, by falling impact; a document comes before a later one with an equal impact
        order = np.argsort((term.astype("int64") << 20) + ((1 << 20) - 1 - self.impact), kind="stable")
        self.listed_doc = doc[order]
        self.listed_impact = self.impact[order]
        self.place = np.empty(len(order), dtype="int64")  # where a document's posting lies among the lists
        self.place[order] = np.arange(len(order))
        listed = term[order]
        starts = np.flatnonzero(np.concatenate([[True], listed[1:] != listed[:-1]])) if len(listed) else np.zeros(0, dtype="int64")
        ends = np.append(starts, len(listed))[1:]
        self.lists = {int(listed[s]): (int(s), int(e)) for s, e in zip(starts, ends, strict=True)}
        self.seen = np.zeros(len(order), dtype=bool)  # by place among the lists; cleared after each search
        self.known = np.zeros(len(sizes), dtype=bool)

    def direct(self, docs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole scores of ``docs`` and the places of their postings in the lists with a weight."""
        sizes = self.first[docs + 1] - self.first[docs]
        at = np.repeat(self.first[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        gains = weights[self.term[at]]
        sums = np.concatenate([[0], np.cumsum(gains * self.impact[at])])
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return sums[edges[1:]] - sums[edges[:-1]], self.place[at[gains > 0]]

    def search(self, item: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores) that hold the block's ``k`` best with a score of ``floor`` or more, and the positions read.

        ``weights`` is zero for terms that the item has not. ``floor`` is a k-th score known already.
        """
        lists = [(self.lists[t], int(weights[t])) for t in item.tolist() if t in self.lists and weights[t] > 0]
        found: list[np.ndarray] = []
        scores: list[np.ndarray] = []
        touched: list[np.ndarray] = []
        best = [start for (start, _), _ in lists]  # the first place behind the best position
        read = [start for (start, _), _ in lists]
        step, kth, done = FIRST_READ, floor, 0
        top = np.zeros(0, dtype="int64")
        while True:
            # every list whose best position isn't its end is read on, from where reading or seeing has come
            docs = []
            for j, ((_, end), _) in enumerate(lists):
                start = max(read[j], best[j])
                stop = min(end, start + step)
                if start < stop:
                    docs.append(self.listed_doc[start:stop])
                    done += stop - start
                read[j] = max(stop, start)
            if docs:
                met = np.unique(np.concatenate(docs))
                met = met[~self.known[met]]
                if len(met):
                    self.known[met] = True
                    own, places = self.direct(met, weights)
                    self.seen[places] = True
                    touched.append(places)
                    found.append(met)
                    scores.append(own)
                    top = np.concatenate([top, own])
                    if len(top) > k:
                        top = np.partition(top, len(top) - k)[-k:]
                    if len(top) == k:
                        kth = max(kth, int(top.min()))
            bound = 0
            for j, ((_, end), gain) in enumerate(lists):
                best[j] = self._first_unseen(best[j], end)
                if best[j] < end:
                    bound += gain * int(self.listed_impact[best[j]])
            if bound < kth or bound == 0:
                break
            step *= 2
        for places in touched:
            self.seen[places] = False
        if not found:
            return np.zeros(0, dtype="int64"), np.zeros(0, dtype="int64"), done
        docs, own = np.concatenate(found), np.concatenate(scores)
        self.known[docs] = False
        keep = (own >= max(1, kth)) if kth else own > 0
        return docs[keep], own[keep], done

    def _first_unseen(self, at: int, end: int) -> int:
        size = 64
        while at < end:
            part = self.seen[at : min(end, at + size)]
            first = int(np.argmin(part))
            if not part[first]:
                return at + first
            at += len(part)
            size *= 4
        return end


def _keep_best(best: list[int], score: int, k: int) -> None:
    """``best`` is a heap of the ``k`` best scores, worst first."""
    if len(best) < k:
        heapq.heappush(best, score)
    elif score > best[0]:
        heapq.heapreplace(best, score)


def _searched(sent: Broadcast, k: int, block_postings: int):
    """Batches of the index to the best documents of each item in the task: (item, row, score)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, documents, total = sent.value
        best: list[list] = [[] for _ in items]
        gains = np.zeros(len(weights), dtype="int64")

        def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            rows = table.column("_row").to_numpy()
            listed, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
            block = Block(
                table.column("n").to_numpy(), np.diff(listed.offsets.to_numpy()), listed.flatten().to_numpy(), tfs.flatten().to_numpy(), documents, total
            )
            by_id = np.empty(len(rows), dtype="int64")
            by_id[pc.sort_indices(table, [("_id", "ascending"), ("_row", "ascending")], null_placement="at_start").to_numpy()] = np.arange(len(rows))
            places, ranked, numbers = [], [], []
            for number, item in enumerate(items):
                gains[item] = weights[item]
                own = best[number]
                floor = own[0] if len(own) == k else 0
                docs, scores, _ = block.search(item, gains, k, floor)
                gains[item] = 0
                if not len(docs):
                    continue
                # of equal scores those with the smallest ids, whatever the number of copies
                first = np.lexsort((by_id[docs], -scores))[:k]
                docs, scores = docs[first], scores[first]
                for s in scores.tolist():
                    _keep_best(own, s, k)
                places.append(docs)
                ranked.append(scores)
                numbers.append(np.full(len(docs), number, dtype="int64"))
            if places:
                take = np.concatenate(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(numbers)), pa.array(rows[take]), table.column("_id").take(pa.array(take)).combine_chunks(), pa.array(np.concatenate(ranked))],
                    ["_item", "_row", "_id", "score"],
                )

        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column(batch.schema.get_field_index("terms")).flatten())
            if size >= block_postings:
                yield from search(held)
                held, size = [], 0
        if held:
            yield from search(held)

    return of


def item_parts(items: DataFrame, part_chars: int) -> list[DataFrame]:
    """The items (_item, item_id, text) in parts of about ``part_chars`` characters."""
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // part_chars))
    return [items.where(F.pmod(F.xxhash64("_item"), F.lit(parts)) == p) if parts > 1 else items for p in range(parts)]


def _best_of(found: DataFrame, by: list, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_first("_id"), "_row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", part_chars: int = PART_CHARS, block_postings: int = BLOCK_POSTINGS,
) -> DataFrame:
    """(``item_id``, ``rank``, ``id_col``, ``score``): the ``k`` documents with the highest scores above 0 of each row of ``items``."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    asked = cut(items.select(F.monotonically_increasing_id().alias("_item"), items[item_id].alias("item_id"), text_or_empty(items[item_text]).alias("text")))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), docs[id_col].alias("_id"), text_or_empty(docs[text]).alias("_text"))
    kind = dict(docs.dtypes)[id_col]
    answers = []
    for part in item_parts(asked, part_chars):
        own = part.select("_item", "text").collect()  # bounded by part_chars
        wanted = [sorted({t for t in terms(r["text"]) if t}) for r in own]
        number = {t: i for i, t in enumerate(sorted({t for w in wanted for t in w}))}
        index = cut(rows.mapInArrow(_term_counts(sc.broadcast(number)), f"_row long, _id {kind}, n long, terms array<int>, tfs array<int>"))
        size = index.agg(F.sum((F.col("n") > 0).cast("long")), F.sum("n")).first()
        documents, total = size[0] or 0, size[1] or 0
        weights = np.zeros(len(number), dtype="int64")
        # at most a number for each term of the part
        for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            weights[term] = weight(documents, df)
        sent = sc.broadcast(([np.array([number[t] for t in w], dtype="int64") for w in wanted], weights, documents, total))
        found = index.select("_row", "_id", "n", "terms", "tfs").mapInArrow(
            _searched(sent, k, block_postings), f"_item long, _row long, _id {kind}, score long"
        )
        # few best of each task: ranked in ways first, so that no task has the rows of all tasks for an item
        few = _best_of(found.withColumn("_way", F.spark_partition_id() % WAYS), ["_item", "_way"], k).drop("rank", "_way")
        names = spark.createDataFrame([(i, r["_item"]) for i, r in enumerate(own)], "_item long, _key long")
        answers.append(_best_of(few, ["_item"], k).join(F.broadcast(names), "_item").drop("_item"))
    ranked = answers[0]
    for more in answers[1:]:
        ranked = ranked.unionByName(more)
    return ranked.join(asked.select(F.col("_item").alias("_key"), "item_id"), "_key").select(
        F.col("item_id").alias(item_id), "rank", F.col("_id").alias(id_col), "score"
    )
