"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared in lower case with white space runs as one space. An item of n
characters counts as contained where some stretch of a text is within k = ``RATE`` n edits of it. By the
q-gram lemma such a stretch shares at least (n - q + 1) - k q of the item's q-grams, and their diagonals
(place in the text minus place in the item) lie within k of each other. So the shared q-grams are counted
in bands of 2 (k + 1) diagonals, each overlapping the next by half; bands below the bound can't hold a
match and are dropped. A banded alignment with free ends in the text verifies what is left and gives the
span and its exact number of edits.

The benchmark is the query set. Its index goes to the workers in parts of at most ``PART_CHARS``
characters, counting repeated items once; a larger benchmark is run part after part over the documents,
with the same result. The hits of a part are written before the next one is collected, and its index is
given up.

Defined cases: a null or empty text contains nothing; null and empty items are left out; an item shorter
than q characters is contained only in a text that equals it; for short items k is lowered so that the
bound is at least one q-gram; repeated rows and items are answered each; extra columns are kept.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import cut, text_or_empty

#: Length of the q-grams: as many bytes as a 64-bit number has.
Q = 8
RATE = 0.1
PART_CHARS = 5_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22

HITS = "array<struct<item_id:{kind},start:int,end:int,edits:int,item_chars:int,shared:int>>"


@functools.lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point to the lower-case one, white space to a space."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isspace():
            table[code] = 32
        elif len(low := char.lower()) == 1:
            table[code] = ord(low)
    return table


def fold(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Compared code points of a text, and the place in the text of each."""
    codes = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    space = codes == 32
    again = space[1:] & space[:-1]
    if again.any():
        kept = np.flatnonzero(np.concatenate(([True], ~again)))
        codes = codes[kept]
    else:
        kept = np.arange(len(codes))
    first = int(len(codes) > 0 and codes[0] == 32)
    last = len(codes) - int(len(codes) > first and codes[-1] == 32)
    return codes[first:last], kept[first:last]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit number for each run of Q code points; equal runs have equal numbers.

    A code point counts as its lowest byte, so that the eight of a run are one number as they lie in
    memory. Runs that differ in higher bytes only are taken for equal: a band may then seem to share
    more than it does, never less, and the alignment compares the code points themselves.
    """
    size = len(codes) - Q + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    low = codes.astype(np.uint8).tobytes()
    runs = np.empty(size, dtype=np.uint64)
    for j in range(min(Q, size)):
        runs[j::Q] = np.frombuffer(low, dtype=np.uint64, count=(size - j + Q - 1) // Q, offset=j)
    runs *= _FACTOR
    return runs


def edit_budget(size: int, rate: float = RATE) -> int:
    """Edits allowed for an item, lowered until the lemma asks for one shared q-gram at least."""
    return min(math.floor(rate * size), (size - Q) // Q)


def banded_alignment(item: np.ndarray, codes: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best stretch of ``codes`` on diagonals low..high, or None over budget.

    Ties go to the stretch that ends first. Row i of the table is after i items' code points, column c stands
    for the place low + c + i in the text. A cell's start is the place where its path left the first row.
    """
    width, size = high - low + 1, len(codes)
    far = len(item) + size + 1
    columns = np.arange(width)
    ends = low + columns
    cost = np.where((ends >= 0) & (ends <= size), 0, far)
    start = ends.copy()
    for i, char in enumerate(item):
        ends = low + columns + i + 1
        inside = (ends >= 1) & (ends <= size)
        same = np.zeros(width, dtype=bool)
        same[inside] = codes[ends[inside] - 1] == char
        new = cost + ~same
        new[~inside] = far
        begin = start.copy()
        # an item character without one in the text: from the next column of the row before
        skip = np.append(cost[1:] + 1, far)
        skip[(ends < 0) | (ends > size)] = far
        better = skip < new
        new[better], begin[better] = skip[better], np.append(start[1:], 0)[better]
        # text characters without one in the item: the best cell to the left, plus the distance
        shifted = new - columns
        best = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == best, columns, 0))
        # the last column that holds the running minimum
        cost = np.minimum(best + columns, far)
        start = begin[source]
        cost[(ends < 0) | (ends > size)] = far
        if cost.min() > budget:
            return None
    place = int(cost.argmin())
    return int(cost[place]), int(start[place]), int(low + place + len(item))


class ItemIndex:
    """The q-grams of some items with their places."""

    def __init__(self, items: list[tuple], rate: float = RATE):
        folded = [(i, fold(text)[0]) for i, text in items if text]
        self.whole: dict[bytes, list] = {}
        for i, codes in folded:
            if 0 < len(codes) < Q:
                self.whole.setdefault(codes.tobytes(), []).append(i)
        self.items = [(i, codes) for i, codes in folded if len(codes) >= Q]
        self.sizes = np.array([len(c) for _, c in self.items], dtype=np.int64)
        self.budgets = np.array([edit_budget(len(c), rate) for _, c in self.items], dtype=np.int64)
        self.least = self.sizes - Q + 1 - self.budgets * Q
        hashes = [gram_hashes(c) for _, c in self.items]
        every = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        order = np.argsort(every, kind="stable")
        self.item = np.concatenate([np.full(len(h), k) for k, h in enumerate(hashes)])[order] if hashes else order
        self.place = np.concatenate([np.arange(len(h)) for h in hashes])[order] if hashes else order
        self.grams, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        self.seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.seen[(self.grams >> np.uint64(64 - _FILTER_BITS)).view(np.int64)] = True

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place in it and diagonal of every q-gram that the text shares with an item."""
        none = np.empty(0, dtype=np.int64)
        hashes = gram_hashes(codes)
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).view(np.int64)])
        if not len(maybe) or not len(self.grams):
            return none, none, none
        spot = np.searchsorted(self.grams, hashes[maybe])
        spot[spot == len(self.grams)] = 0
        real = self.grams[spot] == hashes[maybe]
        maybe, spot = maybe[real], spot[real]
        sizes = self.first[spot + 1] - self.first[spot]
        offsets = np.repeat(self.first[spot] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        item, place = self.item[offsets], self.place[offsets]
        # a band can't hold more q-grams of an item than the text
        enough = (np.bincount(item, minlength=len(self.items)) >= self.least)[item]
        return item[enough], place[enough], np.repeat(maybe, sizes)[enough] - place[enough]

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first diagonal of the band, shared q-grams) of the bands that reach the bound."""
        item, place, diagonal = self.shared(codes)
        if not len(item):
            return []
        band = diagonal // (self.budgets[item] + 1)
        # a diagonal is in the band that begins at its step and in the one before
        keys = np.stack([np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(place, 2)], axis=1)
        keys = keys[np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))]
        fresh = np.ones(len(keys), dtype=bool)
        fresh[1:] = (keys[1:] != keys[:-1]).any(axis=1)  # an item's q-gram counts once in a band
        keys = keys[fresh]
        begins = np.flatnonzero(np.r_[True, (keys[1:, :2] != keys[:-1, :2]).any(axis=1)])
        counts = np.diff(np.append(begins, len(keys)))
        some = counts >= self.least[keys[begins, 0]]
        return [
            (int(keys[b, 0]), int(keys[b, 1] * (self.budgets[keys[b, 0]] + 1)), int(n))
            for b, n in zip(begins[some], counts[some], strict=True)
        ]

    def _unchanged(self, item: int, codes: np.ndarray, diagonal: int, shared: int) -> tuple[int, int, int] | None:
        """The stretch that equals the item, where a band shares all its q-grams."""
        wanted = self.items[item][1]
        if shared < len(wanted) - Q + 1:
            return None
        for start in range(max(diagonal, 0), diagonal + 2 * (int(self.budgets[item]) + 1)):
            if np.array_equal(codes[start : start + len(wanted)], wanted):
                return 0, start, start + len(wanted)
        return None

    def hits(self, text: str) -> list[dict]:
        """Contained items with their spans, the best of overlapping ones of the same item."""
        codes, where = fold(text)
        found = []
        if len(codes) < Q:
            return [
                {"item_id": i, "start": int(where[0]), "end": int(where[-1]) + 1, "edits": 0, "item_chars": len(codes), "shared": 0}
                for i in self.whole.get(codes.tobytes(), [])
            ]
        done: set[tuple[int, int]] = set()
        # bands of an item that lie side by side can't hold two stretches: the fuller one decides
        for item, diagonal, shared in sorted(self.regions(codes), key=lambda x: (x[0], -x[2], x[1])):
            budget = int(self.budgets[item])
            band = diagonal // (budget + 1)
            if (item, band - 1) in done or (item, band + 1) in done:
                continue
            best = self._unchanged(item, codes, diagonal, shared)
            if best is None:
                # paths stay within the budget of a band's diagonals
                best = banded_alignment(self.items[item][1], codes, diagonal - budget, diagonal + 3 * budget + 2, budget)
            if best is not None and best[2] > best[1]:
                done.add((item, band))
                found.append((item, *best, shared))
        found.sort(key=lambda x: (x[0], x[1], x[2]))
        kept: list[tuple] = []
        for hit in found:
            if not any(k[0] == hit[0] and k[2] < hit[3] and hit[2] < k[3] for k in kept):
                kept.append(hit)
        return [
            {"item_id": self.items[i][0], "start": int(where[start]), "end": int(where[end - 1]) + 1, "edits": edits,
             "item_chars": int(self.sizes[i]), "shared": shared}
            for i, edits, start, end, shared in kept
        ]


def benchmark_parts(benchmark: DataFrame, id_col: str, text: str, part_chars: int) -> list[DataFrame]:
    """The distinct items (item_id, text, times) in parts of about ``part_chars`` characters, by a hash of id and text."""
    items = benchmark.select(benchmark[id_col].alias("item_id"), benchmark[text].alias("text")).where("length(text) > 0")
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / part_chars))
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [items.where(mine == p) if parts > 1 else items for p in range(parts)]


def _hits_with(sent: Broadcast, kind: str):
    @F.pandas_udf(HITS.format(kind=kind))
    def of(texts: pd.Series) -> pd.Series:
        known = sent.value
        # an item stands for all its equal ones, which are answered each
        return pd.Series(
            [[h | {"item_id": h["item_id"][0]} for h in known.hits(t) for _ in range(h["item_id"][1])] for t in texts], dtype="object"
        )

    return of


def with_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "item_id", item_text: str = "text",
    rate: float = RATE, part_chars: int = PART_CHARS,
) -> DataFrame:
    """(``_row``, ``hits``): the packed rows and the benchmark items that their texts contain."""
    kind = dict(benchmark.dtypes)[id_col]
    found = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"), text_or_empty(docs[text]).alias("_text"))
    parts = benchmark_parts(benchmark, id_col, item_text, part_chars)
    for number, part in enumerate(parts):
        # a part is bounded by its characters
        index = ItemIndex([((r["item_id"], r["times"]), r["text"]) for r in part.collect()], rate)
        sent = docs.sparkSession.sparkContext.broadcast(index)
        hits = _hits_with(sent, kind)("_text")
        found = found.select("_row", "_text", (F.concat("hits", hits) if number else hits).alias("hits"))
        if len(parts) > 1:
            found = cut(found)
            sent.destroy()
    return found.select("_row", "hits")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each document and item that it contains, with span, edits and shared q-grams."""
    found = with_hits(docs.select(docs[id_col].alias(id_col), docs[text].alias(text)), benchmark, text, **options)
    return found.select(F.col("_row").getField(id_col).alias(id_col), F.inline("hits"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text contains a benchmark item."""
    return with_hits(docs, benchmark, text, **options).where(F.size("hits") == 0).select("_row.*")
