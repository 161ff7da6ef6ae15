"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut at the vocabulary's special strings and then into pieces by its pattern. The bytes of a
piece form a linked list of symbols, and its adjacent pairs with a rank a heap. The pair of lowest
rank (leftmost on ties) is popped again and again, merged if both its symbols are still as they were
when it was pushed, and the two new neighbouring pairs are pushed. A piece's count is its number of
bytes minus the merges made: no identifiers are built. Counts of pieces seen before are kept in a
worker's bounded table; one that is not there is worked out again.

Defined cases: a null text is the empty text with 0 tokens; very long pieces cost n log n; a special
string in a text is one token, as the library takes it by default; extra columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import text_or_empty

#: Largest vocabulary file that is sent to the workers.
VOCABULARY_BYTES = 64 << 20
#: Pieces whose counts a worker keeps; the table starts anew when it is full.
KEPT_PIECES = 400_000
#: Split pattern of the byte-level pre-tokenizer. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHIFT = 20


def _byte_characters() -> dict[str, int]:
    """Character to byte: the printable bytes of Latin-1 stand for themselves, others for 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceCounts(dict):
    """Piece of text to its number of tokens; works out what it has not kept."""

    def __init__(self, vocabulary: str, kept: int = KEPT_PIECES):
        super().__init__()
        model = json.loads(vocabulary)
        to_byte = _byte_characters()
        numbers: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = (bytes(to_byte[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            merged = numbers.setdefault(left + right, len(numbers))
            self.pairs.setdefault(numbers[left] << _SHIFT | numbers[right], (rank, merged))
        self.kept = kept
        special = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pieces = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.kept:
            self.clear()
        found = self[piece] = self.merge(piece.encode("utf-8", "surrogatepass"))
        return found

    def merge(self, piece: bytes) -> int:
        pairs = self.pairs.get
        symbols = list(piece)
        size = len(symbols)
        if size == 1:
            return 1
        heap = []
        for i in range(size - 1):
            found = pairs(symbols[i] << _SHIFT | symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        count = size
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank, i, merged = pop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= size:
                continue
            now = pairs(symbols[i] << _SHIFT | symbols[j])
            if now is None or now[0] != rank:
                continue
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            count -= 1
            if k < size:
                before[k] = i
                found = pairs(merged << _SHIFT | symbols[k])
                if found:
                    push(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = pairs(symbols[h] << _SHIFT | merged)
                if found:
                    push(heap, (found[0], h, found[1]))
        return count

    def count(self, text: str) -> int:
        if self.special is None:
            return sum(map(self.__getitem__, self.pieces(text)))
        specials = self.special.findall(text)
        parts = self.special.split(text) if specials else [text]
        return len(specials) + sum(sum(map(self.__getitem__, self.pieces(part))) for part in parts)


@functools.lru_cache(maxsize=2)
def _of_worker(vocabulary: str) -> PieceCounts:
    return PieceCounts(vocabulary)


def read_vocabulary(path: str) -> str:
    """The vocabulary file, refused beyond ``VOCABULARY_BYTES``: it is sent to every worker."""
    with open(path, encoding="utf-8") as file:
        text = file.read(VOCABULARY_BYTES + 1)
    if len(text) > VOCABULARY_BYTES:
        raise ValueError(f"vocabulary {path} is larger than {VOCABULARY_BYTES} bytes")
    return text


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (long) added; ``vocabulary`` is the path of a tokenizers JSON file."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        counts = _of_worker(sent.value)
        return pd.Series([counts.count(t) for t in texts], dtype="int64")

    return docs.withColumn("n_tokens", of(text_or_empty(docs[text])))
