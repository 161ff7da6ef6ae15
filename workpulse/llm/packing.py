"""Packing of tokenized documents into sequences of a fixed length: first-fit decreasing over a tournament tree.

Every document's token ids and an end id after them are cut into full sequences and a rest. The full ones are
sequences of their own. The rests are dealt at random to groups of about ``GROUP_DOCS`` documents, and each
group is packed by itself: its rests are placed in decreasing length, each into the first sequence that has
room. The rooms are the leaves of a tournament tree whose inner nodes hold the larger room of their two
children, so that the first sequence with room is found from the root in as many steps as the tree is high.

What first fit leaves open is closed by cutting: the pieces of the emptiest sequences fill the gaps of the
others. A group then has at most one sequence that isn't full, and that one is cut into sequences whose
lengths are powers of two, which need no padding. Documents that fit are cut only there.

The ids pass the one shuffle with two bytes each where the vocabulary allows it. The token table is cut with a
checkpoint first: it is the dear part, and the group of a row must not change when a task is run again.

Defined cases: a null or empty text has the end id alone; a very long text makes many full sequences, and its
group gets its rest only; equal lengths are placed in the order of their rows; repeated rows and ids are
documents of their own; an empty table packs into no piece; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from workpulse.llm.common import cut, text_or_empty
from workpulse.llm.tokens import read_vocabulary

#: Tokens of a sequence.
LENGTH = 2048
#: Documents of a group, about.
GROUP_DOCS = 4096
#: Words whose ids a worker keeps, and the longest such word; the table starts anew when it is full.
KEPT_WORDS = 400_000
KEPT_CHARS = 64
#: Normalizer and pre-tokenizer of a vocabulary of lower-case words whose white space is dropped. Fixed values.
WORD_NORMALIZER = ["NFC", r"\s+", "Lowercase"]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Punctuation without the apostrophe, which may begin a word of that pattern.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: A Latin word with punctuation after it: two words of that pattern at most, whatever follows.
_PLAIN = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ]+[{re.escape(_MARKS)}]*")

PIECE = "start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long"


def _drops_white_space(model: dict) -> bool:
    """Whether words between white space are encoded each by itself."""
    steps = (model.get("normalizer") or {}).get("normalizers", [])
    named = [s.get("pattern", {}).get("Regex") or s["type"] for s in steps]
    cuts = (model.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    split = cuts[0]
    return (
        named == WORD_NORMALIZER
        and split.get("pattern") == {"Regex": WORD_PATTERN}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and [c["type"] for c in cuts[1:]] == ["ByteLevel"]
        and model.get("post_processor") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in model["added_tokens"])
    )


class WordIds(dict):
    """Word to the bytes of its ids, for vocabularies that drop white space; works out what it has not kept.

    A word with its capitals and punctuation is put together from ``parts``, the bytes of lower-case words and of
    punctuation. The tokenizer sees each part once, until its table, of the same bound, starts anew.
    """

    def __init__(self, tokenizer: Tokenizer, kind: str, kept: int = KEPT_WORDS):
        super().__init__({"": b""})
        self.tokenizer, self.model, self.kind, self.kept = tokenizer, tokenizer.model, kind, kept
        self.parts: dict[str, bytes] = {}
        self.format = {"<u2": "H", "<u4": "I"}[kind]
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.characters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.format}", *ids)

    def of_word(self, word: str) -> bytes:
        """Of a lower-case word or a run of punctuation, as ``_PLAIN`` has them."""
        found = self.parts.get(word)
        if found is None:
            # visible ASCII characters stand for themselves
            spelled = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.characters)
            found = self.packed([t.id for t in self.model.tokenize(spelled)])
            if len(word) <= KEPT_CHARS:
                if len(self.parts) >= self.kept:
                    self.parts.clear()
                self.parts[word] = found
        return found

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(_MARKS)
        if word.isascii() and word.isalpha() or _PLAIN.fullmatch(chunk):
            found = self.of_word(word.lower())
            if len(word) < len(chunk):
                found += self.of_word(chunk[len(word) :])
        else:
            found = self.packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        if len(chunk) <= KEPT_CHARS:
            if len(self) >= self.kept:
                self.clear()
                self[""] = b""
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        for space in "\n\t\r":
            if space in text:
                text = text.replace(space, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


class TextIds:
    """Ids of whole texts, as the library gives them."""

    def __init__(self, tokenizer: Tokenizer, kind: str):
        self.tokenizer, self.kind = tokenizer, kind

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()


def id_kind(vocabulary: str) -> str:
    """Two bytes for an id where every id of the vocabulary fits, else four; little-endian."""
    model = json.loads(vocabulary)
    most = max([*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"])], default=0)
    return "<u2" if most < 1 << 16 else "<u4"


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> WordIds | TextIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    model = json.loads(vocabulary)
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    plain = model["model"].get("end_of_word_suffix") == "</w>" and model["model"]["type"] == "BPE"
    kind = id_kind(vocabulary)
    return WordIds(tokenizer, kind) if plain and _drops_white_space(model) else TextIds(tokenizer, kind)


def _pieces(sent: Broadcast, length: int, end_id: int, kind: str):
    """Batches of (row, id, text) to their full sequences and rests."""
    end = np.array([end_id], dtype=kind).tobytes()
    width = np.dtype(kind).itemsize

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode
        full = 0
        for batch in batches:
            rows, texts = batch.column(0).to_pylist(), batch.column(2)
            place, starts, lengths, ids, tokens, numbers = [], [], [], [], [], []
            for i, row in enumerate(rows):
                own = encode(texts[i].as_py()) + end
                size = len(own) // width
                for start in range(0, size, length):
                    part = own[start * width : (start + length) * width]
                    place.append(i)
                    starts.append(start)
                    lengths.append(len(part) // width)
                    ids.append(part)
                    tokens.append(size)
                    # a full sequence has an even number, unique by the partition in the row's upper bits
                    numbers.append(((row >> 33 << 33) + full) * 2 if lengths[-1] == length else None)
                    full += lengths[-1] == length
            take = pa.array(place, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()), pa.array(numbers, pa.int64())],
                ["_row", "_id", "start", "length", "ids", "doc_tokens", "sequence_id"],
            )

    return of


class Rooms:
    """Rooms of ``count`` sequences as a tournament tree: each inner node holds the larger room below it."""

    def __init__(self, count: int, length: int):
        self.leaves = 1 << max(0, count - 1).bit_length()
        self.tree = [length] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first sequence with room for ``size``, which it then has taken."""
        tree, node = self.tree, 1
        if tree[1] < size:
            raise ValueError("no sequence has room")
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        found = node - self.leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
        return found


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, size): every item whole, placed by decreasing size."""
    rooms = Rooms(len(sizes), length)
    sequences: list[list[tuple[int, int, int]]] = []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = rooms.place(sizes[item])
        if at == len(sequences):
            sequences.append([])
        sequences[at].append((item, 0, sizes[item]))
    return sequences


def close_gaps(sequences: list[list[tuple[int, int, int]]], length: int) -> list[list[tuple[int, int, int]]]:
    """The same pieces with those of the emptiest sequences cut into the gaps of the others.

    Every sequence comes out full or as long as a power of two.
    """
    done, open_ones = [], []
    for pieces in sequences:
        filled = sum(p[2] for p in pieces)
        (done if filled == length else open_ones).append((filled, list(pieces)))
    # fullest first: the smallest gaps are closed with the pieces of the emptiest sequences
    open_ones.sort(key=lambda x: -x[0])
    low, high = 0, len(open_ones) - 1
    while low < high:
        filled, pieces = open_ones[low]
        given, giving = open_ones[high]
        gap = length - filled
        item, start, size = giving.pop()
        taken = min(gap, size)
        pieces.append((item, start, taken))
        if taken < size:
            giving.append((item, start + taken, size - taken))
        open_ones[low], open_ones[high] = (filled + taken, pieces), (given - taken, giving)
        if filled + taken == length:
            low += 1
        if given == taken:
            high -= 1
    out = [pieces for _, pieces in done] + [pieces for filled, pieces in open_ones[: high + 1] if filled == length]
    for filled, pieces in open_ones[low : high + 1]:
        if filled == length:
            continue
        left = list(reversed(pieces))
        for bit in reversed(range(filled.bit_length())):
            if not filled >> bit & 1:
                continue
            room, own = 1 << bit, []
            while room:
                item, start, size = left.pop()
                taken = min(room, size)
                own.append((item, start, taken))
                room -= taken
                if taken < size:
                    left.append((item, start + taken, size - taken))
            out.append(own)
    return out


def _packed(length: int, kind: str):
    """The pieces of a group's rests with their sequences."""
    width = np.dtype(kind).itemsize

    def of(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.argsort(group.column("_row").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        sizes = group.column("length").to_pylist()
        first, ids = group.column("start").to_pylist(), group.column("ids").to_pylist()
        number = group.column("_group")[0].as_py() << 32
        place, starts, lengths, own, numbers, offsets = [], [], [], [], [], []
        for sequence in close_gaps(first_fit_decreasing(sizes, length), length):
            at = 0
            for item, start, size in sequence:
                place.append(item)
                starts.append(first[item] + start)
                lengths.append(size)
                own.append(np.frombuffer(ids[item], kind)[start : start + size].astype("<u4").tobytes())
                numbers.append(number * 2 + 1)
                offsets.append(at)
                at += size
            number += 1
        take = pa.array(place, pa.int32())
        return pa.table(
            {
                "_id": group.column("_id").take(take), "start": pa.array(starts, pa.int64()), "length": pa.array(lengths, pa.int64()),
                "ids": pa.array(own, pa.binary()), "doc_tokens": group.column("doc_tokens").take(take),
                "sequence_id": pa.array(numbers, pa.int64()), "offset": pa.array(offsets, pa.int64()),
            }
        )

    return of


def _widened(kind: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            wide = [np.frombuffer(x, kind).astype("<u4").tobytes() for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, "ids", pa.array(wide, pa.binary()))

    return of


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", length: int = LENGTH,
    end_id: int = 1, group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row for each piece: ``id_col`` and ``start`` (ids of the document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset`` in it.

    ``vocabulary`` is the path of a tokenizers JSON file. A sequence's pieces lie from offset 0 without gaps.
    """
    told = read_vocabulary(vocabulary)
    kind = id_kind(told)
    sent = docs.sparkSession.sparkContext.broadcast(told)
    id_type = dict(docs.dtypes)[id_col]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), docs[id_col].alias("_id"), text_or_empty(docs[text]).alias("_text"))
    schema = f"_row long, _id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long"
    pieces = cut(rows.mapInArrow(_pieces(sent, length, end_id, kind), schema))
    full = pieces.where("sequence_id is not null").select("_id", "start", "length", "ids", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    rests = pieces.where("sequence_id is null").drop("sequence_id")
    groups = max(1, -(-rests.count() // group_docs))
    dealt = rests.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    out = f"_id {id_type}, {PIECE}"
    packed = dealt.groupBy("_group").applyInArrow(_packed(length, kind), out)
    found = packed.unionByName(full.mapInArrow(_widened(kind), full.schema))
    return found.select(F.col("_id").alias(id_col), *(c for c in found.columns if c != "_id"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``length`` and ``ids`` of its pieces in their order."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.unhex(F.array_join(F.transform(ordered, lambda p: F.hex(p["ids"])), ""))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
