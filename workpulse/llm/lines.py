"""Line deduplication by pairwise alignment of documents that share passages.

Every non-blank line of a text is hashed (128 bits, surrounding white space left out; the second, third,
... occurrence in a text hash apart, so that a hash occurs once in a text). A common block of two documents
is a run of lines that follow each other in both and have ``BLOCK_WORDS`` words or more together; the blocks
that a document has in common with any earlier one, in order of (id, row hash), are deleted from it.

No pair is tried in vain and none is left out. A text is cut into all its windows: the shortest runs of
lines of ``BLOCK_WORDS`` words that start or end at a line, and of two lines where one alone has the words.
Every common block is made up of windows that overlap, whole in both documents, so the first document that
holds a window (its holder) stands for all earlier ones with it: a document is paired with the holders of
its windows, and the blocks in common with them cover the blocks in common with all earlier documents. A
line in a third of all documents makes one pair for each of them, never all pairs. Lines of any length and
frequency count if enough of them follow each other.

Words are counted so that scripts without spaces work too: see ``line_words``.

A pair is aligned by patience: the lines of its windows are unique in both texts, and the longest sequence of
them that ascends in both is the alignment. Lines off it (moved passages) align along their own diagonal.
Runs of lines that follow each other in both texts are the common blocks; blocks in common with several
documents that share lines are deleted, and told, as one.

The rows that hold each window are counted. Two documents that share a rare one (``RARE_DOCS`` rows or fewer)
overlap: the stretches of both texts between two anchors that follow each other in the alignment (up to
``GAP_LINES`` lines in each) are joined and aligned by patience in turn, and their aligned lines are deleted even
where a run of them has fewer words than a block. Documents with frequent windows alone (a header and a footer
of a thousand others) lose their common blocks, and what stands between them stays. This alignment is with the
first holder of a window: short lines that only a later holder has stay.

Defined cases: a null text stays null and an empty one empty; a document may lose all its lines and then
has the empty text; null ids come before all others; rows equal in all columns count as one document and
come out alike; an empty table gives an empty result; extra columns are kept as they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.common import cut, row_hash

BLOCK_WORDS = 8
#: Documents with a window that at most so many rows hold overlap.
RARE_DOCS = 100
#: Lines between two anchors that are around one passage.
GAP_LINES = 64
#: Characters of one word where no spaces tell: of a script without them, and of any long string at least.
SCRIPT_CHARS = 2
STRING_CHARS = 16
_SIGN = 1 << 63
# Thai, Lao, Tibetan, Myanmar, Khmer, Japanese and Chinese
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


def split_lines(text: str) -> list[tuple[int, str]]:
    """(line number, line without surrounding white space) of the lines that are not blank."""
    return [(i, line) for i, part in enumerate(text.split("\n")) if (line := part.strip())]


def line_words(line: str) -> int:
    """Words of a line: those between spaces, and one more for every ``SCRIPT_CHARS`` characters of scripts without spaces.

    Never fewer than one for every ``STRING_CHARS`` characters (code without spaces, encoded data).
    """
    words = len(line.split())
    if not line.isascii():
        words += len(_UNSPACED.findall(line)) // SCRIPT_CHARS
    return max(words, len(line) // STRING_CHARS)


def longest_ascent(values: list[int]) -> list[int]:
    """Positions of a longest strictly ascending subsequence, by patience sorting."""
    tops: list[int] = []
    where: list[int] = []
    before: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        before.append(where[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            where.append(i)
        else:
            tops[pile], where[pile] = value, i
    found = []
    i = where[-1] if where else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def common_blocks(shared: list[tuple[int, int]], ascent: list[int]) -> list[tuple[int, int]]:
    """(first, last) places here of the runs of lines that follow each other in both texts.

    ``shared`` has (place here, place in the holder) of the lines that a pair shares, by place here, and ``ascent``
    the positions of those on the alignment.
    """
    on = set(ascent)
    found = []
    for chain in (ascent, [i for i in range(len(shared)) if i not in on]):
        start = 0
        for k in range(1, len(chain) + 1):
            here, there = shared[chain[k - 1]]
            if k < len(chain) and shared[chain[k]] == (here + 1, there + 1):
                continue
            found.append((shared[chain[start]][0], here))
            start = k
    return found


def gaps_between(anchors: list[tuple[int, int]], most: int = GAP_LINES) -> list[tuple[int, int, int, int]]:
    """(first, last) places here and (first, last) places in the holder of the lines between two anchors."""
    found = []
    for (here, there), (until, upto) in pairwise(anchors):
        if 1 < until - here <= most + 1 and 1 < upto - there <= most + 1:
            found.append((here + 1, until - 1, there + 1, upto - 1))
    return found


def patience(here: list[int], there: list[int]) -> list[int]:
    """Places of the lines of ``here`` that a patience diff aligns with ``there``.

    The lines that stretches begin or end with alike are aligned, then a longest ascent of the lines that each has
    once; the stretches between these are aligned in turn, until they have no such line.
    """
    found = []
    open_ = [(0, len(here), 0, len(there))]
    while open_:
        a, b, c, d = open_.pop()
        while a < b and c < d and here[a] == there[c]:
            found.append(a)
            a, c = a + 1, c + 1
        while a < b and c < d and here[b - 1] == there[d - 1]:
            found.append(b - 1)
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        once, times = Counter(here[a:b]), Counter(there[c:d])
        at = {there[k]: k for k in range(c, d)}
        unique = [(k, at[here[k]]) for k in range(a, b) if once[here[k]] == 1 and times[here[k]] == 1]
        anchors = [unique[i] for i in longest_ascent([k for _, k in unique])]
        found += [k for k, _ in anchors]
        if anchors:
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            open_ += [(i + 1, j, k + 1, n) for (i, k), (j, n) in pairwise(ends)]
    return sorted(found)


def merged(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The blocks in order, those that share a place joined."""
    found: list[tuple[int, int]] = []
    for first, last in sorted(blocks):
        if found and first <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], last))
        else:
            found.append((first, last))
    return found


def windows(words: list[int], least: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """(first, last) of the shortest runs with ``least`` words that start or end at each line.

    A line that has the words alone also makes a run with its neighbours, so that every two lines that
    follow each other within a longer run are together in one of these.
    """
    found = set()
    last, held = -1, 0
    for first, own in enumerate(words):
        while held < least and last + 1 < len(words):
            last += 1
            held += words[last]
        if held < least:
            break
        found.add((first, last))
        if first == last and first + 1 < len(words):
            found.add((first, first + 1))
        held -= own
    first, held = 0, 0
    for last, own in enumerate(words):
        held += own
        while first < last and held - words[first] >= least:
            held -= words[first]
            first += 1
        if held >= least:
            found.add((first, last))
    return sorted(found)


def _hashed_windows(batches: Iterator[pd.DataFrame], block_words: int) -> Iterator[pd.DataFrame]:
    """One row for each window: the document, places and line numbers of its ends, words before it and up to its end, hash."""
    names = ("id", "hash", "place", "until", "line", "until_line", "before", "through", "digest")
    for batch in batches:
        rows = []
        for id_, hash_, text in zip(batch["id"], batch["hash"], batch["text"], strict=True):
            seen: dict[str, int] = {}
            numbers, words, digests = [], [], []
            for number, line in split_lines(text):
                times = seen[line] = seen.get(line, -1) + 1
                numbers.append(number)
                words.append(line_words(line))
                digests.append(xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"), times))
            sums = list(accumulate(words, initial=0))
            for a, b in windows(words, block_words):
                digest = digests[a] if a == b else xxhash.xxh3_128_digest(b"".join(digests[a : b + 1]))
                rows.append((id_, hash_, a, b, numbers[a], numbers[b], sums[a], sums[b + 1], digest))
        columns = zip(*rows, strict=True) if rows else ([] for _ in names)
        yield pd.DataFrame({n: pd.Series(list(c), dtype="object" if n in ("id", "digest") else "int64") for n, c in zip(names, columns, strict=True)})


def _line_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each document: the line number, the words and the 64-bit hash of each line that is not blank."""
    for batch in batches:
        numbers, words, digests = [], [], []
        for text in batch["text"]:
            lines = split_lines(text)
            numbers.append([n for n, _ in lines])
            words.append([line_words(line) for _, line in lines])
            # as a signed number, which Spark has
            digests.append([(xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) ^ _SIGN) - _SIGN for _, line in lines])
        columns = {"numbers": numbers, "words": words, "digests": digests}
        yield batch[["id", "hash"]].assign(**{n: pd.Series(c, index=batch.index, dtype="object") for n, c in columns.items()})


def _aligned_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each pair of stretches the lines that are aligned."""
    names = ("id", "hash", "line", "words")
    for batch in batches:
        rows = []
        columns = [batch[c] for c in ("id", "hash", "digests", "theirs", "numbers", "words")]
        for id_, hash_, digests, theirs, numbers, words in zip(*columns, strict=True):
            rows += [(id_, hash_, numbers[k], words[k]) for k in patience(digests.tolist(), theirs.tolist())]
        columns = zip(*rows, strict=True) if rows else ([] for _ in names)
        yield pd.DataFrame({n: pd.Series(list(c), dtype="object" if n == "id" else "int64") for n, c in zip(names, columns, strict=True)})


def _lines_between_anchors(texts: DataFrame, gaps: DataFrame) -> DataFrame:
    """(id, hash, extra): the aligned lines (line, words) in the ``gaps`` of each document.

    ``gaps`` has (id, hash, gap) with the stretches of a document and of a holder, ``texts`` (id, hash, text);
    ids are text, never null. Both sides read the same lists of lines by (hash, id).
    """
    lists = (
        texts.mapInPandas(_line_lists, "id string, hash long, numbers array<int>, words array<int>, digests array<long>")
        .groupBy("hash", "id")
        .agg(F.first(F.struct("numbers", "words", "digests")).alias("own"))  # rows equal in all columns are one document
    )
    holders = lists.select(F.col("hash").alias("holder_hash"), F.col("id").alias("holder"), F.col("own.digests").alias("theirs"))

    def stretch(values: str, first: str, last: str) -> Column:
        return F.slice(values, F.col(first) + 1, F.col(last) - F.col(first) + 1)

    pairs = (
        gaps.select("id", "hash", "gap.*")
        .join(holders, ["holder_hash", "holder"])
        .select("id", "hash", "here", "until", stretch("theirs", "there", "upto").alias("theirs"))
        .join(lists, ["hash", "id"])
        .select("id", "hash", "theirs", *(stretch(f"own.{c}", "here", "until").alias(c) for c in ("digests", "numbers", "words")))
    )
    return (
        pairs.mapInPandas(_aligned_lines, "id string, hash long, line int, words long")
        .groupBy("hash", "id")
        .agg(F.collect_set(F.struct("line", "words")).alias("extra"))
    )


def deleted_blocks(keyed: DataFrame, block_words: int = BLOCK_WORDS, rare_docs: int = RARE_DOCS) -> DataFrame:
    """From (id, hash, text): (id, hash, blocks, words, holders) of the documents that lose lines.

    ``blocks`` has the first and last line number of each block, ``holders`` the ids of the first documents
    that hold its windows.
    """
    kind = dict(keyed.dtypes)["id"]
    # ids go to pandas as text: next to a null it would make long integers floating-point numbers
    texts = keyed.where("text is not null").withColumn("id", F.col("id").cast("string"))
    runs = (
        texts.mapInPandas(
            lambda batches: _hashed_windows(batches, block_words),
            "id string, hash long, place int, until int, line int, until_line int, before int, through int, digest binary",
        )
        .withColumn("id", F.col("id").cast(kind))
    )
    # sums over documents, not lists of them: a line may be in a third of all documents. Cut, so that
    # the join below has a shuffle on both sides and splits the rows of such a line over tasks
    held = cut(
        runs.groupBy("digest")
        .agg(
            F.min(F.struct("id", "hash", "place")).alias("first"),
            F.max(F.struct("id", "hash")).alias("last"),
            (F.count("*") <= rare_docs).alias("rare"),
        )
        .where("struct(first.id, first.hash) < last")
        .select("digest", F.col("first.id").alias("holder"), F.col("first.hash").alias("holder_hash"), F.col("first.place").alias("there"), "rare")
    )
    ends = ("place", "until", "line", "until_line", "before", "through")
    shared = (
        runs.join(held, "digest")
        .where(~(F.col("id").eqNullSafe(F.col("holder")) & (F.col("hash") == F.col("holder_hash"))))
        .select(
            F.col("id").cast("string").alias("id"), "hash", *ends,
            F.col("holder").cast("string").alias("holder"), "holder_hash", "there", "rare",
        )
        .distinct()  # rows equal in all columns are one document
    )

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def blocks_of(document, rows):
            pairs: dict[tuple, dict[int, int]] = {}
            overlap = set()
            starts, stops = {}, {}
            for place, until, line, until_line, before, through, holder, holder_hash, there, rare in rows:
                pair = None if pd.isna(holder) else holder, holder_hash
                pairs.setdefault(pair, {}).update((place + i, there + i) for i in range(until - place + 1))
                if rare:
                    overlap.add(pair)
                starts[place], stops[until] = (line, before), (until_line, through)
            every, between = [], []
            for pair, common in pairs.items():
                lines = sorted(common.items())
                ascent = longest_ascent([there for _, there in lines])
                every += common_blocks(lines, ascent)
                if pair in overlap:
                    between += [(*pair, *gap) for gap in gaps_between([lines[i] for i in ascent])]
            found = merged(every)
            begins = [first for first, _ in found]
            # what a block with another holder covers is gone anyway
            between = [gap for gap in between if found[bisect_right(begins, gap[2]) - 1][1] < gap[3]]
            blocks = [(starts[first][0], stops[last][0]) for first, last in found]
            words = sum(stops[last][1] - starts[first][1] for first, last in found)
            return (*document, blocks, words, list(dict.fromkeys(holder for holder, _ in pairs)), between)

        now, rows = None, []
        for batch in batches:
            done = []
            columns = [batch[c].tolist() for c in ("id", "hash", *ends, "holder", "holder_hash", "there", "rare")]
            for id_, hash_, *row in zip(*columns, strict=True):
                document = (None if pd.isna(id_) else id_, hash_)
                if document != now:
                    if rows:
                        done.append(blocks_of(now, rows))
                    now, rows = document, []
                rows.append(row)
            yield _frame(done)
        if rows:
            yield _frame([blocks_of(now, rows)])

    gap = "array<struct<holder string, holder_hash long, here int, until int, there int, upto int>>"
    found = cut(
        shared.repartition("id", "hash")
        .sortWithinPartitions("id", "hash", "place", "until")
        .mapInPandas(align, f"id string, hash long, blocks array<struct<first int, last int>>, words long, holders array<string>, gaps {gap}")
    )
    # a null id is told from an empty one by the row hash
    known = F.coalesce("id", F.lit(""))
    gaps = found.select(known.alias("id"), "hash", F.explode("gaps").alias("gap")).withColumn(
        "gap", F.col("gap").withField("holder", F.coalesce("gap.holder", F.lit("")))
    )
    extra = _lines_between_anchors(texts.select(known.alias("id"), "hash", "text"), gaps)
    more = F.filter(
        F.coalesce("extra", F.array()),
        lambda x: ~F.exists("blocks", lambda b: (b["first"] <= x["line"]) & (x["line"] <= b["last"])),
    )
    return (
        found.join(extra.withColumnsRenamed({"id": "known", "hash": "known_hash"}), (known == F.col("known")) & (F.col("hash") == F.col("known_hash")), "left")
        .withColumn("more", more)
        .select(
            F.col("id").cast(kind).alias("id"),
            "hash",
            F.array_sort(F.concat("blocks", F.transform("more", lambda x: F.struct(x["line"].alias("first"), x["line"].alias("last"))))).alias("blocks"),
            (F.col("words") + F.aggregate("more", F.lit(0).cast("long"), lambda n, x: n + x["words"])).alias("words"),
            F.col("holders").cast(f"array<{kind}>").alias("holders"),
        )
    )


def _frame(rows: list) -> pd.DataFrame:
    gap = ("holder", "holder_hash", "here", "until", "there", "upto")
    return pd.DataFrame({
        "id": pd.Series([r[0] for r in rows], dtype="object"), "hash": pd.Series([r[1] for r in rows], dtype="int64"),
        "blocks": pd.Series([[{"first": a, "last": b} for a, b in r[2]] for r in rows], dtype="object"),
        "words": pd.Series([r[3] for r in rows], dtype="int64"), "holders": pd.Series([r[4] for r in rows], dtype="object"),
        "gaps": pd.Series([[dict(zip(gap, g, strict=True)) for g in r[5]] for r in rows], dtype="object"),
    })


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", block_words: int = BLOCK_WORDS, rare_docs: int = RARE_DOCS
) -> DataFrame:
    """(``_row``, ``text``, ``blocks``, ``words``, ``holders``): the packed rows and their texts without the blocks.

    With ``rare_docs`` 0 no documents are aligned in whole: the common blocks alone are deleted.
    """
    columns = [docs[c] for c in docs.columns]
    keyed = docs.select(F.struct(*columns).alias("_row"), row_hash(docs).alias("hash")).withColumn(
        "id", F.col(f"_row.{id_col}")
    )
    gone = deleted_blocks(keyed.select("id", "hash", F.col(f"_row.{text}").alias("text")), block_words, rare_docs)
    gone = gone.withColumnsRenamed({"id": "gone_id", "hash": "gone_hash"})
    joined = keyed.join(
        gone, (F.col("hash") == F.col("gone_hash")) & F.col("id").eqNullSafe(F.col("gone_id")), "left"
    )
    left = F.array_join(
        F.filter(
            F.split(F.col(f"_row.{text}"), "\n"),
            lambda _, i: ~F.exists("blocks", lambda b: (b["first"] <= i) & (i <= b["last"])),
        ),
        "\n",
    )
    return joined.select(
        "_row",
        F.when(F.col("blocks").isNull(), F.col(f"_row.{text}")).otherwise(left).alias("text"),
        "blocks",
        F.coalesce("words", F.lit(0)).cast("long").alias("words"),
        "holders",
    )


def documents_without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its columns, the texts without the lines that an earlier document has."""
    found = dedup_lines(docs, id_col, text)
    return found.select(
        *(F.col("text") if c == text else F.col("_row").getField(c) for c in docs.columns)
    ).toDF(*docs.columns)
